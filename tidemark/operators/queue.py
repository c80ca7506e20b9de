"""The work queue: states of urls as a fold over an append-only log of transitions, and the key-value table of checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.store import latest

#: Operations of the log: discovered, processing, release (error, status, counted), failed (error, status), saved and skipped
#: (error, status, hash), recover, requeue. `recover` and `requeue` are written for each url that they concern.
STATE = "struct<status:string,attempts:int,http_status:int,error:string,content_hash:string,last_attempt_at:string,last_success_at:string,failed_at:string,processed_at:string>"
TRANSITION = "seq bigint, url string, external_id string, op string, at string, error string, http_status int, counted boolean, content_hash string"


def _step(s: Column, t: Column) -> Column:
    op = t["op"]
    keep = lambda f: s[f]
    known = s["status"].isNotNull()
    status = (
        F.when((op == "discovered") & ~known, "DISCOVERED")
        .when(~known, F.lit(None))
        .when(op == "processing", "PROCESSING")
        .when(op == "release", "DISCOVERED")
        .when(op == "failed", "FAILED")
        .when(op == "saved", "SUCCESS")
        .when(op == "skipped", "SKIPPED")
        .when((op == "recover") & (s["status"] == "PROCESSING"), "DISCOVERED")
        .when((op == "requeue") & (s["status"] == "FAILED"), "DISCOVERED")
        .otherwise(s["status"])
    )
    requeued = (op == "requeue") & (s["status"] == "FAILED")
    done = op.isin("saved", "skipped")
    attempts = F.when(op == "processing", s["attempts"] + 1).when(op == "release", F.greatest(F.lit(0), s["attempts"] - F.when(F.coalesce(t["counted"], F.lit(False)), 0).otherwise(1))).when(requeued, 0).otherwise(s["attempts"])
    told = op.isin("release", "failed", "saved", "skipped")
    return F.struct(
        status.alias("status"),
        F.when(status.isNotNull(), F.coalesce(attempts, F.lit(0))).cast("int").alias("attempts"),
        F.when(told, t["http_status"]).otherwise(keep("http_status")).alias("http_status"),
        F.when(told, t["error"]).when(requeued, F.lit(None)).otherwise(keep("error")).alias("error"),
        F.when(done, t["content_hash"]).otherwise(keep("content_hash")).alias("content_hash"),
        F.when(op == "processing", t["at"]).otherwise(keep("last_attempt_at")).alias("last_attempt_at"),
        F.when(done, t["at"]).otherwise(keep("last_success_at")).alias("last_success_at"),
        F.when(op == "failed", t["at"]).when(done | (op == "requeue"), F.lit(None)).otherwise(keep("failed_at")).alias("failed_at"),
        F.when(done, t["at"]).when(op == "failed", F.lit(None)).otherwise(keep("processed_at")).alias("processed_at"),
    )


def queue_state(log: DataFrame) -> DataFrame:
    """The state of each url after all its transitions, in the order of seq. A url's transitions are a handful, so they meet in one array."""
    item = F.struct("seq", "op", "at", "error", "http_status", "counted", "content_hash")
    start = F.from_json(F.lit("{}"), STATE)
    rows = log.groupBy("url").agg(F.min_by("external_id", "seq").alias("external_id"), F.min("at").alias("first_seen_at"), F.min("seq").alias("first_seq"), F.array_sort(F.collect_list(item)).alias("ts"))
    rows = rows.withColumn("s", F.aggregate("ts", start, _step))
    return rows.select("url", "external_id", "first_seen_at", "first_seq", "s.*").where("status is not null")


def pending(state: DataFrame, limit: int) -> DataFrame:
    """The next urls in the order of their discovery."""
    return state.where("status = 'DISCOVERED'").orderBy("first_seen_at", "first_seq").limit(limit)


def batch_size(remaining: int) -> int:
    """Rows of one step of the queue: as many as may still be taken, 200 at most, one at least."""
    return max(1, min(remaining, 200))


def failed(state: DataFrame, limit: int = 50) -> DataFrame:
    """The latest failures; of equal times the smaller url first."""
    return state.where("failed_at is not null and status = 'FAILED'").orderBy(F.desc("failed_at"), "url").limit(limit)


def processed(state: DataFrame) -> DataFrame:
    return state.where("processed_at is not null").select("url", "external_id", "status", "content_hash", "http_status", "processed_at")


def attempts(state: DataFrame, urls: DataFrame) -> DataFrame:
    """Attempts of each asked url, 0 for unknown ones."""
    return urls.join(state.select("url", "attempts"), "url", "left").select("url", F.coalesce("attempts", F.lit(0)).alias("attempts"))


def after_error(error: DataFrame, most: int = 3) -> DataFrame:
    """What follows an error (columns url, retryable, attempts): release with a counted attempt while attempts are left, else failed."""
    again = F.col("retryable") & (F.col("attempts") < most)
    return error.withColumn("op", F.when(again, "release").otherwise("failed")).withColumn("counted", again)


# -- checkpoints: rows (key, value, seq), of which the last of a key holds


def cursor_key(slug: Column) -> Column:
    return F.concat(F.lit("cursor:"), slug)


def done_key(slug: Column) -> Column:
    return F.concat(F.lit("done:"), slug)


def state_value(state: DataFrame, key: str, default: str | None = None) -> DataFrame:
    """One row: the value that a key holds, the default if it was never set."""
    return latest(state.where(F.col("key") == key), "key").agg(F.coalesce(F.max("value"), F.lit(default).cast("string")).alias("value"))


def category_progress(state: DataFrame, slugs: DataFrame) -> DataFrame:
    """slug, pos, done and next_page (1 by default) of every category of slugs (slug, pos)."""
    values = latest(state, "key").select("key", "value")
    done, cursor = values.select(F.col("key").alias("dk"), F.col("value").alias("dv")), values.select(F.col("key").alias("ck"), F.col("value").alias("cv"))
    joined = slugs.join(done, F.col("dk") == done_key(F.col("slug")), "left").join(cursor, F.col("ck") == cursor_key(F.col("slug")), "left")
    page = F.nullif(F.col("cv"), F.lit("")).try_cast("int")
    return joined.select("slug", "pos", F.coalesce(F.col("dv") == "1", F.lit(False)).alias("done"), F.coalesce(page, F.lit(1)).alias("next_page"))


def resume_point(progress: DataFrame) -> DataFrame:
    """One row: categories done and all, and the first that isn't done with its next page."""
    todo = ~F.col("done")
    return progress.agg(
        F.count_if("done").alias("done"), F.count(F.lit(1)).alias("categories"),
        F.min_by("slug", F.when(todo, F.col("pos"))).alias("next_category"), F.min_by("next_page", F.when(todo, F.col("pos"))).alias("next_page"),
    )


def mark_done(slugs: DataFrame, seq: int) -> DataFrame:
    return slugs.select(done_key(F.col("slug")).alias("key"), F.lit("1").alias("value"), F.lit(seq).cast("long").alias("seq"))


def reopen(slugs: DataFrame, seq: int) -> DataFrame:
    """A finished category starts over."""
    return slugs.select(F.explode(F.array(F.struct(done_key(F.col("slug")).alias("key"), F.lit("0").alias("value")), F.struct(cursor_key(F.col("slug")).alias("key"), F.lit("1").alias("value")))).alias("kv")).select("kv.*", F.lit(seq).cast("long").alias("seq"))


def save_categories(slugs: DataFrame, seq: int) -> DataFrame:
    """One row: the slugs (slug, pos) in order, as a JSON list."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "slug"))), lambda s: s["slug"])
    return slugs.agg(listed.alias("slugs")).select(F.lit("categories").alias("key"), F.to_json("slugs").alias("value"), F.lit(seq).cast("long").alias("seq"))


def categories(state: DataFrame) -> DataFrame:
    """The categories that were saved last (slug, pos); none if none were."""
    saved = state_value(state, "categories").select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "slug"))
    return saved.select("slug", "pos")


def note_run(reasons: DataFrame, seq: int) -> DataFrame:
    """Why the last run stopped (one row with a column reason)."""
    return reasons.select(F.lit("last_run").alias("key"), F.to_json(F.struct(F.col("reason").alias("stopped"))).alias("value"), F.lit(seq).cast("long").alias("seq"))
