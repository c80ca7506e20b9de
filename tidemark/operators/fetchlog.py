"""Outcomes of logged fetches: status classes, challenges, back-off, and runs of refusals. Nothing is fetched."""

from __future__ import annotations

from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Statuses that are worth another try, marks of challenge pages, and words of API errors that mean a block.
RETRYABLE = (408, 425, 429, 500, 502, 503, 504)
STRONG_MARKERS = ("<title>just a moment", "cf-browser-verification", "cf-chl-", "attention required! | cloudflare")
WEAK_MARKERS = ("challenge-platform", "g-recaptcha", "hcaptcha", "captcha", "automated access", "unusual traffic", "just a moment...")
BLOCK_WORDS = ("rate limit", "throttl", "too many", "captcha", "forbidden", "unauthenticated")
MARKED_CHARACTERS, SMALL_BODY = 60_000, 20_000
#: Reason of a stop and the exit code that tells it.
EXIT_CODES = {"completed": 0, "limit_reached": 0, "error": 1, "blocked": 3, "connection_failure": 1, "interrupted": 130}


def _any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def header(headers: Column, name: str) -> Column:
    """A header's value, whatever the case of its name."""
    return F.get(F.map_values(F.map_filter(headers, lambda k, _: F.lower(k) == name)), F.lit(0))


def is_challenge(status: Column, headers: Column, body: Column) -> Column:
    told = F.coalesce(F.lower(header(headers, "cf-mitigated")) == "challenge", F.lit(False))
    html = F.coalesce(F.lower(header(headers, "content-type")).contains("html"), F.lit(False))
    start = F.lower(F.left(body, F.lit(MARKED_CHARACTERS)))
    weak = ((status >= 400) | (F.octet_length(body) < SMALL_BODY)) & _any(start, WEAK_MARKERS)
    return told | F.coalesce(html & (_any(start, STRONG_MARKERS) | weak), F.lit(False))


def outcome(status: Column, headers: Column, body: Column, error: Column, json: Column | None = None) -> Column:
    """ok, retryable, permanent, rate_limited, forbidden, challenge or transport; json: whether a JSON body is expected."""
    broken = F.lit(False) if json is None else json & F.try_parse_json(body).isNull()
    return (
        F.when(error.isNotNull() | status.isNull(), "transport")
        .when(is_challenge(status, headers, body), "challenge")
        .when(status == 429, "rate_limited")
        .when(status == 403, "forbidden")
        .when(status.isin(*RETRYABLE), "retryable")
        .when(status >= 400, "permanent")
        .when(broken, "retryable")
        .otherwise("ok")
    )


def retry_after(value: Column) -> Column:
    """Seconds of a Retry-After header, 0 at least; null for dates and other text."""
    seconds = value.try_cast("double")
    return F.when(seconds < 0, 0.0).otherwise(seconds)


def backoff(asked: Column, attempt: Column, base: float = 5.0, cap: float = 300.0) -> Column:
    """The wait before another try, without its random part: what was asked for, else base doubled for every try, capped unless cap is 0."""
    wait = F.coalesce(asked, F.lit(base) * F.pow(F.lit(2.0), attempt - 1))
    return F.least(wait, F.lit(cap)) if cap else wait


def classified(log: DataFrame, expect_json: bool = False) -> DataFrame:
    """The log with `outcome`, `attempt` (tries of the url within its run so far) and `wait` where another try is due."""
    tries = Window.partitionBy("run_id", "url").orderBy("seq")
    rows = log.withColumn("outcome", outcome(F.col("status"), F.col("headers"), F.col("body"), F.col("error"), F.lit(True) if expect_json else None))
    rows = rows.withColumn("attempt", F.row_number().over(tries))
    due = F.col("outcome").isin("retryable", "rate_limited", "transport")
    return rows.withColumn("wait", F.when(due, backoff(retry_after(header(F.col("headers"), "retry-after")), F.col("attempt"))))


def final_attempts(rows: DataFrame, retries: int = 3) -> DataFrame:
    """The last try of each url of a run that the retry rule lets happen: up to the first that isn't worth another, retries + 1 at most."""
    stop = ~F.col("outcome").isin("retryable", "rate_limited", "transport")
    first = F.min(F.when(stop | (F.col("attempt") == retries + 1), F.col("attempt"))).over(Window.partitionBy("run_id", "url"))
    last = F.max("attempt").over(Window.partitionBy("run_id", "url"))
    return rows.withColumn("_end", F.coalesce(first, last)).where("attempt = _end").drop("_end")


#: Numbers of the order that one task counts through; the counts of such ranges are then added up, a row a range.
SPAN = 1 << 20


def with_counts(rows: DataFrame, counts: dict[str, Column], by: tuple[str, ...], order: str, span: int = SPAN) -> DataFrame:
    """Running counts of conditions within `by`, in the order of a whole number, this row included. A run is counted in ranges of
    that number, so that it isn't one task's however long it is; nulls of `by` are a run too, and null conditions don't count."""
    here = F.floor(F.col(order) / F.lit(span))
    hits = rows.withColumns({"_range": here} | {n: F.coalesce(c, F.lit(False)).cast("bigint") for n, c in counts.items()})
    ranges = hits.groupBy(*by, "_range").agg(*[F.sum(n).alias(f"_all_{n}") for n in counts])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*[F.col(c).alias(f"_of_{c}") for c in (*by, "_range")], *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_from_{n}") for n in counts])
    within = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.lit(True)
    for c in (*by, "_range"):
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    counted = hits.withColumns({n: F.sum(n).over(within) for n in counts}).join(starts, same)
    return counted.withColumns({n: F.col(n) + F.col(f"_from_{n}") for n in counts}).select(*rows.columns, *counts)


def streaks(rows: DataFrame, what: Column, order: str = "seq", by: tuple[str, ...] = ("run_id",), breaks: Column | None = None) -> DataFrame:
    """Runs of rows for which `what` holds, one row each: first and last in the order, and their number. Rows for which neither `what`
    nor `breaks` holds don't end a run; by default every other row does. The order is a whole number."""
    hit = F.coalesce(what, F.lit(False))
    ends = ~hit if breaks is None else F.coalesce(breaks, F.lit(False)) & ~hit
    marked = with_counts(rows.withColumn("_hit", hit), {"_island": ends}, by, order)
    return marked.where("_hit").groupBy(*by, "_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("length")).drop("_island")


def blocks(rows: DataFrame, most: int = 3, most_connection: int = 6) -> DataFrame:
    """Where each run would have stopped: at a challenge, or at the most-th refusal (429 or 403 each for itself) or failed connection
    in a row. A run of refusals ends with an answer that is ok; one of failed connections with any answer."""
    kind = F.col("outcome")
    counted = with_counts(rows.select("run_id", "seq", "outcome"), {"_good": kind == "ok", "_answers": kind != "transport"}, ("run_id",), "seq")
    bad = counted.where(kind.isin("challenge", "rate_limited", "forbidden", "transport"))
    lost = kind == "transport"
    bad = bad.withColumns({"_island": F.when(lost, F.col("_answers")).otherwise(F.col("_good")), "_nth": F.when(kind == "challenge", 1).when(lost, most_connection).otherwise(most)})
    # the nth of an island is among the first n of its ranges, which are few
    islands = ("run_id", "outcome", "_island")
    early = F.row_number().over(Window.partitionBy(*islands, F.floor(F.col("seq") / F.lit(SPAN))).orderBy("seq"))
    bad = bad.withColumn("_early", early).where("_early <= _nth")
    hits = bad.withColumn("_place", F.row_number().over(Window.partitionBy(*islands).orderBy("seq"))).where("_place = _nth")
    reason = F.when(lost, "connection_failure").otherwise("blocked")
    return hits.groupBy("run_id").agg(F.min("seq").alias("seq"), F.min_by(reason, F.col("seq")).alias("reason"))


def slow_factor(rows: DataFrame, groups: int = 4096) -> DataFrame:
    """The slow-down factor at the end of each run: doubled by every 429, 16 at most; halved, 1 at least, by every 50 good answers
    since it last changed that way or a 429 came.

    Good answers are counted between one 429 and the next, and `groups` of these counts make one function on the five factors
    there are; a run's functions are applied in order. So no row holds a run, only a five-number map for each `groups` of its 429s."""
    limited = F.col("outcome") == "rate_limited"
    counted = with_counts(rows.select("run_id", "seq", "outcome"), {"_limited": limited}, ("run_id",), "seq")
    spells = counted.groupBy("run_id", "_limited").agg((F.count_if(F.col("outcome") == "ok") / 50).cast("int").alias("halved"))
    steps = spells.groupBy("run_id", F.floor(F.col("_limited") / groups).alias("part")).agg(F.array_sort(F.collect_list(F.struct("_limited", "halved"))).alias("steps"))

    def step(power: Column, s: Column) -> Column:
        doubled = F.when(s["_limited"] > 0, F.least(F.lit(4), power + 1)).otherwise(power)
        return F.greatest(F.lit(0), doubled - s["halved"])

    maps = steps.select("run_id", "part", F.transform(F.sequence(F.lit(0), F.lit(4)), lambda power: F.aggregate("steps", power, step)).alias("map"))
    runs = maps.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("part", "map"))).alias("maps"))
    return runs.select("run_id", F.pow(F.lit(2.0), F.aggregate("maps", F.lit(0), lambda power, m: F.get(m["map"], power))).alias("slow_factor"))


def pauses(rows: DataFrame, base: float = 5.0, cap: float = 300.0) -> DataFrame:
    """Each 429 with its number in a row (an ok answer ends that) and the seconds that all workers wait: what was asked for, else base
    doubled by that number, capped."""
    limited = F.col("outcome") == "rate_limited"
    counted = with_counts(rows, {"_limited": limited, "_good": F.col("outcome") == "ok"}, ("run_id",), "seq").where(limited)
    first = counted.groupBy(F.col("run_id").alias("_run"), F.col("_good").alias("_island")).agg(F.min("_limited").alias("_first"))
    numbered = counted.join(first, F.col("run_id").eqNullSafe(F.col("_run")) & (F.col("_good") == F.col("_island"))).withColumn("in_a_row", F.col("_limited") - F.col("_first") + 1)
    backed_off = F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), F.col("in_a_row")))
    return numbered.select("run_id", "seq", "in_a_row", F.coalesce(retry_after(header(F.col("headers"), "retry-after")), backed_off).alias("pause"))


def within_limits(rows: DataFrame, most_requests: int = 0, most_pages: int = 0, most_listings: int = 0, page: Column | None = None, listing: Column | None = None) -> DataFrame:
    """The fetches that a run's limits let happen (0: no limit): a request is made as long as fewer requests, pages and listings
    than allowed stand before it. `page` and `listing` tell rows that complete one; by default none does."""
    none = F.lit(False)
    told = {"_requests": F.lit(True), "_pages": none if page is None else page, "_listings": none if listing is None else listing}
    counted = with_counts(rows.withColumns({f"{n}_hit": F.coalesce(c, none).cast("int") for n, c in told.items()}), told, ("run_id",), "seq")
    allowed = F.lit(True)
    for n, most in (("_requests", most_requests), ("_pages", most_pages), ("_listings", most_listings)):
        if most:
            allowed = allowed & (F.col(n) - F.col(f"{n}_hit") < most)
    return counted.where(allowed).select(*rows.columns)


def graphql_outcome(body: Column) -> Column:
    """ok, partial (errors beside data), blocked or permanent, of a GraphQL answer."""
    parsed = F.from_json(body, "data variant, errors array<variant>")
    message = lambda e: F.coalesce(F.try_variant_get(e, "$.message", "string"), F.to_json(e))
    text = F.lower(F.array_join(F.transform(parsed["errors"], message), " "))
    kind = F.schema_of_variant(parsed["data"])
    has_data = F.coalesce(parsed["data"].isNotNull() & ~kind.isin("VOID", "OBJECT<>"), F.lit(False))
    failed = F.coalesce(F.size(parsed["errors"]) > 0, F.lit(False))
    return F.when(failed & _any(text, BLOCK_WORDS), "blocked").when(failed & ~has_data, "permanent").when(failed, "partial").otherwise("ok")


def robots_rule(status: Column) -> Column:
    """What a robots.txt answer means: its rules hold, all is allowed, or nothing may be read."""
    return F.when(status < 400, "rules").when((status < 500) & ~status.isin(408, 425, 429), "allow_all").otherwise("block")


def robots_allows(robots: Column, url: Column, agent: str) -> Column:
    """Whether the rules of a robots.txt text allow an agent a url; null text: everything. The standard library reads the rules, once for each text of a batch."""

    @F.pandas_udf("boolean")
    def allows(texts: pd.Series, urls: pd.Series) -> pd.Series:
        rules: dict[str, RobotFileParser] = {}
        for text in texts.dropna().unique():
            rules[text] = RobotFileParser()
            rules[text].parse(text.splitlines())
        return pd.Series([text not in rules or url is None or rules[text].can_fetch(agent, url) for text, url in zip(texts, urls, strict=True)])

    return allows(robots, url)


def exit_code(reason: Column) -> Column:
    """The exit code of a run that stopped for a reason; null for other reasons."""
    known = F.create_map(*[F.lit(x) for kv in EXIT_CODES.items() for x in kv])
    return F.try_element_at(known, reason)


def run_stats(rows: DataFrame) -> DataFrame:
    """Requests, good and failed answers, seconds and requests a second of each run; rows need a timestamp `at`."""
    seconds = F.unix_micros(F.max("at").cast("timestamp")) / 1e6 - F.unix_micros(F.min("at").cast("timestamp")) / 1e6
    out = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("requests"), F.count_if(F.col("outcome") == "ok").alias("good"), F.count_if(F.col("outcome") != "ok").alias("bad"), seconds.alias("elapsed"))
    return out.withColumn("rate", F.col("requests") / F.greatest(F.col("elapsed"), F.lit(1e-9)))
