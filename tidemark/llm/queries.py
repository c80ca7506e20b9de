"""The queries of the training-data operators on the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, jaccard_join, packing, quality_classifier, quality_rules, substring_dedup, token_counts, toxicity, url_filter
from tidemark.llm.common import documents


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"), url_filter.rule_table(spark))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), decode=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(documents(spark, sf_dir), labels(spark, sf_dir))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(documents(spark, sf_dir))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removals(documents(spark, sf_dir)).drop("mark")


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op6_jaccard_join": op6_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_quality_classifier": op9_quality_classifier,
    "op2_bpe": op2_bpe,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op7_token_counts": op7_token_counts,
    "op3_exact_dedup": op3_exact_dedup,
    "op10_url_filters": op10_url_filters,
}

#: The words of each text, which `text` gives.
WORDS = """w AS (SELECT doc_id, list_filter(regexp_split_to_array({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words FROM documents)"""
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
GAMMA = (1 + quality_rules.ALPHA) / (1 - quality_rules.ALPHA)


def _value(bucket: str) -> str:
    return f"CASE WHEN {bucket} = 0 THEN 0.0 ELSE 2 * pow({GAMMA!r}, {bucket} - 1) / ({GAMMA!r} + 1) END"


def _level(name: str, by: str) -> str:
    """SQL of a level's fences: rate, fence, weight for each group."""
    upper = "CASE rate " + " ".join(f"WHEN '{n}' THEN {q!r}::DOUBLE" for n, q in quality_rules.UPPER.items()) + " END"
    own = f"PARTITION BY {by} rate"
    return f"""{name} AS (SELECT {by} rate, CASE WHEN low > 0 THEN high * pow(high / low, {quality_rules.SPREAD}) ELSE top END AS fence, (CASE WHEN low > 0 THEN total ELSE positive END)::DOUBLE AS weight
        FROM (SELECT {by} rate, max(total) AS total, max(total) - max(zeros) AS positive, {_value("min(bucket) FILTER (upto >= ceil(total * 0.25::DOUBLE))")} AS low, {_value("min(bucket) FILTER (upto >= ceil(total * 0.75::DOUBLE))")} AS high,
                {_value("min(bucket) FILTER (bucket > 0 AND upto - zeros >= ceil((total - zeros) * q))")} AS top
            FROM (SELECT *, {upper} AS q, sum(c) OVER ({own} ORDER BY bucket) AS upto, sum(c) OVER ({own}) AS total, coalesce(sum(c) FILTER (bucket = 0) OVER ({own}), 0) AS zeros
                FROM (SELECT {by} rate, bucket, count(*) AS c FROM b GROUP BY ALL)) GROUP BY {by} rate))"""


def _shrunk(fence: str, weight: str, wider: str) -> str:
    return f"coalesce(({weight} * {fence} + {quality_rules.PRIOR} * {wider}) / ({weight} + {quality_rules.PRIOR}), {wider}, {fence})"


ORACLE_SQL = {
    "op4_quality_rules": f"""
        WITH {WORDS.format(text="coalesce(text, '')")},
        p AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS place FROM w WHERE len(words) >= 8),
        v AS (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, array_to_string(words[place : place + 7], ' ')) AS c FROM p),
        r AS (SELECT doc_id, count(DISTINCT place + j) AS n FROM v, generate_series(0, 7) AS g(j) WHERE c > 1 GROUP BY doc_id),
        l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup, count(*) AS n FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY doc_id),
        m AS (SELECT d.doc_id, d.lang, d.source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
                length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines
            FROM documents d JOIN w USING (doc_id) LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
        x AS (UNPIVOT (SELECT doc_id, lang, source, n_symbols * 1000 // greatest(n_words, 1) AS symbol_rate, n_dup_lines * 1000 // greatest(n_lines, 1) AS dup_rate,
                n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_rate, word_chars * 1000 // greatest(n_words, 1) AS word_size FROM m) ON symbol_rate, dup_rate, repeat_rate, word_size INTO NAME rate VALUE value),
        b AS (SELECT x.*, CASE WHEN value < 1 THEN 0 ELSE 1 + ceil(ln(value) / ln({GAMMA!r})) END AS bucket FROM x JOIN m USING (doc_id) WHERE NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)),
        {_level("g", "lang, source,")}, {_level("h", "lang,")}, {_level("a", "")},
        k AS (SELECT h.lang, h.rate, {_shrunk("h.fence", "h.weight", "a.fence")} AS fence FROM h JOIN a USING (rate)),
        f AS (SELECT x.doc_id, coalesce(bool_or(x.value > {_shrunk("g.fence", "g.weight", "k.fence")}), false) AS above FROM x
            LEFT JOIN g ON x.rate = g.rate AND x.lang IS NOT DISTINCT FROM g.lang AND x.source IS NOT DISTINCT FROM g.source
            LEFT JOIN k ON x.rate = k.rate AND x.lang IS NOT DISTINCT FROM k.lang GROUP BY x.doc_id)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT above AS kept
        FROM m JOIN f USING (doc_id)
    """,
    "op6_jaccard_join": f"""
        WITH RECURSIVE {WORDS.format(text=FOLDED)},
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4 THEN list_transform(generate_series(1, len(words) - 3), lambda i: array_to_string(words[i : i + 3], ' ')) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL) p
            JOIN n i ON i.doc_id = p.a JOIN n j ON j.doc_id = p.b WHERE 100 * c >= 85 * (i.n + j.n - c)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM c LEFT JOIN n USING (doc_id)
    """,
    "op3_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY x)
    """,
    "op10_url_filters": """
        WITH p AS (
            SELECT page_id, url,
                translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        r(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        f AS (
            SELECT p.page_id, p.url, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
                row_number() OVER (PARTITION BY p.page_id, p.url ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS nth
            FROM p LEFT JOIN r ON (p.host = r.rule_host OR p.host LIKE '%.' || r.rule_host) AND starts_with(p.path, r.rule_path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE nth = 1
    """,
}
