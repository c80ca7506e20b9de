import random

from pyspark.sql import functions as F

from tidemark.operators import fetchlog
from tidemark.sources.schemas import FETCH_LOG

HTML = {"Content-Type": "text/html"}


def rows(spark, *answers, run="r"):
    return spark.createDataFrame([(run, i, a.get("url", "u"), a.get("status"), a.get("headers", {}), a.get("body", ""), a.get("error")) for i, a in enumerate(answers)], FETCH_LOG)


def outcomes(spark, *answers):
    return [r.outcome for r in fetchlog.classified(rows(spark, *answers)).orderBy("seq").collect()]


def test_outcomes(spark):
    assert outcomes(spark, {"status": 200}, {"status": 503}, {"status": 404}, {"status": 429}, {"status": 403}, {"error": "ConnectError"}) == ["ok", "retryable", "permanent", "rate_limited", "forbidden", "transport"]


def test_challenges(spark):
    big = "x" * 30_000
    got = outcomes(
        spark, {"status": 200, "headers": HTML, "body": "<Title>Just a moment"}, {"status": 200, "headers": HTML, "body": "captcha"}, {"status": 200, "headers": HTML, "body": big + "captcha"},
        {"status": 200, "headers": {"CF-Mitigated": "Challenge"}}, {"status": 200, "headers": {"content-type": "application/json"}, "body": "captcha"}, {"status": 500, "headers": HTML, "body": big + "hcaptcha"},
    )
    assert got == ["challenge", "challenge", "ok", "challenge", "ok", "challenge"]


def test_blocks_and_streaks(spark):
    limited = [{"status": 429}] * 2
    assert fetchlog.blocks(fetchlog.classified(rows(spark, *limited, {"status": 200}, *limited))).count() == 0
    hit = fetchlog.blocks(fetchlog.classified(rows(spark, *limited, {"status": 404}, {"status": 429}))).first()
    assert (hit.seq, hit.reason) == (3, "blocked")
    lost = fetchlog.blocks(fetchlog.classified(rows(spark, *[{"error": "e"}] * 6))).first()
    assert (lost.seq, lost.reason) == (5, "connection_failure")


def test_retries_waits_and_slowing(spark):
    log = fetchlog.classified(rows(spark, {"status": 503}, {"status": 503, "headers": {"Retry-After": "7"}}, {"status": 200}))
    assert [r.wait for r in log.orderBy("seq").collect()] == [5.0, 7.0, None]
    assert [(r.attempt, r.outcome) for r in fetchlog.final_attempts(log).collect()] == [(3, "ok")]
    five = fetchlog.classified(rows(spark, *[{"status": 500}] * 5))
    assert [(r.attempt, r.outcome) for r in fetchlog.final_attempts(five).collect()] == [(4, "retryable")]
    slow = fetchlog.slow_factor(fetchlog.classified(rows(spark, {"status": 429}, {"status": 429}, *[{"status": 200}] * 50)))
    assert slow.first().slow_factor == 2.0


def test_headers_and_answers(values):
    assert values(fetchlog.retry_after(F.col("x")), ["5", "-1", "Wed, 21 Oct 2026 07:28:00 GMT", None]) == [5.0, 0.0, None, None]
    bodies = ['{"data":{"a":1}}', '{"data":null,"errors":[{"message":"bad"}]}', '{"data":{"a":1},"errors":[{"message":"x"}]}', '{"errors":[{"message":"Throttled"}]}', '{"data":{}}']
    assert values(fetchlog.graphql_outcome(F.col("x")), bodies) == ["ok", "permanent", "partial", "blocked", "ok"]
    assert values(fetchlog.robots_rule(F.col("x")), [200, 404, 429, 503], "int") == ["rules", "allow_all", "block", "block"]


def folded(events):
    """The slow-down factor, one answer after the other."""
    factor, good = 1.0, 0
    for e in events:
        if e == 429:
            factor, good = min(16.0, factor * 2), 0
        elif e == 200:
            good += 1
            if good >= 50 and factor > 1:
                factor, good = max(1.0, factor / 2), 0
    return factor


def test_slow_factor_of_long_runs(spark):
    dice = random.Random(5)
    runs = {f"r{k}": [dice.choice([429] + [200] * dice.choice([3, 60, 200]) + [404]) for _ in range(600)] for k in range(8)} | {"none": [200] * 70, None: [429] * 9}
    log = spark.createDataFrame([(k, i, f"u{i}", s, {}, "", None) for k, v in runs.items() for i, s in enumerate(v)], FETCH_LOG)
    got = {r.run_id: r.slow_factor for r in fetchlog.slow_factor(fetchlog.classified(log), groups=3).collect()}
    assert got == {k: folded(v) for k, v in runs.items()}
    assert fetchlog.slow_factor(fetchlog.classified(log.limit(0))).count() == 0


def test_counts_in_ranges(spark):
    dice = random.Random(6)
    rows = [(k, i * 3 - 40, dice.choice([True, False, None])) for k in ("a", "b", None) for i in range(60)]
    df = spark.createDataFrame(rows, "run_id string, seq bigint, hit boolean")
    got = fetchlog.with_counts(df, {"n": F.col("hit")}, ("run_id",), "seq", span=7).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n == sum(bool(h) for k, s, h in rows if k == r.run_id and s <= r.seq)


def test_limits_pauses_rules_and_codes(spark, values):
    log = fetchlog.classified(rows(spark, {"status": 429}, {"status": 429, "headers": {"retry-after": "9"}}, {"status": 404}, {"status": 429}, {"status": 200}, {"status": 429}))
    assert [(r.seq, r.in_a_row, r.pause) for r in fetchlog.pauses(log).orderBy("seq").collect()] == [(0, 1, 10.0), (1, 2, 9.0), (3, 3, 40.0), (5, 1, 10.0)]
    kept = lambda **limits: [r.seq for r in fetchlog.within_limits(log, **limits).orderBy("seq").collect()]
    assert kept() == [0, 1, 2, 3, 4, 5] and kept(most_requests=2) == [0, 1]
    assert kept(most_listings=1, listing=F.col("outcome") == "ok") == [0, 1, 2, 3, 4] and kept(most_pages=1, page=F.col("status") == 404) == [0, 1, 2]
    rules = "User-agent: *\nDisallow: /private\n\nUser-agent: bot\nDisallow: /"
    asked = F.concat(F.lit("https://a.example.com"), F.col("x"))
    assert values(fetchlog.robots_allows(F.lit(rules), asked, "reader"), ["/private/1", "/open", None]) == [False, True, True]
    assert values(fetchlog.robots_allows(F.lit(rules), asked, "bot"), ["/open"]) == [False]
    assert values(fetchlog.robots_allows(F.lit(None).cast("string"), asked, "bot"), ["/open"]) == [True]
    assert values(fetchlog.exit_code(F.col("x")), ["blocked", "completed", "?", None]) == [3, 0, None, None]
