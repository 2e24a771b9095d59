"""Queries of spend and latency analytics, over logs derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import telemetry as op
from ..sources.series import append_series
from ..staging import new_path
from .fixtures import table

#: Prices a million tokens: one group is free, one unknown.
PRICES = [("click", 0.15, 0.47), ("view", 2.0, 6.0), ("signup", 0.0, 0.0), ("purchase", 0.4, None)]


def prices(spark):
    return spark.createDataFrame(PRICES, "group string, price_in double, price_out double")


def calls(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.concat("event_type", F.lit("-fast"))).otherwise(F.col("event_type")).alias("model_group"),
        F.floor(F.col("value") * 10).cast("long").alias("prompt_tokens"),
        F.col("user_id").alias("completion_tokens"),
        k.alias("cached_tokens"),
        (F.col("value") / 1000).alias("spend"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "ts",
        F.when(k % 3 == 0, F.lit(True)).when(k % 3 == 1, F.lit(False)).alias("cache_hit"),
    )


def priced(spark, d):
    return op.with_prices(calls(spark, d), prices(spark))


def log_lines(spark, d):
    """JSON lines of a search log, with staleness events, noise and blanks among them."""
    e = table(spark, d, "events")
    number = F.format_string("%.2f", "value")
    search = F.concat(
        F.lit('{"event": "rag_search", "ts": 1.5, "profile": "'), F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("event_type")),
        F.lit('", "latency_ms": '), number, F.lit(', "slo_breach": '), F.when(F.col("value") > 200, "true").otherwise("false"),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(', "kind": "'), F.col("event_type"), F.lit('"'))).otherwise(""),
        F.when(F.col("event_type") == "error", F.lit(', "status": "error:X"}')).otherwise("}"),
    )
    stale = F.concat(F.lit('{"event": "rag_search_staleness", "staleness_ms": '), number, F.lit(', "stale": '), F.when(F.col("value") > 250, "true").otherwise("false"), F.lit("}"))
    odd = F.element_at(F.array(F.lit("not json"), F.lit("[1, 2]"), F.lit('{"event": "other"}'), F.lit("  "), F.lit('{"event": "rag_search", "latency_ms": "x"}')), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select("event_id", F.when(F.col("event_id") % 23 == 0, odd).when(F.col("event_id") % 7 == 0, stale).otherwise(search).alias("value"))


def searches(spark, d):
    return op.parse_events(log_lines(spark, d)).where("type = 'search'")


def stress(spark, d):
    codes = F.when(F.col("event_type") == "error", 500).when(F.col("user_id") % 17 == 0, 429).otherwise(200)
    return table(spark, d, "events").select(F.pmod("user_id", F.lit(20)).alias("grp"), codes.alias("status_code"), F.col("value").alias("latency_ms"))



def spend_totals(spark, d):
    return op.spend_metrics(priced(spark, d))


def spend_by_group(spark, d):
    return op.spend_metrics(priced(spark, d), "model_group").orderBy("model_group")


def spend_by_day(spark, d):
    return op.spend_metrics(priced(spark, d), "day").orderBy("day")


def spend_in_scope(spark, d):
    c = op.scoped(calls(spark, d), prefix="cl", since="2024-01-05")
    return op.spend_metrics(op.with_prices(c, prices(spark)), "model_group", "day")


def spend_log_parse(spark, d):
    c = calls(spark, d)
    line = F.when(F.col("event_id") % 11 == 0, F.lit("noise {")).otherwise(
        F.concat(F.lit('{"model_group": "'), F.col("model_group"), F.lit('", "prompt_tokens": "'), F.col("prompt_tokens").cast("string"),
                 F.lit('.0", "completion_tokens": null, "cached": '), F.col("cached_tokens").cast("string"), F.lit(', "spend": 0.25, "startTime": "2024-02-03T04:05:06", "cache_hit": "'),
                 F.when(F.col("cached_tokens") % 2 == 0, "True").otherwise("no"), F.lit('"}')))
    return op.parse_spend_log(c.select(line.alias("value"))).groupBy("model_group", "day", "cache_hit").agg(
        F.count(F.lit(1)).alias("n"), F.sum("prompt_tokens").alias("prompt"), F.sum("completion_tokens").alias("completion"), F.sum("cached_tokens").alias("cached"), F.round(F.sum("spend"), 6).alias("spend"))


def uncached_percentiles(spark, d):
    return op.uncached_stats(priced(spark, d), "model_group")


def cache_hit_tristate(spark, d):
    return op.cache_hits(calls(spark, d), "model_group")


def latency_slo(spark, d):
    return op.latency_stats(searches(spark, d))


def latency_by_kind(spark, d):
    return op.latency_stats(searches(spark, d), op.or_null_bucket("kind").alias("kind")).orderBy("kind")


def latency_by_profile(spark, d):
    return op.latency_stats(searches(spark, d), op.or_null_bucket("profile").alias("profile")).orderBy("profile")


def search_errors(spark, d):
    return searches(spark, d).where("status <> 'ok'").groupBy("status").agg(F.count(F.lit(1)).alias("calls"))


def staleness_stats(spark, d):
    e = op.parse_events(log_lines(spark, d)).where("type = 'staleness'")
    return e.agg(F.count(F.lit(1)).alias("n"), op.pct_floor("staleness_ms", 0.5).alias("p50"), op.pct_floor("staleness_ms", 0.95).alias("p95"), F.count_if("stale").alias("stale"))


def event_types(spark, d):
    return op.parse_events(log_lines(spark, d)).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def slo_alert(spark, d):
    stats = op.latency_stats(searches(spark, d), op.or_null_bucket("kind").alias("kind"))
    return op.slo_alerts(stats, 1.35).select("kind", "calls", "breaches", "breach_rate")


def stress_summary(spark, d):
    return op.stress_verdict(op.stress_summary(stress(spark, d), "grp"), 0.25, allow_degraded=True)


def concurrency_summary(spark, d):
    s = op.stress_summary(stress(spark, d), "grp").select("grp", "n", "ok", "p50_ms", "p95_ms")
    return op.concurrency_verdict(s, all_ok=False)


def stress_errors(spark, d):
    return op.error_histogram(stress(spark, d), "grp")


def cost_series(spark, d):
    """A snapshot of the spend for each of three days, appended to one series; the one of the first day is lost, as the series
    was damaged before the second was taken."""
    calls, path = priced(spark, d), new_path(spark, "series")
    for n, day in enumerate(("2024-01-10", "2024-01-20", "2024-01-31")):
        if n == 1:
            spark.range(1).select(F.lit('{"taken_at": "2024-01-').alias("value")).write.mode("append").text(path)
        series = append_series(op.cost_snapshots(calls.where(F.col("day") <= day), day), path)
    return series


def cost_snapshot(spark, d):
    return op.cost_snapshots(priced(spark, d), "2024-03-01")


_NAMES = """spend_totals spend_by_group spend_by_day spend_in_scope spend_log_parse uncached_percentiles cache_hit_tristate latency_slo latency_by_kind
latency_by_profile search_errors staleness_stats event_types slo_alert stress_summary concurrency_summary stress_errors cost_snapshot cost_series""".split()
QUERIES = {n: globals()[n] for n in _NAMES}

_CALLS = """k AS (SELECT *, (props::JSON->>'k')::BIGINT AS k FROM events),
calls AS (SELECT event_id, event_type || CASE WHEN event_id % 5 = 0 THEN '-fast' ELSE '' END AS model_group, floor(value * 10)::BIGINT AS prompt_tokens,
  user_id AS completion_tokens, k AS cached_tokens, value / 1000 AS spend, strftime(ts, '%Y-%m-%d') AS day, ts,
  CASE WHEN k % 3 = 0 THEN true WHEN k % 3 = 1 THEN false END AS cache_hit FROM k),
prices(grp, price_in, price_out) AS (VALUES ('click', 0.15::DOUBLE, 0.47::DOUBLE), ('view', 2.0, 6.0), ('signup', 0.0, 0.0), ('purchase', 0.4, NULL)),
priced AS (SELECT calls.*, price_in, coalesce(price_out, price_in) AS price_out FROM calls LEFT JOIN prices ON replace(model_group, '-fast', '') = grp)"""


def _spend(by: str, source: str = "priced") -> str:
    cols = f"{by}, " if by else ""
    return f"""SELECT {cols}calls, p::BIGINT AS prompt_tokens, c::BIGINT AS completion_tokens, h::BIGINT AS cached_tokens, round(s, 6) AS spend, round(f, 6) AS no_cache,
  round(CASE WHEN p <= 0 THEN 0.0 ELSE h::DOUBLE / p END, 6) AS hit_rate, round(CASE WHEN f <= 0 THEN 0 ELSE f - s END, 6) AS savings,
  round(CASE WHEN f <= 0 THEN 0 ELSE (f - s) / f * 100 END, 6) AS savings_pct
  FROM (SELECT {cols}count(*) AS calls, sum(prompt_tokens) AS p, sum(completion_tokens) AS c, sum(cached_tokens) AS h, sum(spend) AS s,
    coalesce(sum((prompt_tokens * price_in + completion_tokens * price_out) / 1e6), 0) AS f FROM {source} {'GROUP BY ' + by if by else ''})"""


def _ceil(x: str, p: float) -> str:
    return f"list_sort(list({x}) FILTER ({x} IS NOT NULL))[greatest(1, ceil({p}::DOUBLE * count({x})))::INT]"


def _floor(x: str, p: float) -> str:
    return f"list_sort(list({x}))[least(count(*), floor(count(*) * {p}::DOUBLE) + 1)::INT]"


_SEARCHES = """e AS (SELECT event_id, value AS raw, round(value, 2) AS v, event_type, CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS profile,
  CASE WHEN event_id % 3 = 0 THEN event_type END AS kind, CASE WHEN event_type = 'error' THEN 'error:X' ELSE 'ok' END AS status FROM events),
s AS (SELECT *, format('{:.2f}', raw)::DOUBLE AS latency_ms, raw > 200 AS slo_breach FROM e WHERE event_id % 23 <> 0 AND event_id % 7 <> 0)"""


def _latency(by: str) -> str:
    cols = f"coalesce(nullif({by}, ''), '(null)') AS {by}, " if by else ""
    return f"""WITH {_SEARCHES} SELECT {cols}count(*) AS calls, {_floor('latency_ms', 0.5)} AS p50, {_floor('latency_ms', 0.9)} AS p90, {_floor('latency_ms', 0.95)} AS p95,
  max(latency_ms) AS max, count_if(slo_breach)::BIGINT AS breaches, round(count_if(slo_breach)::DOUBLE / count(*), 6) AS breach_rate FROM s {'GROUP BY ALL' if by else ''}"""


_STRESS = """r AS (SELECT user_id % 20 AS grp, CASE WHEN event_type = 'error' THEN 500 WHEN user_id % 17 = 0 THEN 429 ELSE 200 END AS status_code, value AS latency_ms,
  CASE WHEN event_type <> 'error' AND user_id % 17 <> 0 THEN value END AS fine FROM events)"""
_SUMMARY = f"""WITH {_STRESS}, g AS (SELECT grp, count(*) AS n, count(fine) AS ok, {_ceil('fine', 0.5)} AS p50_ms, {_ceil('fine', 0.95)} AS p95_ms, {_ceil('fine', 0.99)} AS p99_ms,
  sum(latency_ms) AS t FROM r GROUP BY grp)"""

ORACLE_SQL = {
    "spend_totals": f"WITH {_CALLS} {_spend('')}",
    "spend_by_group": f"WITH {_CALLS} {_spend('model_group')}",
    "spend_by_day": f"WITH {_CALLS} {_spend('day')}",
    "spend_in_scope": f"WITH {_CALLS}, sc AS (SELECT * FROM priced WHERE starts_with(model_group, 'cl') AND ts >= '2024-01-05') {_spend('model_group, day', 'sc')}",
    "spend_log_parse": f"""WITH {_CALLS} SELECT model_group, '2024-02-03' AS day, cached_tokens % 2 = 0 AS cache_hit, count(*) AS n, sum(prompt_tokens)::BIGINT AS prompt,
        0::BIGINT AS completion, sum(cached_tokens)::BIGINT AS cached, round(count(*) * 0.25::DOUBLE, 6) AS spend FROM calls WHERE event_id % 11 <> 0 GROUP BY ALL""",
    "uncached_percentiles": f"""WITH {_CALLS}, u AS (SELECT *, greatest(0, prompt_tokens - cached_tokens) AS u FROM priced)
        SELECT model_group, count(*) AS calls, sum(u)::BIGINT AS total, round(avg(u), 6) AS mean, {_ceil('u', 0.5)} AS p50, {_ceil('u', 0.9)} AS p90, {_ceil('u', 0.95)} AS p95,
        max(u) AS max, round(coalesce(sum(u * price_in / 1e6), 0), 6) AS cost FROM u GROUP BY model_group""",
    "cache_hit_tristate": f"""WITH {_CALLS} SELECT model_group, count_if(cache_hit)::BIGINT AS hits, count_if(NOT cache_hit)::BIGINT AS misses, count_if(cache_hit IS NULL)::BIGINT AS unknown,
        round(count_if(cache_hit)::DOUBLE / nullif(count(cache_hit), 0), 6) AS hit_rate FROM calls GROUP BY model_group""",
    "latency_slo": _latency(""),
    "latency_by_kind": _latency("kind"),
    "latency_by_profile": _latency("profile"),
    "search_errors": f"WITH {_SEARCHES} SELECT status, count(*) AS calls FROM s WHERE status <> 'ok' GROUP BY status",
    "staleness_stats": f"""WITH t AS (SELECT format('{{:.2f}}', value)::DOUBLE AS ms, value > 250 AS stale FROM events WHERE event_id % 23 <> 0 AND event_id % 7 = 0)
        SELECT count(*) AS n, {_floor('ms', 0.5)} AS p50, {_floor('ms', 0.95)} AS p95, count_if(stale)::BIGINT AS stale FROM t""",
    "event_types": """SELECT CASE WHEN event_id % 23 = 0 THEN 'malformed' WHEN event_id % 7 = 0 THEN 'staleness' ELSE 'search' END AS type, count(*) AS n
        FROM events WHERE NOT (event_id % 23 = 0 AND event_id % 5 = 3) GROUP BY ALL""",
    "slo_alert": f"SELECT kind, calls, breaches, breach_rate FROM ({_latency('kind')}) WHERE breach_rate * 100 > 1.35",
    "stress_summary": f"""{_SUMMARY} SELECT grp, n, ok, p50_ms, p95_ms, p99_ms, round((n - ok)::DOUBLE / n, 6) AS error_rate, round(n / (t / 1000.0), 6) AS serial_rps,
        coalesce(p95_ms > 2 * p50_ms, false) AS degraded, round((n - ok)::DOUBLE / n, 6) <= 0.25 AS passed FROM g""",
    "concurrency_summary": f"{_SUMMARY} SELECT grp, n, ok, p50_ms, p95_ms, ok >= 1 AS passed FROM g",
    "stress_errors": f"WITH {_STRESS} SELECT grp, status_code, count(*) AS n FROM r WHERE status_code <> 200 GROUP BY ALL",
    "cost_series": f"WITH {_CALLS}"
    + " UNION ALL ".join(
        f" SELECT '{day}' AS taken_at, calls, spend, no_cache, savings, hit_rate FROM ({_spend('', '(SELECT * FROM priced WHERE day <= ' + chr(39) + day + chr(39) + ')')})"
        for day in ("2024-01-20", "2024-01-31")
    ),
    "cost_snapshot": f"WITH {_CALLS} SELECT '2024-03-01' AS taken_at, calls, spend, no_cache, savings, hit_rate FROM ({_spend('')})",
}
