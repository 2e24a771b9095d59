"""Spend and latency analytics over call logs and search logs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tri_state
from ..staging import stage

SLO_MS, ALERT_PERCENT = 200.0, 50.0


def pct_ceil(value: str, p: float) -> Column:
    """Nearest-rank percentile: the value of rank max(1, ceil(p * n)); null for no values. Keeps a count for each
    value of a group in one task; :func:`large_percentiles` doesn't."""
    return F.expr(f"percentile_disc({p!r}D) WITHIN GROUP (ORDER BY {value})")


def pct_floor(value: str, p: float) -> Column:
    """The value at 0-based place floor(n * p), the last one at most; null for no values.

    That is the rank above n * p, so a share greater by less than 1 / n turns the ceil rule into this one.
    """
    return pct_ceil(value, min(1.0, p + 1e-12))


def scoped(calls: DataFrame, everything: bool = False, models: list[str] | None = None, model: str | None = None,
           prefix: str = "", since=None) -> DataFrame:
    """Rows in scope: all, else a list of groups, else one group, else a prefix; and not before ``since``."""
    if not everything:
        group = F.col("model_group")
        calls = calls.where(group.isin(*models) if models else group == model if model else group.startswith(prefix))
    return calls if since is None else calls.where(F.col("ts") >= F.lit(since))


def parse_spend_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Call rows from JSON lines: alternative keys, numbers read tolerantly, a cache flag of three states; noise is left out."""
    doc = F.get_json_object
    line = F.col(column)
    number = lambda *paths: F.coalesce(*[doc(line, p).try_cast("double").try_cast("long") for p in paths], F.lit(0).cast("long"))
    return lines.where(F.trim(line).startswith("{") & F.try_parse_json(line).isNotNull()).select(
        F.coalesce(doc(line, "$.model_group"), doc(line, "$.model"), F.lit("")).alias("model_group"),
        number("$.prompt_tokens").alias("prompt_tokens"),
        number("$.completion_tokens").alias("completion_tokens"),
        number("$.cached_tokens", "$.cached").alias("cached_tokens"),
        F.coalesce(doc(line, "$.spend").try_cast("double"), F.lit(0.0)).alias("spend"),
        F.substring(F.coalesce(doc(line, "$.day"), doc(line, "$.startTime"), F.lit("")), 1, 10).alias("day"),
        tri_state(doc(line, "$.cache_hit")).alias("cache_hit"),
    )


def with_prices(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """``calls`` with price_in and price_out (a million tokens) of the group without ``-fast``; null where unknown."""
    key = F.replace(F.col("model_group"), F.lit("-fast"), F.lit(""))
    table = prices.select(F.col("group").alias("__group"), "price_in", F.coalesce("price_out", "price_in").alias("price_out"))
    return calls.join(table, key == F.col("__group"), "left").drop("__group")


def spend_metrics(priced: DataFrame, *by: str) -> DataFrame:
    """Totals, hit rate, the cost without a cache (unknown prices left out) and what the cache saved."""
    projected = (F.col("prompt_tokens") * F.col("price_in") + F.col("completion_tokens") * F.col("price_out")) / 1e6
    sums = priced.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
        F.coalesce(F.sum("cached_tokens"), F.lit(0)).alias("cached_tokens"),
        F.coalesce(F.sum("spend"), F.lit(0.0)).alias("spend"),
        F.coalesce(F.sum(projected), F.lit(0.0)).alias("no_cache"),
    )
    saved = F.when(F.col("no_cache") <= 0, 0.0).otherwise(F.col("no_cache") - F.col("spend"))
    return sums.select(
        *by, "calls", "prompt_tokens", "completion_tokens", "cached_tokens", F.round("spend", 6).alias("spend"),
        F.round("no_cache", 6).alias("no_cache"),
        F.round(F.when(F.col("prompt_tokens") <= 0, 0.0).otherwise(F.try_divide(F.col("cached_tokens").cast("double"), F.col("prompt_tokens"))), 6).alias("hit_rate"),
        F.round(saved, 6).alias("savings"),
        F.round(F.coalesce(F.try_divide(saved, F.when(F.col("no_cache") > 0, F.col("no_cache"))) * 100, F.lit(0.0)), 6).alias("savings_pct"),
    )


def uncached_stats(priced: DataFrame, *by: str) -> DataFrame:
    """Prompt tokens that the cache didn't serve: total, mean, percentiles by ceil rank, maximum and cost."""
    rows = priced.withColumn("u", F.greatest(F.lit(0).cast("long"), F.col("prompt_tokens") - F.col("cached_tokens")))
    zero = F.lit(0).cast("long")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"), F.coalesce(F.sum("u"), zero).alias("total"), F.round(F.coalesce(F.avg("u"), F.lit(0.0)), 6).alias("mean"),
        *[F.coalesce(pct_ceil("u", p / 100).cast("long"), zero).alias(f"p{p}") for p in (50, 90, 95)],
        F.coalesce(F.max("u"), zero).alias("max"), F.round(F.coalesce(F.sum(F.col("u") * F.col("price_in") / 1e6), F.lit(0.0)), 6).alias("cost"),
    )


def cache_hits(calls: DataFrame, *by: str) -> DataFrame:
    """Hits, misses and calls without data of the response cache; the rate leaves the last out."""
    sums = calls.groupBy(*by).agg(
        F.count_if(F.col("cache_hit")).alias("hits"),
        F.count_if(~F.col("cache_hit")).alias("misses"),
        F.count_if(F.col("cache_hit").isNull()).alias("unknown"),
    )
    rate = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("hits") + F.col("misses")), F.lit(0.0))
    return sums.withColumn("hit_rate", F.round(rate, 6))


#: The events of a search log; other lines that aren't blank are malformed.
EVENT_SCHEMA = (
    "event STRING, ts DOUBLE, repo STRING, profile STRING, kind STRING, latency_ms DOUBLE, slo_ms DOUBLE, slo_breach BOOLEAN, "
    "status STRING, n_results INT, staleness_ms DOUBLE, stale BOOLEAN, _bad STRING"
)


def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row for each line that isn't blank: ``type`` is search, staleness or malformed, with the event's fields and defaults."""
    parsed = F.from_json(F.col(column), EVENT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.where(F.trim(F.col(column)) != "").withColumn("e", parsed)
    known = F.when(F.col("e._bad").isNotNull(), "malformed").when(F.col("e.event") == "rag_search", "search").when(
        F.col("e.event") == "rag_search_staleness", "staleness"
    )
    return rows.select(
        F.coalesce(known, F.lit("malformed")).alias("type"),
        F.coalesce("e.ts", F.lit(0.0)).alias("ts"), F.coalesce("e.repo", F.lit("")).alias("repo"), F.coalesce("e.profile", F.lit("")).alias("profile"),
        F.col("e.kind").alias("kind"), F.coalesce("e.latency_ms", F.lit(0.0)).alias("latency_ms"), F.coalesce("e.slo_ms", F.lit(SLO_MS)).alias("slo_ms"),
        F.coalesce("e.slo_breach", F.lit(False)).alias("slo_breach"), F.coalesce("e.status", F.lit("ok")).alias("status"),
        F.coalesce("e.n_results", F.lit(0)).alias("n_results"), F.coalesce("e.staleness_ms", F.lit(0.0)).alias("staleness_ms"),
        F.coalesce("e.stale", F.lit(False)).alias("stale"),
    )


def or_null_bucket(c: str) -> Column:
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("(null)"))


def latency_stats(searches: DataFrame, *by: Column) -> DataFrame:
    """Calls, percentiles by floor index, maximum, breaches and their share."""
    zero = F.lit(0.0)
    return searches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"), *[F.coalesce(pct_floor("latency_ms", p / 100), zero).alias(f"p{p}") for p in (50, 90, 95)],
        F.coalesce(F.max("latency_ms"), zero).alias("max"), F.count_if("slo_breach").alias("breaches"),
        F.round(F.coalesce(F.try_divide(F.count_if("slo_breach").cast("double"), F.count(F.lit(1))), zero), 6).alias("breach_rate"),
    )


def slo_alerts(stats: DataFrame, percent: float = ALERT_PERCENT) -> DataFrame:
    """Those rows of latency_stats whose share of breaches is over ``percent``."""
    return stats.where(F.col("breach_rate") * 100 > percent)


def stress_summary(results: DataFrame, *by: str) -> DataFrame:
    """Calls by status: percentiles of the successful ones, error share, serial rate, whether the tail is long."""
    results = results.withColumn("__fine", F.when(F.col("status_code") == 200, F.col("latency_ms")))
    sums = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status_code") == 200).alias("ok"),
        *[pct_ceil("__fine", p / 100).alias(f"p{p}_ms") for p in (50, 95, 99)], F.sum("latency_ms").alias("__total"),
    )
    return sums.select(
        *by, "n", "ok", "p50_ms", "p95_ms", "p99_ms",
        F.round(F.coalesce(F.try_divide((F.col("n") - F.col("ok")).cast("double"), F.col("n")), F.lit(0.0)), 6).alias("error_rate"),
        F.round(F.try_divide(F.col("n"), F.col("__total") / 1000.0), 6).alias("serial_rps"),
        F.coalesce(F.col("p95_ms") > 2 * F.col("p50_ms"), F.lit(False)).alias("degraded"),
    )


def error_histogram(results: DataFrame, *by: str) -> DataFrame:
    return results.where("status_code <> 200").groupBy(*by, "status_code").agg(F.count(F.lit(1)).alias("n"))


def cost_snapshots(priced: DataFrame, anchor: str) -> DataFrame:
    """The row that an append-only cost series gets for a day: totals rounded to six places."""
    m = spend_metrics(priced)
    return m.select(F.lit(anchor).alias("taken_at"), "calls", "spend", "no_cache", "savings", "hit_rate")


def stress_verdict(summary: DataFrame, max_error_rate: float = 0.0, allow_degraded: bool = True) -> DataFrame:
    ok = (F.col("n") > 0) & (F.col("error_rate") <= max_error_rate)
    return summary.withColumn("passed", ok if allow_degraded else ok & ~F.col("degraded"))


def concurrency_verdict(summary: DataFrame, all_ok: bool = True) -> DataFrame:
    return summary.withColumn("passed", (F.col("n") > 0) & ((F.col("ok") == F.col("n")) if all_ok else (F.col("ok") >= 1)))


def selected_ranks(rows: DataFrame, value: str, ranks: dict[str, Callable[[Column], Column]], *by: str) -> DataFrame:
    """A row for each group (one for all rows where ``by`` is empty): ``by``, ``n`` values that aren't null, and for each name in
    ``ranks`` the value whose rank (from 1, by value) that function of ``n`` says; null where there is none.

    For groups of any size: values are counted before they are shuffled, lie in ranges of (group, value), and a range's total says
    whether a rank lies in it. Only ranges that hold an asked rank are put in order, so no task holds more than one range.
    Rows with a null in ``by`` are a group of their own; NaN is the greatest value.
    """
    groups = rows.groupBy(*by).agg(F.count(value).alias("n"))
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(counts.repartitionByRange(parts, *by, "__value").withColumn("__part", F.spark_partition_id()), "ranges")
    # A row for each range and group in it: ranges of a group follow one another, so there are no more than ranges and groups.
    totals = ranged.groupBy(*by, "__part").agg(F.sum("__n").alias("__sum"))
    before = Window.partitionBy(*by).orderBy("__part")
    based = totals.withColumn("__base", F.sum("__sum").over(before) - F.col("__sum"))

    def same(left: DataFrame, right: DataFrame, *more: str) -> Column:
        return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in (*by, *more)], F.lit(True))

    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("long").alias("rank")) for name, rank in ranks.items()]))
    wanted = groups.where("n > 0").withColumn("__asked", asked).select(*by, F.col("__asked.name").alias("__name"), F.col("__asked.rank").alias("__rank"))
    inside = (wanted["__rank"] > based["__base"]) & (wanted["__rank"] <= based["__base"] + based["__sum"])
    held = based.join(wanted, same(based, wanted) & inside).select(*[based[c] for c in by], "__part", "__name", (F.col("__rank") - F.col("__base")).alias("__rank"))
    held = stage(held.groupBy(*by, "__part").agg(F.collect_list(F.struct("__name", "__rank")).alias("__asked")), "ranks")
    in_range = ranged.join(held, same(ranged, held, "__part")).select(*[ranged[c] for c in by], ranged["__part"], "__value", "__n", "__asked")
    upto = F.sum("__n").over(Window.partitionBy(*by, "__part").orderBy("__value"))
    hits = F.filter("__asked", lambda a: (a["__rank"] <= F.col("__upto")) & (a["__rank"] > F.col("__upto") - F.col("__n")))
    found = in_range.withColumn("__upto", upto).select(*by, "__value", F.explode(hits).alias("__hit"))
    values = found.groupBy(*by).agg(*[F.max(F.when(F.col("__hit.__name") == name, F.col("__value"))).alias(name) for name in ranks])
    return groups.join(values, same(groups, values), "left").select(*[groups[c] for c in by], "n", *ranks)


def large_percentiles(rows: DataFrame, value: str, percents: tuple[int, ...] = (50, 90, 95), *by: str, floor: bool = False) -> DataFrame:
    """As :func:`pct_ceil` (or :func:`pct_floor`) in columns p50, p90 .., for groups whose distinct values don't fit into a task."""

    def rank(percent: int) -> Callable[[Column], Column]:
        share = F.lit(percent / 100)
        return lambda n: F.least(n, F.floor(n * share) + 1) if floor else F.greatest(F.lit(1), F.ceil(n * share))

    return selected_ranks(rows, value, {f"p{p}": rank(p) for p in percents}, *by)
