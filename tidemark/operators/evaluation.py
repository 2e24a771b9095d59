"""Retrieval quality: first-hit ranks, recall at k, reciprocal rank, coverage, refusal, and the regression gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KS = (1, 3, 5, 8, 10)
BASELINE, MARGIN, GATE_K = 0.933, 0.033, 8

QUESTION_SCHEMA = (
    "id STRING, question STRING, expect_paths ARRAY<STRING>, expect_symbols ARRAY<STRING>, expect_kinds ARRAY<STRING>, "
    "source STRING, should_refuse BOOLEAN, expect_targets INT"
)


def load_questions(lines: DataFrame, column: str = "value") -> DataFrame:
    """Questions from JSON lines; blanks and lines that begin with # are left out, missing keys get defaults.

    A line that is no JSON object raises when it is read.
    """
    line = F.trim(F.col(column))
    rows = lines.where((line != "") & ~line.startswith("#"))
    checked = F.when(F.try_parse_json(line).isNull() | ~line.startswith("{"), F.raise_error(F.concat(F.lit("not a question: "), line))).otherwise(line)
    q = rows.select(F.from_json(checked, QUESTION_SCHEMA).alias("q")).select("q.*")
    none = F.array().cast("array<string>")
    return q.select(
        "id", F.coalesce("question", F.lit("")).alias("question"),
        *[F.coalesce(c, none).alias(c) for c in ("expect_paths", "expect_symbols", "expect_kinds")],
        F.coalesce("source", F.lit("curated")).alias("source"), F.coalesce("should_refuse", F.lit(False)).alias("should_refuse"),
        F.coalesce(F.nullif("expect_targets", F.lit(0)), F.size(F.coalesce("expect_paths", none))).alias("targets"),
    )


def matches(path: Column, symbol: Column, kind: Column, paths: Column, symbols: Column, kinds: Column) -> Column:
    """A path that is expected, and a symbol and a kind that are, where any are asked for. A null symbol never is."""
    return (
        F.array_contains(paths, path)
        & ((F.size(symbols) == 0) | F.coalesce(F.array_contains(symbols, F.coalesce(symbol, F.lit(""))), F.lit(False)))
        & ((F.size(kinds) == 0) | F.array_contains(kinds, kind))
    )


def kind_group(kinds: Column) -> Column:
    distinct = F.array_distinct(kinds)
    return F.when(F.size(distinct) == 1, F.try_element_at(distinct, F.lit(1))).otherwise("mixed")


def per_question(questions: DataFrame, hits: DataFrame, k_max: int = max(KS)) -> DataFrame:
    """id, source, kind_group, negative, refused, rank (of the first match), targets, covered (paths within ``k_max``).

    ``hits`` (id, pos, path, symbol, kind) are joined by question; one aggregate a question.
    """
    paths = [F.col(c) for c in ("path", "symbol", "kind", "expect_paths", "expect_symbols", "expect_kinds")]
    found = hits.join(questions.select("id", "expect_paths", "expect_symbols", "expect_kinds"), "id").withColumn("hit", matches(*paths))
    sums = found.groupBy("id").agg(
        F.min(F.when(F.col("hit"), F.col("pos"))).alias("rank"),
        F.count_distinct(F.when(F.col("hit") & (F.col("pos") <= k_max), F.col("path"))).alias("covered"),
        F.count(F.lit(1)).alias("n"),
    )
    return questions.join(sums, "id", "left").select(
        "id", "source", kind_group(F.col("expect_kinds")).alias("kind_group"), F.col("should_refuse").alias("negative"),
        F.coalesce(F.col("n") == 0, F.lit(True)).alias("refused"), "rank", F.greatest(F.lit(1), "targets").alias("targets"),
        F.coalesce("covered", F.lit(0)).alias("covered"),
    )


def recall_at(k: int) -> Column:
    hit = F.coalesce(F.col("rank") <= k, F.lit(False))
    return F.when(F.col("negative"), F.col("refused")).otherwise(hit).cast("double")


def quality_columns(ks=KS) -> list[Column]:
    positive = ~F.col("negative")
    covered = F.least(F.lit(1.0), F.col("covered") / F.col("targets"))
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.round(F.avg(recall_at(k)), 4).alias(f"recall_{k}") for k in ks],
        F.round(F.coalesce(F.avg(F.when(positive, F.coalesce(1.0 / F.col("rank"), F.lit(0.0)))), F.lit(0.0)), 4).alias("mrr"),
        F.round(F.avg(F.when(positive, covered)), 4).alias("coverage"),
        F.round(F.avg(F.when(F.col("negative"), F.col("refused").cast("double"))), 4).alias("refusal"),
        F.round(F.avg(F.when(positive, recall_at(GATE_K))), 4).alias("positive_recall"),
    ]


def quality(per: DataFrame, ks=KS) -> DataFrame:
    """Quality overall, by kind group and by source, in one pass of grouping sets: columns dimension and value."""
    kind, source = F.col("kind_group"), F.col("source")
    sets = per.groupingSets([[], [kind], [source]], kind, source)
    rows = sets.agg(F.grouping("kind_group").alias("__k"), F.grouping("source").alias("__s"), *quality_columns(ks))
    dimension = F.when(F.col("__k") == 0, "kind").when(F.col("__s") == 0, "source").otherwise("overall")
    value = F.when(F.col("__k") == 0, F.col("kind_group")).when(F.col("__s") == 0, F.col("source")).otherwise("")
    return rows.select(dimension.alias("dimension"), value.alias("value"), *[c for c in rows.columns if not c.startswith("__") and c not in ("kind_group", "source")])


def misses(per: DataFrame) -> DataFrame:
    return per.where((F.col("negative") & ~F.col("refused")) | (~F.col("negative") & F.col("rank").isNull())).select("id", "negative")


def gate_threshold(baseline: float = BASELINE, margin: float = MARGIN) -> float:
    return round(baseline - margin, 4)


def check_gate(overall: DataFrame, k: int = GATE_K, threshold: float | None = None) -> DataFrame:
    """metric, threshold, passed: at the threshold passes, a missing metric doesn't."""
    limit = gate_threshold() if threshold is None else threshold
    metric = F.col(f"recall_{k}")
    return overall.select(metric.alias("metric"), F.lit(limit).alias("threshold"), F.coalesce(metric >= limit, F.lit(False)).alias("passed"))
