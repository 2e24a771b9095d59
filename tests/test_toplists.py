"""Lists made inside tasks, against the column expressions over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import search, toplists
from tidemark.sources import postings


def test_values_round_as_columns_do(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.uniform(-2, 60, 3_000), (rng.integers(0, 3_000_000, 3_000) + 0.5) / 1e6, [0.0, 2.0, 1e-7, 5e-7, 1.0000005]])
    got = spark.createDataFrame([(float(v),) for v in values], "v double").select(F.round("v", 6).alias("r")).collect()
    assert [round(r.r * 1e6) for r in got] == toplists.rounded(values).tolist()
    assert toplists.rounded(np.array([np.nan, np.inf])).tolist()[0] == toplists.LAST


@pytest.mark.parametrize("kind", ["long", "string"])
def test_dense_lists_are_those_of_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(toplists, "ROWS", 16)
    monkeypatch.setattr(toplists, "QUERIES", 5)
    monkeypatch.setattr(toplists, "HELD", 40)
    rng, nan, inf = np.random.default_rng(2), float("nan"), float("inf")
    x = rng.normal(size=(200, 6)).round(1)
    x[50:120] = x[3]
    odd = [None, [], [0.0] * 6, [nan] * 6, [inf] + [1.0] * 5, [None] + [1.0] * 5, [1.0, 2.0], [1e-160] * 6, [1e160] * 6]
    rows = spark.createDataFrame(list(enumerate([*x.tolist(), *odd])), "id long, embedding array<double>").withColumn("id", F.col("id").cast(kind))
    queries = rows.where("cast(id AS long) % 10 = 3 OR cast(id AS long) >= 200").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    pairs = rows.crossJoin(queries).withColumn("dist", F.round(search.cosine_distance(F.col("embedding"), F.col("qvec")), 6)).where("dist IS NOT NULL")
    want = sorted(map(str, search.top(pairs, 4, F.col("dist")).select("qid", "id", "rank", "dist").collect()))
    found = search.dense_lists(rows, queries, 4)
    assert sorted(map(str, found.collect())) == want and len(want) > 80
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_equal_sets_of_terms_are_scored_once(spark):
    rows = spark.createDataFrame([(i, " ".join(["a"] * (i % 5) + ["b"] * (i % 3) + ["c"])) for i in range(60)], "id long, content string")
    queries = spark.createDataFrame([(q, ["a", "b"] if q % 2 else ["b", "a", "b"]) for q in range(1_500)], "qid long, terms array<string>")
    assert toplists.term_sets(queries).select("terms").distinct().count() == 1
    found = search.lexical_lists(rows, queries, 5)
    assert found.count() == 7_500 and found.select("id", "rank", "bm25").distinct().count() == 5


def test_texts_that_lie_in_one_partition_are_cut_by_all_tasks(spark, monkeypatch, tmp_path):
    seen, real, staged = [], toplists.count_terms, postings.stage
    chunks = spark.createDataFrame([(i, f"a{i % 7} b{i % 11} c") for i in range(600)], "id long, content string").coalesce(1)
    queries = spark.createDataFrame([(i, [f"a{i % 7}", "c"]) for i in range(20)], "qid long, terms array<string>")

    def watched(rows):
        seen.append(rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
        return rows

    monkeypatch.setattr(toplists, "count_terms", lambda rows, terms: real(watched(rows), terms))
    monkeypatch.setattr(postings, "stage", lambda df, name: staged(watched(df) if name == "terms" else df, name))
    want = sorted(map(str, search.lexical_lists(chunks, queries, 5).select("qid", "id", "rank", "bm25").collect()))
    postings.write_segment(chunks, f"{tmp_path}/index")
    got = postings.Postings(spark, [f"{tmp_path}/index"]).topk(queries, 5)
    assert sorted(map(str, got.select("qid", "id", "rank", "bm25").collect())) == want and len(want) == 100
    assert len(seen) == 2 and all(len(parts) == toplists.tasks(spark) and max(p["count"] for p in parts) <= 600 / len(parts) + 1 for parts in seen)


def test_asked_terms_are_cut_once(spark, monkeypatch):
    """A filter on terms that are still to be cut is pushed down, and cuts them once for each of its conditions."""
    plans, staged = [], toplists.stage
    monkeypatch.setattr(toplists, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or staged(df, name))
    chunks = spark.createDataFrame([(i, "A b C" if i % 2 else "b C") for i in range(40)], "id long, content string")
    queries = chunks.where("id % 10 = 0").join(spark.range(40), "id").select(F.col("id").alias("qid"), F.split(F.upper("content"), " ").alias("terms"))
    assert search.lexical_lists(chunks.select("id", F.upper("content").alias("content")), queries, 3).count() == 0
    assert search.lexical_lists(chunks, queries.withColumn("terms", F.transform("terms", F.lower)), 3).count() == 12
    assert all(plan.count("split(upper(content") <= 1 for plan in plans) and sum("split(upper(content" in plan for plan in plans) == 2


def test_dense_lists_are_bounded_before_tasks_make_them(spark, monkeypatch):
    """A task passes on its share of a list, not a list of its own."""
    seen, real = [], toplists.reduce
    monkeypatch.setattr(toplists, "reduce", lambda join, parts: seen.append(real(join, parts)) or seen[-1])
    x = np.random.default_rng(5).normal(size=(3_000, 8))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id long, embedding array<double>")
    queries = rows.where("id % 100 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    found = search.dense_lists(rows, queries, 20)
    assert found.count() == 600 and seen[0].count() <= 1.5 * 600
    few = search.dense_lists(rows.where("id < 15"), queries, 20)  # fewer rows than a list: no bound
    assert few.count() == 30 * 15


def test_bounds_hold_for_rounded_ties(spark):
    """Rows beyond the nth by less than a unit tie with it: the smaller ids belong to the list, wherever they lie."""
    rows = spark.createDataFrame([(i, [1.0, 1e-5 * ((i * 7) % 300)]) for i in range(300)], "id long, embedding array<double>")
    queries = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1e-3])], "qid long, qvec array<double>")
    pairs = rows.crossJoin(queries).withColumn("dist", F.round(search.cosine_distance(F.col("embedding"), F.col("qvec")), 6))
    want = sorted(map(str, search.top(pairs, 10, F.col("dist")).select("qid", "id", "rank", "dist").collect()))
    assert sorted(map(str, search.dense_lists(rows, queries, 10).collect())) == want
