import numpy as np
import pytest

from tidemark.llm import additive_search as ads

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def exact(vectors, every, k):
    out = {}
    for q, v in vectors:
        if q % every == 0:
            found = sorted((float(ads.distances(np.array(v, float), np.array(w, float))), i) for i, w in vectors if i != q)[:k]
            out[q] = [(i, d) for d, i in found]
    return out


def test_encoding_improves_with_books_and_norms_are_of_the_sums():
    data = np.random.default_rng(0).normal(size=(600, 16))
    books = ads.learn_codebooks(data, books=6, words=32)
    errors = []
    for m in (1, 3, 6):
        codes, norms = ads.encode(data, books[:m])
        sums = sum(books[j][codes[:, j]] for j in range(m))
        assert np.allclose((sums * sums).sum(1), norms, rtol=1e-4)
        errors.append(((data - sums) ** 2).mean())
        scores = ads.lookup_scores(data[:5], books[:m], codes, norms) + (data[:5] ** 2).sum(1)[:, None]
        assert np.allclose(scores, ((data[:5, None] - sums[None]) ** 2).sum(2), atol=1e-3)
    assert errors[0] > errors[1] > errors[2]
    greedy, beam = (((data - sum(books[j][c[:, j]] for j in range(6))) ** 2).sum() for c, _ in (ads.encode(data, books, 1), ads.encode(data, books, 4)))
    assert beam < greedy


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=24).astype(np.float32).tolist(), 0, "", "") for i in range(3000)]
    got = ads.nearest(spark.createDataFrame(data, SCHEMA).repartition(3), every=100, k=10).collect()
    want = exact([(r[0], r[1]) for r in data], 100, 10)
    hits = 0
    for q, best in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        by = dict(data[r.vec_id][:2] for r in mine)
        assert all(r.score == float(ads.distances(np.array(data[q][1], float), np.array(by[r.vec_id], float))) for r in mine)
        hits += len({i for i, _ in best} & {r.vec_id for r in mine})
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_recall_and_equal_results_however_the_rows_are_dealt(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(50_000, 16)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist(), 0, "", "") for i, v in enumerate(data)], SCHEMA).cache()
    queries = np.arange(0, len(data), 1000)
    want = {}
    for q in queries.tolist():
        away = ((data.astype(float) - data[q].astype(float)) ** 2).sum(1)
        away[q] = np.inf
        want[q] = set(np.argsort(away, kind="stable")[:10].tolist())
    found = []
    for parts in (1, 8, 211):
        got = ads.nearest(rows.repartition(parts), every=1000, k=10).collect()
        found.append(sorted(map(tuple, got)))
        assert sum(r.vec_id in want[r.query_id] for r in got) >= 0.9 * 10 * len(queries)
    assert found[0] == found[1] == found[2]
    rows.unpersist()


@pytest.mark.parametrize("rows", ["wide", "scales", "far away"])
def test_recall_on_rows_that_codes_tell_apart_badly(spark, rows):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(4_000, 128 if rows == "wide" else 32))
    data = {"wide": data, "scales": data * 10 ** rng.uniform(-3, 3, (4_000, 1)), "far away": data + 1e4}[rows].astype(np.float32)
    got = ads.nearest(spark.createDataFrame([(i, v.tolist(), 0, "", "") for i, v in enumerate(data)], SCHEMA).repartition(3), every=100, k=10).collect()
    hits = 0
    for q in range(0, 4_000, 100):
        away = ads.distances(data.astype(float), data[q].astype(float))
        away[q] = np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(away, kind="stable")[:10].tolist()))
    assert hits >= 0.9 * 400


def test_merged_shortlists_are_those_of_all_rows_at_once():
    rng = np.random.default_rng(9)
    query, row, near = rng.integers(0, 5, 4000), rng.integers(0, 300, 4000), rng.integers(0, 40, 4000).astype(np.float32)
    want = []
    for q in range(5):
        least = {}
        for r, s in zip(row[query == q].tolist(), near[query == q].tolist()):
            least[r] = min(s, least.get(r, s))
        want += [(q, r, s) for s, r in sorted((s, r) for r, s in least.items())[:17]]
    held = None
    for at in range(0, 4000, 333):
        held = ads.best_of(held, (query[at : at + 333], row[at : at + 333], near[at : at + 333]), 17)
    assert list(zip(*(c.tolist() for c in held))) == want
    none = ads.best_of(None, (query[:0], row[:0], near[:0]), 17)
    assert [len(c) for c in none] == [0, 0, 0] and list(zip(*(c.tolist() for c in ads.best_of(none, held, 17)))) == want


def test_waves_of_blocks_give_the_same_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, rng.normal(size=8).tolist(), 0, "", "") for i in range(900)], SCHEMA)
    want = sorted(map(tuple, ads.nearest(rows, every=30, k=5).collect()))
    monkeypatch.setattr(ads, "HELD", 128 * 8)
    monkeypatch.setattr(ads, "QUERY_BLOCK", 4)
    monkeypatch.setattr(ads, "SLAB", 100)
    assert sorted(map(tuple, ads.nearest(rows, every=30, k=5).collect())) == want and len(want) == 150


def test_ties_go_to_smaller_ids_among_many_copies(spark):
    same, rng = [1.0, 2.0, 3.0], np.random.default_rng(2)
    rows = [(i, same, 0, "", "") for i in range(500)] + [(i, rng.normal(size=3).tolist(), 0, "", "") for i in range(500, 700)]
    got = ads.nearest(spark.createDataFrame(rows, SCHEMA).repartition(4), every=100, k=10)
    assert [r.vec_id for r in got.where("query_id = 300").orderBy("rank").collect()] == list(range(10))
    assert [r.vec_id for r in got.where("query_id = 0").orderBy("rank").collect()] == list(range(1, 11))


@pytest.mark.parametrize("block", [2048, 2])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(ads, "QUERY_BLOCK", block)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (200, [1.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (300, [inf, 1.0]),
            (4, [None, 1.0]), (5, [1.0]), (6, []), (None, [1.0, 1.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (100, [0.0, 1.0])]
    got = ads.nearest(spark.createDataFrame([(*r, 0, "", "") for r in rows], SCHEMA), every=100, k=10).collect()
    fine = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (200, [1.0, 1.0]), (7, [2.0, 0.0])]
    want = {(q, n + 1, i, d) for q, best in exact(fine, 100, 10).items() for n, (i, d) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_empty(spark):
    assert ads.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_what_leaves_tasks_is_in_proportion_to_what_is_asked_for(spark, monkeypatch):
    rng, real, counts = np.random.default_rng(6), ads.stage, []

    def counted(df, name):
        got = real(df, name)
        if {"query_id", "vec_id"} <= set(got.columns):
            counts.append(got.count())
        return got

    monkeypatch.setattr(ads, "stage", counted)
    rows = spark.createDataFrame([(i, rng.normal(size=8).tolist(), 0, "", "") for i in range(3000)], SCHEMA)
    assert ads.nearest(rows, every=100, k=5).count() == 150
    assert counts and max(counts) <= 30 * 5 * int(spark.conf.get("spark.sql.shuffle.partitions"))
