import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n, "a", "b", "c") for i, v, n in rows], SCHEMA)


def by_hand(rows, every=100):
    """Every anchor against every row, in Python's integers."""
    ready = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v])
        ready[i] = min(row, ready.get(i, row))
    out = set()
    for a, (label, x) in ready.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, n == label) for i, (n, y) in ready.items() if i != a)
        for sp, p, _ in [s for s in scored if s[2]][:5]:
            near = [(s, i) for s, i, same in scored if not same and 80 * -sp <= 100 * -s <= 100 * -sp]
            out |= {(a, p, rank + 1, i, -sp, -s) for rank, (s, i) in enumerate(near[:5])}
    return out


def mined(spark, rows):
    return [tuple(r) for r in hn.mine_embeddings(frame(spark, rows)).collect()]


def clustered(n, dims, seed, labels):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    rows = [(i, (centers[rng.integers(6)] + 0.05 * rng.normal(size=dims)).astype(np.float32).tolist(), int(rng.integers(labels))) for i in range(n)]
    return rows


def test_ties_nulls_repeated_rows_and_odd_components(spark):
    rows = clustered(700, 5, 1, 3)
    rows[:100] = [(i, [1.0, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(100)]  # one vector, many ties
    rows += [(None, [1.0] * 5, 1), (800, None, 1), (900, [1.0] * 5, None), (1000, [1.0, None, 0.0, 0.0, 0.0], 1), (1100, [math.nan] * 5, 1),
             (1200, [math.inf] * 5, 1), (200, rows[200][1], rows[200][2]), (300, [9.0] * 5, 0), (1300, [0.0] * 5, 2), (1400, [-5.0] * 5, 2)]
    found = mined(spark, rows)
    assert len(found) == len(set(found)) and set(found) == by_hand(rows) and found


def test_many_slabs_and_blocks_with_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(hn, "SLAB", 150)
    monkeypatch.setattr(hn, "BLOCK", 5)
    rows = [(i, v, 3 if i % 3 else n) for i, v, n in clustered(2_000, 8, 2, 5)]
    assert set(mined(spark, rows)) == by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2), (8, [0.9], 2)], [(0, [], 1), (1, None, 2)]])
def test_small_tables(spark, rows):
    assert set(mined(spark, rows)) == by_hand([r for r in rows if r[1]])


def test_vectors_too_large_or_of_another_length_take_no_part(spark):
    rows = clustered(150, 4, 3, 2)
    assert set(mined(spark, [*rows, (1000, [1e30] * 4, 0), (1100, [1.0] * 3, 1)])) == by_hand(rows)


def test_intervals_hold_every_product_and_whole_groups_are_pruned():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(-40, 40, (900, 6)) + c for c in (0, 900, -900)])
    a, c = hn.build_tree(np.arange(300), np.zeros(300, np.int64), x[::9]), hn.build_tree(np.arange(len(x)), np.ones(len(x), np.int64), x)
    for level in range(min(len(a.cuts), len(c.cuts))):
        for i in range(2**level):
            for j in range(2**level):
                low, high = hn.node_intervals(a, c, np.array([[2**level - 1 + i], [2**level - 1 + j]]))
                products = a.x[a.cuts[level][i] : a.cuts[level][i + 1]] @ c.x[c.cuts[level][j] : c.cuts[level][j + 1]].T
                assert low[0] <= products.min() and products.max() <= high[0]
    windows = [{"anchor_id": int(i), "key": 0, "floor": 4_000_000, "ceiling": hn.LIMIT} for i in a.ids]
    pairs, _ = hn.Search(a, windows, 5, same=False).leaf_pairs(c)
    assert 0 < pairs.shape[1] < (len(a.cuts[-1]) - 1) * (len(c.cuts[-1]) - 1) / 2


def test_trees_are_stored_whole():
    rng = np.random.default_rng(6)
    for scale in (100, 100_000, 1 << 40):
        tree = hn.build_tree(np.arange(500), rng.integers(0, 3, 500), rng.integers(-scale, scale, (500, 3)))
        row = hn.packed(7, tree)
        for one, two in zip(tree, hn.unpacked(*(row[c] for c in hn.TREE_FIELDS)), strict=True):
            assert all(np.array_equal(p, q) for p, q in zip(one, two, strict=True))


def test_sql_says_the_same(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    found = hn.mine_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).select(*map(F.col, columns)).collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({hn.exact_sql()})").fetchall())
