"""Connected components of an edge table: contraction within tasks, then alternating large-star and small-star steps.

Every task first replaces its edges by a star for each of the components that they make on their own. A step hangs the
neighbours of a node on the smallest of them, by an aggregate with map-side combining and a join in which nodes with very many
neighbours are broadcast, so that such a node is no task of its own. Steps are written to the shared folder; the rounds grow
with the logarithm of the longest path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import drop_staged, stage


#: Edges that a task contracts at once, at most.
TOGETHER = 1_000_000
#: Keys with more rows than this, and with more than one in HEAVY_KEYS rows, count as heavy: HEAVY_KEYS at most.
LIGHT, HEAVY_KEYS = 512, 50_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, for each the smallest node of its component) of some edges."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[one], root[other]), np.maximum(root[one], root[other])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a > b, with the same components: of every task's edges, each node with the smallest it reaches by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            nodes, least = roots(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
            hung = nodes != least
            return pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(least[hung])], names=["a", "b"])

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size >= TOGETHER:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return edges.mapInArrow(run, "a long, b long")


def join_minima(rows: DataFrame, values: DataFrame, key: str, value: str, count: str, total: int) -> DataFrame:
    """``rows`` with the ``value`` that ``values`` (unique in ``key``) has for their key; ``count`` is the key's number of rows,
    ``total`` no more than the sum of these.

    Heavy keys' values are broadcast, HEAVY_KEYS rows at most, so that no task has all rows of such a key; others are joined
    by the key. Every key of ``rows`` is in ``values``.
    """
    heavy = F.col(count) > max(LIGHT, total // HEAVY_KEYS)
    of_heavy = values.where(heavy).select(key, F.col(value).alias("__heavy"))
    marked = rows.join(F.broadcast(of_heavy), key, "left")
    light = marked.where("__heavy IS NULL").drop("__heavy").join(values.where(~heavy).select(key, value), key)
    return marked.where("__heavy IS NOT NULL").withColumnRenamed("__heavy", value).unionByName(light)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("n"))
    return join_minima(both.where("b > a"), least, "a", "m", "n", total).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    hung = join_minima(down, least, "a", "m", "n", total).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    """(edges, a sum of their hashes)."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): every node that an edge (a, b) touches, with the smallest node it reaches.

    Edges have no direction; repeated edges and loops do no harm, null ends are left out. No edges, no rows.
    """
    known = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stage(_contracted(known.distinct()), "edges")
    mark = _state(now)
    while mark[0]:
        hung = stage(_large_star(now, mark[0]), "edges")
        after = stage(_contracted(_small_star(hung, mark[0] // 2).distinct()), "edges")
        drop_staged(now, hung)
        now, before = after, mark
        mark = _state(now)
        if mark == before:
            break
    tops = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops)
