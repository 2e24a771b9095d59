"""Hard negatives by dual-tree search.

Candidates and anchors are both arranged as trees. Above, rows are ordered by label and by the cell of a split tree that is
learnt from a bounded sample, and cut into slabs (candidates) and blocks (anchors) of bounded size: the nodes that Spark
joins. Below, each slab and block carries a binary tree of balls, down to leaves of :data:`LEAF` rows. The inner products of
two nodes lie within ``c1.c2 +- (|c1| r2 + r1 |c2| + r1 r2)``, so a pair of nodes is dropped, with all its anchors, where that
interval misses every score they still look for, or where the labels can't match. What is left at the leaves is scored
exactly in integers.

What an anchor looks for is a table of windows: the ``k`` highest scores between a floor and a ceiling. Positives have one
window an anchor; each positive then makes a window for its negatives. Floors rise as better rows are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..staging import stage

#: Vectors that the upper split tree is learnt from, at most (those first by a hash of their ids), and its depth.
TRAINING, DEPTH = 8_000, 6
#: Rows of a slab, anchors of a block and rows of a leaf, at most.
SLAB, BLOCK, LEAF = 2_048, 512, 64
#: Slabs of each block that are searched first, so that the others meet raised floors.
FIRST = 2
#: Scores stay within +-2**62: vectors with a larger squared norm take no part.
LIMIT = 1 << 62
#: Relative slack that covers the rounding of the intervals.
SLACK = 1e-9

TREE = "node long, n int, label_lo long, label_hi long, center array<double>, radius double, ids binary, labels binary, vectors binary, centers binary, radii binary"
TREE_FIELDS = ("ids", "labels", "vectors", "centers", "radii")


def integer_vectors(vectors: DataFrame, label: Column, scale: int = 256) -> tuple[DataFrame, int]:
    """(vec_id, label, x) rows that take part, x as floor(scale * component), and their dimensions.

    A row with a null id, label or vector, with a null or non-finite component, with no components, with another length than
    the most frequent one (the smaller of equals), or whose squared norm passes LIMIT takes no part. Of rows of one id, the
    one with the smallest label, then vector, counts.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select("vec_id", label.cast("long").alias("label"), "embedding")
    kept = kept.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(F.coalesce(fine, F.lit(False)))
    kept = kept.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("x"))
    norm = F.aggregate("x", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    kept = kept.where(norm < float(LIMIT))
    sizes = kept.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = sizes[0].n if sizes else 0
    one = kept.where(F.size("x") == dims).groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"))
    return one.select("vec_id", "row.label", "row.x"), dims


def direction(x: np.ndarray) -> np.ndarray:
    """Between the row farthest from the mean and the row farthest from that one."""
    first = x[np.argmax(((x - x.mean(0)) ** 2).sum(1))]
    return first - x[np.argmax(((x - first) ** 2).sum(1))]


def learn_splits(sample: np.ndarray, depth: int = DEPTH) -> list[tuple[np.ndarray, float]]:
    """(direction, median) of each node of the upper tree, in heap order."""
    splits, groups = [], [sample]
    for _ in range(depth):
        halves = []
        for x in groups:
            along = direction(x) if len(x) else np.zeros(sample.shape[1])
            cut = float(np.median(x @ along)) if len(x) else 0.0
            splits.append((along, cut))
            halves += [x[x @ along <= cut], x[x @ along > cut]]
        groups = halves
    return splits


def cells(x: np.ndarray, splits: list[tuple[np.ndarray, float]]) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    for _ in range((len(splits) + 1).bit_length() - 1):
        side = np.zeros(len(x), np.int64)
        for node in np.unique(at):
            along, cut = splits[node]
            rows = at == node
            side[rows] = x[rows] @ along > cut
        at = 2 * at + 1 + side
    return at - len(splits)


class Tree(NamedTuple):
    """Rows in tree order. ``cuts[l]`` bounds the nodes of level l; ``centers`` and ``radii`` run over all levels, root first."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    centers: np.ndarray
    radii: np.ndarray
    cuts: list[np.ndarray]


def tree_cuts(n: int) -> list[np.ndarray]:
    """Row bounds of the nodes of each level: halves of halves, until none is larger than LEAF."""
    levels = max(0, (max(n, 1) - 1) // LEAF).bit_length()
    return [(n * np.arange(2**level + 1)) >> level for level in range(levels + 1)]


def build_tree(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> Tree:
    order, cuts, wide = np.arange(len(ids)), tree_cuts(len(ids)), x.astype(np.float64)
    for level in cuts[:-1]:
        for start, end in zip(level[:-1], level[1:], strict=True):
            rows = order[start:end]
            order[start:end] = rows[np.argsort(wide[rows] @ direction(wide[rows]), kind="stable")]
    for start, end in zip(cuts[-1][:-1], cuts[-1][1:], strict=True):
        rows = order[start:end]
        order[start:end] = rows[np.argsort(ids[rows], kind="stable")]
    wide, centers, radii = wide[order], [], []
    for level in cuts:
        sizes = np.diff(level)
        center = np.add.reduceat(wide, level[:-1], axis=0) / sizes[:, None]
        away = ((wide - np.repeat(center, sizes, axis=0)) ** 2).sum(1)
        centers.append(center)
        radii.append(np.sqrt(np.maximum.reduceat(away, level[:-1])))
    return Tree(ids[order], labels[order], x[order], np.concatenate(centers), np.concatenate(radii), cuts)


def packed(node: int, tree: Tree) -> dict:
    x = tree.x
    for narrow in (np.int16, np.int32):
        if x.size and np.abs(x).max() <= np.iinfo(narrow).max:
            x = x.astype(narrow)
            break
    return {
        "node": node, "n": len(tree.ids), "label_lo": int(tree.labels.min()), "label_hi": int(tree.labels.max()),
        "center": tree.centers[0].tolist(), "radius": float(tree.radii[0]), "ids": tree.ids.astype("<i8").tobytes(),
        "labels": tree.labels.astype("<i8").tobytes(), "vectors": x.tobytes(), "centers": tree.centers.astype("<f8").tobytes(),
        "radii": tree.radii.astype("<f8").tobytes(),
    }


def unpacked(ids: bytes, labels: bytes, vectors: bytes, centers: bytes, radii: bytes) -> Tree:
    n, nodes = len(ids) // 8, len(radii) // 8
    dims = len(centers) // 8 // nodes
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(vectors) // (n * dims)]
    x = np.frombuffer(vectors, kind).reshape(n, dims).astype(np.int64)
    return Tree(np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), x, np.frombuffer(centers, "<f8").reshape(nodes, dims),
                np.frombuffer(radii, "<f8"), tree_cuts(n))


def to_matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def build_trees(rows: DataFrame, dims: int, size: int, splits: list, name: str) -> DataFrame:
    """One row for each slab (or block) of ``size`` rows at most, in order of label, cell and id, staged.

    A slab ends early where label or cell change, once it has a quarter of its rows, so that it stays narrow.
    """
    wanted = StructType.fromDDL(TREE)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = cells(to_matrix(batch.column(2), dims).astype(np.float64), splits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=["vec_id", "label", "x", "cell"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema, base, made = to_arrow_schema(wanted), TaskContext.get().partitionId() << 33, 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        group = None
        for batch in batches:
            ids, labels, at = (batch.column(c).to_numpy() for c in (0, 1, 3))
            x = to_matrix(batch.column(2), dims)
            edges = np.flatnonzero((labels[1:] != labels[:-1]) | (at[1:] != at[:-1])) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)], strict=True):
                if group != (labels[start], at[start]) and sum(len(h[0]) for h in held) * 4 >= size:
                    yield pa.RecordBatch.from_pylist([packed(base + made, build_tree(*map(np.concatenate, zip(*held, strict=True))))], schema)
                    held, made = [], made + 1
                group = (labels[start], at[start])
                while start < end:
                    stop = min(end, start + size - sum(len(h[0]) for h in held))
                    held.append((ids[start:stop], labels[start:stop], x[start:stop]))
                    start = stop
                    if sum(len(h[0]) for h in held) == size:
                        yield pa.RecordBatch.from_pylist([packed(base + made, build_tree(*map(np.concatenate, zip(*held, strict=True))))], schema)
                        held, made = [], made + 1
        if held:
            yield pa.RecordBatch.from_pylist([packed(base + made, build_tree(*map(np.concatenate, zip(*held, strict=True))))], schema)

    placed = rows.mapInArrow(place, "vec_id long, label long, x array<bigint>, cell long")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, "label", "cell", "vec_id").sortWithinPartitions("label", "cell", "vec_id")
    return stage(ordered.mapInArrow(cut, TREE), name)


def node_intervals(a: Tree, c: Tree, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of pairs of nodes, given by their places in ``centers``."""
    one, two = a.centers[pairs[0]], c.centers[pairs[1]]
    middle = np.einsum("ij,ij->i", one, two)
    size_one, size_two = np.sqrt((one * one).sum(1)), np.sqrt((two * two).sum(1))
    r_one, r_two = a.radii[pairs[0]], c.radii[pairs[1]]
    spread = size_one * r_two + r_one * size_two + r_one * r_two + SLACK * (size_one + r_one) * (size_two + r_two) + SLACK
    return middle - spread, middle + spread


class Search:
    """The windows of one block of anchors, and the best rows found for them so far."""

    def __init__(self, anchors: Tree, windows: list[dict], k: int, same: bool):
        self.a, self.k, self.same = anchors, k, same
        at = {int(i): n for n, i in enumerate(anchors.ids)}
        windows = sorted(windows, key=lambda w: (at[w["anchor_id"]], w["key"]))
        self.keys = [(w["anchor_id"], w["key"]) for w in windows]
        self.row = np.array([at[w["anchor_id"]] for w in windows], np.int64)
        self.floor = np.array([w["floor"] for w in windows], np.int64)
        self.ceiling = np.array([w["ceiling"] for w in windows], np.int64)
        self.scores = np.full((len(windows), k), -LIMIT - 1, np.int64)
        self.ids = np.full((len(windows), k), np.iinfo(np.int64).max, np.int64)
        #: Windows of each anchor node, level by level.
        self.spans = [np.searchsorted(self.row, level) for level in anchors.cuts]

    def wanted(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest floor and highest ceiling of anchor nodes; nothing reaches a node without windows."""
        lows, highs = [], []
        for node in range(len(self.spans[level]) - 1):
            start, end = self.spans[level][node : node + 2]
            lows.append(self.floor[start:end].min() if end > start else LIMIT * 2 - 1)
            highs.append(self.ceiling[start:end].max() if end > start else -LIMIT * 2)
        return np.array(lows, np.float64)[nodes], np.array(highs, np.float64)[nodes]

    def leaf_pairs(self, c: Tree) -> tuple[np.ndarray, np.ndarray]:
        """(anchor leaf, candidate leaf) pairs that may hold wanted scores, and their upper bounds."""
        a, pairs, la, lc = self.a, np.zeros((2, 1), np.int64), 0, 0
        while True:
            low, high = node_intervals(a, c, pairs + np.array([[2**la - 1], [2**lc - 1]]))
            floor, ceiling = self.wanted(la, pairs[0])
            a_lo, a_hi = (f.reduceat(a.labels, a.cuts[la][:-1])[pairs[0]] for f in (np.minimum, np.maximum))
            c_lo, c_hi = (f.reduceat(c.labels, c.cuts[lc][:-1])[pairs[1]] for f in (np.minimum, np.maximum))
            fits = (a_lo <= c_hi) & (c_lo <= a_hi) if self.same else (a_lo != a_hi) | (c_lo != c_hi) | (a_lo != c_lo)
            keep = (high >= floor) & (low <= ceiling) & fits
            pairs, high = pairs[:, keep], high[keep]
            if la == len(a.cuts) - 1 and lc == len(c.cuts) - 1:
                return pairs, high
            if la < len(a.cuts) - 1:
                pairs, la = np.concatenate([pairs * [[2], [1]], pairs * [[2], [1]] + [[1], [0]]], axis=1), la + 1
            if lc < len(c.cuts) - 1:
                pairs, lc = np.concatenate([pairs * [[1], [2]], pairs * [[1], [2]] + [[0], [1]]], axis=1), lc + 1

    def visit(self, c: Tree) -> None:
        """Score what the trees leave, from the highest bounds down."""
        pairs, high = self.leaf_pairs(c)
        exact = np.sqrt((self.a.x.astype(np.float64) ** 2).sum(1).max() * (c.x.astype(np.float64) ** 2).sum(1).max()) < 2**52
        ax, cx = (t.x.astype(np.float64) if exact else t.x for t in (self.a, c))
        spans, own, other = self.spans[-1], self.a.cuts[-1], c.cuts[-1]
        for p in np.argsort(-high, kind="stable"):
            leaf, place = pairs[:, p]
            start, end = spans[leaf : leaf + 2]
            if high[p] < self.floor[start:end].min():
                continue
            rows, there = slice(own[leaf], own[leaf + 1]), slice(other[place], other[place + 1])
            products = (ax[rows] @ cx[there].T).astype(np.int64)[self.row[start:end] - own[leaf]]
            equal = self.a.labels[self.row[start:end], None] == c.labels[there]
            fine = (products >= self.floor[start:end, None]) & (products <= self.ceiling[start:end, None]) & (equal == self.same)
            fine &= self.a.ids[self.row[start:end], None] != c.ids[there]
            hit = np.flatnonzero(fine.any(1))
            if len(hit):
                self.merge(start + hit, np.where(fine[hit], products[hit], -LIMIT - 1), c.ids[there])

    def merge(self, windows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take the best of what was found into the windows' lists: higher scores, then smaller ids (``ids`` ascend)."""
        best = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        scores = np.concatenate([self.scores[windows], np.take_along_axis(scores, best, 1)], axis=1)
        ids = np.concatenate([self.ids[windows], ids[best]], axis=1)
        order = np.lexsort((ids, -scores), axis=1)[:, : self.k]
        self.scores[windows], self.ids[windows] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
        self.floor[windows] = np.maximum(self.floor[windows], self.scores[windows, -1])

    def found(self) -> pa.RecordBatch:
        w, k = np.nonzero(self.scores >= -LIMIT)
        keys = np.array(self.keys, np.int64).reshape(-1, 2)[w]
        columns = [keys[:, 0], keys[:, 1], self.ids[w, k], self.scores[w, k]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "key", "vec_id", "score"])


def node_pairs(blocks: DataFrame, slabs: DataFrame, same: bool) -> DataFrame:
    """(block, slab, low, high): pairs of nodes whose labels can match, with the interval of their inner products.

    A stated query set in blocks against all slabs; only the nodes' centres and radii take part.
    """
    near = lambda df, name: df.select(F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("label_lo", "label_hi", "center", "radius")))
    labels = (F.col("block_label_lo") <= F.col("slab_label_hi")) & (F.col("slab_label_lo") <= F.col("block_label_hi"))
    if not same:
        one = lambda name: F.col(f"{name}_label_lo") == F.col(f"{name}_label_hi")
        labels = ~(one("block") & one("slab") & (F.col("block_label_lo") == F.col("slab_label_lo")))
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda total, x: total + x * x))
    dot = F.aggregate(F.zip_with("block_center", "slab_center", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    one, two, r_one, r_two = size("block_center"), size("slab_center"), F.col("block_radius"), F.col("slab_radius")
    spread = one * r_two + r_one * two + r_one * r_two + F.lit(SLACK) * (one + r_one) * (two + r_two) + F.lit(SLACK)
    joined = near(blocks, "block").join(near(slabs, "slab"), labels)
    return joined.select("block", "slab", (dot - spread).alias("low"), (dot + spread).alias("high"))


def search(pairs: DataFrame, blocks: DataFrame, slabs: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_id, key, vec_id, score): the k best rows of each window that each task found over its pairs of nodes.

    ``pairs`` is (block, slab, high), ``windows`` (block, windows). The slabs of a block are dealt to several tasks, each of
    which goes from the highest bound down and keeps what it has found for the next slab.
    """
    spark = pairs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = max(1, parts // max(1, blocks.count()))
    lane = F.pmod(F.hash("slab"), F.lit(lanes)).alias("lane")
    anchors = blocks.select(F.col("node").alias("block"), *(F.col(c).alias(f"a_{c}") for c in TREE_FIELDS)).join(windows, "block")
    anchors = anchors.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    bodies = slabs.select(F.col("node").alias("slab"), *TREE_FIELDS)
    work = pairs.select("block", "slab", "high", lane).join(bodies, "slab").join(anchors, ["block", "lane"])
    work = work.repartition(parts, "block", "lane").sortWithinPartitions("block", "lane", F.desc("high"), "slab")
    columns = ["block", "lane", "windows", *(f"a_{c}" for c in TREE_FIELDS), *TREE_FIELDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                here = (batch.column(0)[n].as_py(), batch.column(1)[n].as_py())
                if here != at:
                    if state is not None:
                        yield state.found()
                    at, state = here, Search(unpacked(*(batch.column(c)[n].as_py() for c in range(3, 8))), batch.column(2)[n].as_py(), k, same)
                state.visit(unpacked(*(batch.column(c)[n].as_py() for c in range(8, 13))))
        if state is not None:
            yield state.found()

    return work.select(*columns).mapInArrow(run, "anchor_id long, key long, vec_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each window, with their rank from 1."""
    rank = F.row_number().over(Window.partitionBy("anchor_id", "key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def window_lists(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """(block, windows) of (anchor_id, key, floor, ceiling) rows; a block has BLOCK anchors, each with few windows."""
    listed = members.join(wanted, "anchor_id").groupBy("block")
    return listed.agg(F.collect_list(F.struct("anchor_id", "key", "floor", "ceiling")).alias("windows"))


def block_members(blocks: DataFrame) -> DataFrame:
    """(block, anchor_id) of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                members = np.frombuffer(ids, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(members), node)), pa.array(members)], names=["block", "anchor_id"])

    return blocks.select("node", "ids").mapInArrow(run, "block long, anchor_id long")


def bounded_pairs(pairs: DataFrame, windows: DataFrame) -> DataFrame:
    """The pairs of nodes whose interval meets what a window of the block looks for."""
    bounds = windows.select("block", F.array_min("windows.floor").alias("__floor"), F.array_max("windows.ceiling").alias("__ceiling"))
    return pairs.join(bounds, "block").where("high >= __floor AND low <= __ceiling").drop("__floor", "__ceiling")


def mine(rows: DataFrame, dims: int, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, exactly, of the rows of :func:`integer_vectors`.

    Anchors are the rows whose id is divisible by ``every``; an anchor's positives are its ``positives`` best other rows of the
    same label; for each positive the ``negatives`` best rows of other labels are returned whose score is between ``low`` and
    ``high`` percent of the positive's. Ties go to the smaller id; where fewer rows are, all are returned; an anchor without
    positives, or a positive without such rows, has no row, and an empty table gives none. Rows may be of one label or of one
    vector: slabs and blocks are cut by count, and no task holds more than one of each.
    """
    spark = rows.sparkSession
    rows = stage(rows, "hard-negative-rows")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRAINING).select("x").toArrow().column(0).combine_chunks()
    if not len(sample):
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    splits = learn_splits(to_matrix(sample, dims).astype(np.float64))
    slabs = build_trees(rows, dims, SLAB, splits, "candidate-trees")
    blocks = build_trees(rows.where(F.pmod("vec_id", F.lit(every)) == 0), dims, BLOCK, splits, "anchor-trees")
    members = stage(block_members(blocks), "anchor-blocks")

    pairs = stage(node_pairs(blocks, slabs, same=True), "node-pairs")
    turn = F.row_number().over(Window.partitionBy("block").orderBy(F.desc("high"), "slab"))
    pairs = pairs.withColumn("turn", turn)
    whole = members.select("anchor_id", F.lit(0).cast("long").alias("key"), F.lit(-LIMIT).alias("floor"), F.lit(LIMIT).alias("ceiling"))
    first = stage(best(search(pairs.where(F.col("turn") <= FIRST), blocks, slabs, window_lists(members, whole), positives, True), positives), "first-positives")
    last = first.where(F.col("rank") == positives).select("anchor_id", F.col("score").alias("__floor"))
    raised = whole.join(last, "anchor_id", "left").withColumn("floor", F.coalesce("__floor", "floor")).drop("__floor")
    windows = stage(window_lists(members, raised), "positive-windows")
    rest = search(bounded_pairs(pairs.where(F.col("turn") > FIRST), windows), blocks, slabs, windows, positives, True)
    found = best(first.drop("rank").unionByName(rest), positives)
    found = stage(found.select("anchor_id", F.col("vec_id").alias("key"), F.col("score").alias("positive_score")), "positives")

    # The floor is the smallest score of at least ``low`` percent; no score lies between where the positive's is negative.
    floor, ceiling = (F.expr(f"CAST({r}({p} * CAST(positive_score AS DECIMAL(38, 0)) / 100) AS LONG)") for r, p in (("ceil", low), ("floor", high)))
    wanted = found.withColumns({"floor": floor, "ceiling": ceiling}).where("floor <= ceiling")
    windows = stage(window_lists(members, wanted), "negative-windows")
    pairs = bounded_pairs(node_pairs(blocks, slabs, same=False), windows)
    mined = best(search(pairs, blocks, slabs, windows, negatives, False), negatives)
    return mined.join(found, ["anchor_id", "key"]).select(
        "anchor_id", F.col("key").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def shifted_label() -> Column:
    """The label, moved on by one of ten where the id is divisible by 7."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def mine_embeddings(vectors: DataFrame) -> DataFrame:
    """:func:`mine` over ``embeddings`` with :func:`shifted_label`; other columns aren't read."""
    return mine(*integer_vectors(vectors, shifted_label()))


def exact_sql(every: int = 100, positives: int = 5, negatives: int = 5) -> str:
    """DuckDB SQL: every anchor against every row."""
    return f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * c.e[i]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % {every} = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY rank <= {negatives}"""
