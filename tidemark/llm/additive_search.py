"""Nearest neighbours by additive quantisation.

A vector is approximated by a sum of codewords, one from each of ``BOOKS`` codebooks of full dimension. The codebooks are
learnt by k-means on the residuals that the ones before leave, over a bounded sample; encoding keeps the ``BEAM`` best
partial sums. With the stored squared norm of the sum, a query's distance to it takes one table of inner products with all
codewords and a lookup a codebook.

The index is a table of slabs: ids, codes, norms and the original vectors of many rows as binary values. Rows are dealt to slabs by
a hash of their ids, so a slab is the same sample of the table however the rows came. Blocks of queries are a table as well, and one
pass scores every slab for every block. In each slab a query has a shortlist by codes, which is compared exactly right there, and a
task passes on the nearest rows that it found for a query, no others. What leaves a task is in proportion to queries and to what
is asked for, and a shortlist depends on the size of a slab, not of the table. Where it is too short for the rows at hand, as an exact
pass for some of the queries shows, it is as long as they need.

Vectors are coded less the sample's mean and in units of its spread. Scores are summed in double precision, so that rows that
differ little from one another aren't lost in the size of what they share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .sharding import byte_offsets

BOOKS, WORDS, BEAM = 18, 256, 4
#: Vectors that the codebooks are learnt from, at most: those first in order of a hash of their ids.
TRAINING = 8_000
ROUNDS = 5
#: Rows of a slab that are compared exactly with a query: the greatest of SHORTLIST, SHORTLIST_TIMES as many as are asked for, and
#: SHORTLIST_ROOTS times the square root of the slab's rows.
SHORTLIST, SHORTLIST_TIMES, SHORTLIST_ROOTS = 128, 4, 1.5
#: Queries that are also answered exactly, and the share of their nearest rows that the shortlist has to hold.
MEASURED, WANTED = 128, 0.97
#: Rows of a slab in the mean, queries of a block, entries of shortlists of the blocks sent at once, and components compared at once.
SLAB, QUERY_BLOCK, HELD, COMPARED = 4096, 2048, 4 << 20, 1 << 18
SEED = 11


def kmeans(data: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of ``data``; where fewer rows than centres are, the rest stay at drawn rows."""
    centres = data[rng.choice(len(data), k, replace=len(data) < k)].copy()
    for _ in range(rounds):
        nearest = np.argmin((centres * centres).sum(1) - 2 * data @ centres.T, axis=1)
        counts = np.bincount(nearest, minlength=k)
        order = np.argsort(nearest, kind="stable")
        bounds = np.concatenate([[0], np.cumsum(counts)])
        full = np.flatnonzero(counts)
        centres[full] = np.add.reduceat(data[order], bounds[full], axis=0) / counts[full, None]
        empty = np.flatnonzero(counts == 0)
        centres[empty] = data[rng.choice(len(data), len(empty))]
    return centres


def learn_codebooks(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """(books, words, dimensions) codewords of the residuals."""
    rng = np.random.default_rng(seed)
    left, found = sample.astype(np.float32), []
    for _ in range(books):
        centres = kmeans(left, words, ROUNDS, rng)
        found.append(centres)
        left = left - centres[np.argmin((centres * centres).sum(1) - 2 * left @ centres.T, axis=1)]
    return np.stack(found).astype(np.float32)


def encode(vectors: np.ndarray, codebooks: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared norms of the sums): for each vector the best of the sums that a beam search reaches.

    Rows are completed to whole groups of 64, so that the matrix products round a vector alike wherever it stands.
    """
    asked, (books, words, dims) = len(vectors), codebooks.shape
    n = -(-asked // 64) * 64
    vectors = np.concatenate([vectors, np.zeros((n - asked, dims), vectors.dtype)])
    left = vectors.astype(np.float32)[:, None, :]
    codes = np.zeros((n, 1, 0), np.uint8 if words <= 256 else np.uint16)
    rows = np.arange(n)[:, None]
    for book in codebooks:
        size = (left * left).sum(2)[:, :, None] + (book * book).sum(1)
        cost = (size - 2 * (left.reshape(-1, dims) @ book.T).reshape(n, -1, words)).reshape(n, -1)
        width = min(beam, cost.shape[1])
        best = np.argpartition(cost, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(cost, best, 1), axis=1, kind="stable"), 1)
        path, word = best // words, best % words
        left = left[rows, path] - book[word]
        codes = np.concatenate([codes[rows, path], word[:, :, None].astype(codes.dtype)], axis=2)
    best = codes[:, 0]
    sums = np.zeros((n, dims), np.float32)
    for m in range(books):
        sums += codebooks[m][best[:, m]]
    return best[:asked], (sums * sums).sum(1)[:asked]


def lookup_scores(queries: np.ndarray, codebooks: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Squared distances of each query to each coded vector, less the query's own squared norm."""
    table = np.einsum("qd,mkd->mqk", queries.astype(np.float64), codebooks.astype(np.float64), optimize=True)
    inner = np.zeros((len(queries), len(codes)))
    for m in range(len(codebooks)):
        inner += table[m][:, codes[:, m]]
    return norms - 2 * inner


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed in the order of the dimensions."""
    total = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
    for d in range(a.shape[-1]):
        gap = a[..., d] - b[..., d]
        total += gap * gap
    return np.sqrt(total)


def usable(vectors: DataFrame) -> tuple[DataFrame, int, int]:
    """(vec_id, embedding) rows that take part, their dimensions (the most frequent length, the smaller of equals), and their number.

    Rows with a null id, and vectors that are null, zero, of another length, or hold a null or non-finite component, don't.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(
        "embedding", lambda x: x != 0
    )
    kept = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(F.coalesce(fine, F.lit(False)))
    sizes = kept.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims, count = (sizes[0].n, sizes[0]["count"]) if sizes else (0, 0)
    return kept.where(F.size("embedding") == dims), dims, count


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


@dataclass(frozen=True)
class Quantiser:
    """Codebooks of vectors less ``middle``, in units of ``unit``."""

    books: np.ndarray
    middle: np.ndarray
    unit: float

    @classmethod
    def of(cls, sample: np.ndarray) -> Quantiser:
        middle = sample.mean(0)
        # A power of two: vectors are scaled without rounding.
        unit = 2.0 ** np.frexp(max(float(np.abs(sample - middle).max()), np.finfo(float).tiny))[1]
        return cls(learn_codebooks((sample - middle) / unit), middle, unit)

    def scaled(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.middle) / self.unit

    def coded(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, squared norms of the sums, squared errors), both in double precision."""
        vectors = self.scaled(vectors)
        codes, _ = encode(vectors, self.books)
        sums = np.zeros(vectors.shape)
        for m, book in enumerate(self.books):
            sums += book[codes[:, m]]
        return codes, (sums * sums).sum(1), ((vectors - sums) ** 2).sum(1)


def slab_number(slabs: int) -> Column:
    """The slab that a row is dealt to."""
    return F.pmod(F.xxhash64("vec_id"), F.lit(slabs)).cast("int")


SLABS = "slab int, ids binary, codes binary, norms binary, errors binary, vectors binary"


def build_index(vectors: DataFrame, dims: int, number: int) -> tuple[DataFrame | None, Quantiser | None]:
    """:data:`SLABS` of all rows, written to the shared folder, and the codebooks; None twice for an empty table.

    A slab holds a ``number``-th of the rows, in order of their ids; one that many rows of a single id make much larger is cut.
    """
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRAINING).select("embedding").toArrow().column(0).combine_chunks()
    if not len(sample):
        return None, None
    quantiser, most = Quantiser.of(matrix(sample, dims)), 4 * SLAB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, of = [], 0, None

        def slab() -> pa.RecordBatch:
            packed = [b"".join(column) for column in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([of], pa.int32()), *(pa.array([c], pa.binary()) for c in packed)], names=["slab", "ids", "codes", "norms", "errors", "vectors"]
            )

        for whole in batches:
            numbers = whole.column(0).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                for at in range(start, end, 2048):
                    if size and (numbers[start] != of or size >= most):
                        yield slab()
                        held, size = [], 0
                    of, batch = int(numbers[start]), whole.slice(at, min(2048, end - at))
                    rows = matrix(batch.column(2), dims)
                    codes, norms, errors = quantiser.coded(rows)
                    ids = batch.column(1).to_numpy().astype("<i8")
                    held.append((ids.tobytes(), codes.tobytes(), norms.astype("<f8").tobytes(), errors.astype("<f8").tobytes(), rows.astype("<f8").tobytes()))
                    size += batch.num_rows
        if size:
            yield slab()

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = vectors.select(slab_number(number).alias("slab"), "vec_id", "embedding").repartition(parts, "slab").sortWithinPartitions("slab", "vec_id")
    return stage(dealt.mapInArrow(run, SLABS), "additive-index"), quantiser


def true_nearest(vectors: DataFrame, queries: DataFrame, dims: int, k: int, number: int) -> tuple[list, dict[int, np.ndarray]]:
    """The measured queries' vectors, after (query_id, vec_id, near, embedding, slab) of the k nearest rows of each of at most MEASURED queries, by an exact pass over all rows."""
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MEASURED).collect()
    names, points = np.array([r.vec_id for r in asked], np.int64), np.array([r.embedding for r in asked], float).reshape(-1, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                ids = batch.column(0).to_numpy()
                away = distances(points[:, None, :], matrix(batch.column(1), dims)[None, :, :])
                away[names[:, None] == ids] = np.inf
                limit = np.partition(away, k - 1, axis=1)[:, k - 1] if k < len(ids) else np.full(len(names), np.inf)
                query, row = np.nonzero((away <= limit[:, None]) & np.isfinite(away))
                best = best_of(best, (names[query], ids[row], away[query, row]), k)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in best], names=["query_id", "vec_id", "near"])

    met = vectors.select("vec_id", "embedding").mapInArrow(run, "query_id long, vec_id long, near double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("near", "vec_id"))
    once = met.groupBy("query_id", "vec_id").agg(F.min("near").alias("near"))
    nearest = stage(once.withColumn("place", place).where(F.col("place") <= k).drop("place"), "true-nearest")
    rows = vectors.join(F.broadcast(nearest.select("vec_id").distinct()), "vec_id").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return nearest.join(rows, "vec_id").withColumn("slab", slab_number(number)).collect(), dict(zip(names.tolist(), points, strict=True))  # MEASURED * k rows at most


def needed(vectors: DataFrame, slabs: DataFrame, quantiser: Quantiser, queries: DataFrame, dims: int, k: int, number: int) -> tuple[int, float]:
    """(rows, weight): how long a slab's shortlists hold the share WANTED of the nearest rows of the measured queries, and whether a row's score
    is its code's (0.0) or that and the code's squared error (1.0), whichever needs the shorter one.

    The error counts where rows are coded unequally well (no structure, many dimensions), and misleads where they lie in clusters.
    """
    found, points = true_nearest(vectors, queries, dims, k, number)
    if not found:
        return 0, 0.0
    codes, norms, errors = quantiser.coded(np.array([r.embedding for r in found], float))
    ids, owners = np.array([r.vec_id for r in found], np.int64), np.array([r.query_id for r in found], np.int64)
    scaled = {n: quantiser.scaled(v) for n, v in points.items()}
    of_slab = {n: np.flatnonzero([r.slab == n for r in found]) for n in {r.slab for r in found}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                here = of_slab.get(batch.column(0)[row].as_py(), np.zeros(0, int))  # nearest rows that lie in this slab
                if not len(here):
                    continue
                all_ids, all_codes, all_norms, all_errors = (c[row].as_buffer() for c in batch.columns[1:5])
                all_ids, all_norms, all_errors = np.frombuffer(all_ids, "<i8"), np.frombuffer(all_norms, "<f8"), np.frombuffer(all_errors, "<f8")
                all_codes = np.frombuffer(all_codes, np.uint8).reshape(len(all_ids), -1)
                ahead = np.zeros((2, len(here)), np.int64)
                for name in np.unique(owners[here]).tolist():
                    mine = np.flatnonzero(owners[here] == name)
                    rows = here[mine]
                    plain = lookup_scores(scaled[name][None], quantiser.books, np.concatenate([all_codes, codes[rows]]), np.concatenate([all_norms, norms[rows]]))[0]
                    n = len(all_ids)
                    for weight in (0, 1):
                        scores = plain + weight * np.concatenate([all_errors, errors[rows]])
                        other, own = scores[:n], scores[n:][:, None]
                        before = (other < own) | ((other == own) & (all_ids < ids[rows][:, None]))
                        ahead[weight, mine] = (before & (all_ids != name)).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([0, 1], len(here))), pa.array(np.tile(here, 2)), pa.array(ahead.ravel())], names=["weight", "row", "n"]
                )

    counts = slabs.mapInArrow(run, "weight long, row long, n long").groupBy("weight", "row").agg(F.sum("n").alias("n")).collect()  # twice MEASURED * k
    places = {w: np.sort([r.n for r in counts if r.weight == w]) for w in (0, 1)}
    lengths = {w: int(p[math.ceil(WANTED * len(p)) - 1]) + 1 for w, p in places.items()}
    weight = min(lengths, key=lambda w: (lengths[w], w))
    return lengths[weight], float(weight)


def query_blocks(queries: DataFrame, size: int) -> DataFrame:
    """(block, query_ids, queries): binary values of ``size`` queries at most, in order of their ids."""
    numbered = byte_offsets(queries.withColumn("size", F.lit(1)), ["vec_id"]).withColumn("block", F.expr(f"row DIV {size}"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        values = np.array(pdf["embedding"].tolist(), "<f8")
        return pd.DataFrame({"block": [pdf["block"].iat[0]], "query_ids": [pdf["vec_id"].to_numpy("<i8").tobytes()], "queries": [values.tobytes()]})

    return stage(numbered.groupBy("block").applyInPandas(pack, "block long, query_ids binary, queries binary"), "query-blocks")


def shortlists(query_ids, queries, codebooks, ids, codes, norms, short) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) places, for some queries at a time: of each query the ``short`` rows of a slab with the smallest lookup scores, itself excluded; equal scores
    by the smaller id. Rows of one id count as one, by the smallest of their scores, and are all given."""
    order = np.argsort(ids, kind="stable")
    ids, codes, norms = ids[order], codes[order], norms[order]
    starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    names, sizes = ids[starts], np.diff(starts, append=len(ids))
    for at in range(0, len(query_ids), 64):
        scores = lookup_scores(queries[at : at + 64], codebooks, codes, norms)
        if len(names) < len(ids):
            scores = np.minimum.reduceat(scores, starts, axis=1)
        own = np.searchsorted(names, query_ids[at : at + 64])
        for q, place in enumerate(own.tolist()):
            if place < len(names) and names[place] == query_ids[at + q]:
                scores[q, place] = np.inf
        if short < len(names):
            limit = np.partition(scores, short - 1, axis=1)[:, short - 1]
        found = []
        for q in range(len(scores)):
            chosen = np.arange(len(names))
            if short < len(names):
                below, ties = np.flatnonzero(scores[q] < limit[q]), np.flatnonzero(scores[q] == limit[q])
                chosen = np.concatenate([below, ties[: short - len(below)]])
            chosen = chosen[np.isfinite(scores[q, chosen])]
            of = sizes[chosen]
            rows = order[np.repeat(starts[chosen], of) + np.arange(of.sum()) - np.repeat(np.cumsum(of) - of, of)]
            found.append((np.full(len(rows), at + q), rows))
        yield tuple(np.concatenate(c) for c in zip(*found, strict=True))


def compared(points: np.ndarray, vectors: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The distances of pairs, by their places, as :func:`distances` gives them."""
    step = max(1, COMPARED // max(points.shape[1], 1))
    cuts = [slice(at, at + step) for at in range(0, len(row), step)]
    return np.concatenate([distances(points[query[c]], vectors[row[c]]) for c in cuts]) if cuts else np.zeros(0)


def best_of(held: tuple[np.ndarray, ...] | None, found: tuple[np.ndarray, ...], short: int) -> tuple[np.ndarray, ...]:
    """(query_id, vec_id, score) of the ``short`` smallest scores of each query in both, by query, score and id; a row counts once."""
    query, row, near = found
    if held is not None and len(held[0]):
        # What lies behind the end of a full shortlist can't enter it.
        names, starts, counts = np.unique(held[0], return_index=True, return_counts=True)
        limits = np.where(counts >= short, held[2][starts + counts - 1], np.inf)
        place = np.minimum(np.searchsorted(names, query), len(names) - 1)
        enters = (names[place] != query) | (near <= limits[place])
        query, row, near = (np.concatenate([a, b[enters]]) for a, b in zip(held, found, strict=True))
    order = np.lexsort((near, row, query))
    query, row, near = query[order], row[order], near[order]
    first = np.concatenate([[True], (query[1:] != query[:-1]) | (row[1:] != row[:-1])]) if len(query) else np.zeros(0, bool)
    query, row, near = query[first], row[first], near[first]
    order = np.lexsort((row, near, query))
    query, row, near = query[order], row[order], near[order]
    _, starts, counts = np.unique(query, return_index=True, return_counts=True)
    kept = np.arange(len(query)) - np.repeat(starts, counts) < short
    return query[kept], row[kept], near[kept]


def candidates(slabs: DataFrame, blocks: DataFrame, quantiser: Quantiser, short: int, together: int, k: int, weight: float = 0.0) -> DataFrame:
    """(query_id, vec_id, score): of each query the k nearest rows among the ``short`` of each slab with the smallest lookup scores.

    ``together`` blocks are sent to all slabs at once; a task holds k rows for each of their queries and passes on no others.
    """
    books, dims = quantiser.books.shape[0], quantiser.books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, ...]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                _, ids, codes, norms, errors, vectors, block, names, points = (c[row] for c in batch.columns)
                ids, norms, errors, vectors, names, points = (
                    np.frombuffer(c.as_buffer(), t) for c, t in ((ids, "<i8"), (norms, "<f8"), (errors, "<f8"), (vectors, "<f8"), (names, "<i8"), (points, "<f8"))
                )
                codes, vectors, points = np.frombuffer(codes.as_buffer(), np.uint8).reshape(-1, books), vectors.reshape(-1, dims), points.reshape(-1, dims)
                found = []
                for query, at in shortlists(names, quantiser.scaled(points), quantiser.books, ids, codes, norms + weight * errors, short):
                    found.append(best_of(None, (names[query], ids[at], compared(points, vectors, query, at)), k))
                number = block.as_py()
                best[number] = best_of(best.get(number), tuple(np.concatenate(c) for c in zip(*found, strict=True)), k)
        for number in sorted(best):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.pop(number)], names=["query_id", "vec_id", "near"])

    # A stated query set, in blocks, against all rows.
    dealt = slabs.repartition(int(slabs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    waves = -(-blocks.count() // together)
    met = [
        dealt.crossJoin(F.broadcast(blocks.where(F.expr(f"block DIV {together} = {wave}")))).mapInArrow(run, "query_id long, vec_id long, near double")
        for wave in range(max(1, waves))
    ]
    return reduce(DataFrame.unionAll, met).groupBy("query_id", "vec_id").agg(F.min("near").alias("score"))


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``, itself excluded.

    ``score`` is the exact Euclidean distance; ties go to the smaller id; where fewer candidates are, all are returned.
    :func:`usable` says which rows take part. Rows with one id count as one: the query is their first vector in order of
    components, a candidate their nearest. An empty table gives no rows; other columns aren't read.
    """
    vectors, dims, rows = usable(vectors)
    number = max(1, -(-rows // SLAB))
    slabs, quantiser = build_index(vectors, dims, number)
    if quantiser is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    short = max(SHORTLIST, SHORTLIST_TIMES * k, math.ceil(SHORTLIST_ROOTS * math.sqrt(min(rows, SLAB))))
    weight = 0.0
    if rows > short + 1:
        long, weight = needed(vectors, slabs, quantiser, queries, dims, k, number)
        short = max(short, long)
    size = max(1, min(QUERY_BLOCK, HELD // short))
    found = stage(candidates(slabs, query_blocks(queries, size), quantiser, short, max(1, HELD // (size * short)), k, weight), "nearest-found")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_sql(every: int = 100, k: int = 10) -> str:
    """DuckDB SQL of the exact answer, for tables on which the shortlist misses nothing."""
    return f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])))) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM d
WINDOW w AS (PARTITION BY query_id ORDER BY score, vec_id) QUALIFY rank <= {k}"""
