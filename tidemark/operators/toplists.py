"""Lists of the best rows of many queries: every row meets every query inside a task, and only a task's best of each query leave it.

Rows are streamed, queries are sent to all tasks in waves (HELD entries of lists a task holds, at most). Matrix products find which
pairs can enter a list; these alone are computed with the operations, and in the order, of the column expressions that
:mod:`.search` states. Cuts follow rounded values and then ids, as the lists do, so nothing that belongs to a list is lost.
What is shuffled grows with queries and tasks, not with pairs. Dense lists are bounded first (:func:`_limits`), so a task passes on
hardly more than its share of a list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage

#: Entries of lists that a task holds, bytes of query vectors sent out, tasks a core, rows and queries of a matrix product, entries of a matrix of terms and rows.
HELD, SENT, TASKS, ROWS, QUERIES, CELLS = 4 << 20, 64 << 20, 3, 2048, 512, 2 << 20
#: Distances that a task gives for the bounds of lists: so many a query, or so many times its share of a list.
EACH = 4
#: Places that values are rounded to, and squared lengths within which products neither overflow nor vanish.
PLACES, LEAST, MOST = 6, 1e-140, 1e140
LAST = np.iinfo(np.int64).max


def rounded(values: np.ndarray) -> np.ndarray:
    """Values in units of the last place, half up by their decimal digits; NaN comes last."""
    scaled = values * 10.0**PLACES
    known = np.abs(scaled) < 2.0**40
    units = np.full(len(values), LAST)
    units[known] = np.floor(np.abs(scaled[known]) + 0.5) * np.sign(scaled[known])
    units[~known & ~np.isnan(values)] = np.clip(scaled[~known & ~np.isnan(values)], -9e18, 9e18)
    near_half = np.abs(np.where(known, np.abs(scaled), 0) % 1 - 0.5) < 1e-3
    for i in np.flatnonzero(known & near_half):
        units[i] = int(Decimal(repr(float(values[i]))).scaleb(PLACES).quantize(Decimal(1), ROUND_HALF_UP))
    return units


class Lists:
    """The ``n`` rows of least key of each query, ties by id. With ``limits``, rows beyond the query's are left out."""

    def __init__(self, count: int, n: int, limits: np.ndarray | None = None):
        self.n, self.limit, self.size = n, np.full(count, LAST) if limits is None else limits.copy(), 0
        self.held: list[tuple[np.ndarray, ...]] = []

    def add(self, query: np.ndarray, ids: np.ndarray, key: np.ndarray, value: np.ndarray) -> None:
        enters = key <= self.limit[query]
        self.held.append((query[enters], ids[enters], key[enters], value[enters]))
        self.size += int(enters.sum())
        if self.size > max(1 << 17, 2 * self.n * len(self.limit)):
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...] | None:
        if not self.held:
            return None
        query, ids, key, value = (np.concatenate(c) for c in zip(*self.held, strict=True))
        name = ids if ids.dtype.kind in "iu" else np.unique(ids, return_inverse=True)[1]
        order = np.lexsort((name, key, query))
        starts = np.flatnonzero(np.diff(query[order], prepend=-1))
        counts = np.diff(np.append(starts, len(order)))
        place = np.arange(len(order)) - np.repeat(starts, counts)
        full = counts >= self.n
        self.limit[query[order[starts[full]]]] = key[order[starts[full] + self.n - 1]]
        kept = order[place < self.n]
        self.held, self.size = [(query[kept], ids[kept], key[kept], value[kept])], len(kept)
        return self.held[0]

    def batches(self, names: pa.Array, ids: pa.DataType, columns: list[str]) -> Iterator[pa.RecordBatch]:
        found = self.cut()
        for at in range(0, len(found[0]) if found else 0, 65_536):
            query, row, _, value = (c[at : at + 65_536] for c in found)
            row = row if row.dtype.kind in "iu" else [r.decode() for r in row]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(query)), pa.array(row, ids), pa.array(value)], names=columns)


def _ids(column: pa.Array) -> np.ndarray:
    """Ids that sort as Spark sorts them: numbers, or strings as bytes."""
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False)
    found = np.empty(len(column), object)
    found[:] = [v.encode() for v in column.to_pylist()]
    return found


def _running(products: np.ndarray) -> np.ndarray:
    """Sums of rows, one component after the other."""
    return np.cumsum(products, axis=1)[:, -1] if products.shape[1] else np.zeros(len(products))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, vectors) of each length; empty vectors are left out."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == dims)
        yield at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _products(x: np.ndarray, xx: np.ndarray, q: np.ndarray, qq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cosine distances (query, row) by a matrix product; rows and queries that it holds for. Of other rows the distance is infinite here."""
    plain_x, plain_q = (xx > LEAST) & (xx < MOST), (qq > LEAST) & (qq < MOST)
    ux = np.where(plain_x[:, None], x, 0) / np.sqrt(np.where(plain_x, xx, 1))[:, None]
    uq = np.where(plain_q[:, None], q, 0) / np.sqrt(np.where(plain_q, qq, 1))[:, None]
    away = 1.0 - uq @ ux.T
    away[:, ~plain_x] = np.inf
    return away, plain_x, plain_q


def nearest(x: np.ndarray, xx: np.ndarray, q: np.ndarray, qq: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The distances of ``held`` (query, place) and of the rows, the least of each query, as many as ``held`` has places."""
    away, _, plain_q = _products(x, xx, q, qq)
    away[~plain_q] = np.inf
    m = held.shape[1]
    if len(x) > m:
        away = np.partition(away, m - 1, axis=1)[:, :m]
    return np.partition(np.concatenate([held, away], axis=1), m - 1, axis=1)[:, :m]


def near_pairs(x: np.ndarray, xx: np.ndarray, q: np.ndarray, qq: np.ndarray, limit: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """(row, query, cosine distance): all pairs that can be among the n nearest of a query whose list ends at ``limit`` (in units)."""
    away, plain_x, plain_q = _products(x, xx, q, qq)
    most = np.where(limit == LAST, np.inf, limit * 10.0**-PLACES)
    open_ = np.flatnonzero(np.isinf(most))
    if len(open_) and n < len(x):
        most[open_] = np.partition(away[open_], n - 1, axis=1)[:, n - 1]
    met = away <= (most + 2 * 10.0**-PLACES)[:, None]
    met[:, ~plain_x] = ~plain_x[~plain_x] & (xx[~plain_x] != 0)  # rows whose products may overflow or vanish
    met[~plain_q] = True
    query, row = np.nonzero(met)
    with np.errstate(all="ignore"):
        size = np.sqrt(xx[row] * qq[query])
        dist = 1.0 - _running(x[row] * q[query]) / size
    some = size != 0
    return row[some], query[some], dist[some]


def _no_nulls(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNotNull()).where(F.coalesce(F.forall(column, lambda x: x.isNotNull()), F.lit(False)))


def tasks(spark) -> int:
    return TASKS * spark.sparkContext.defaultParallelism


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt evenly to all tasks. Chunks that were filtered by a broadcast join lie in the few files that hold their ids, and a
    few tasks would then do all the work on their texts."""
    return rows.repartition(tasks(rows.sparkSession))


def _waves(queries: DataFrame, n: int, key: str, width: int = 1) -> list[DataFrame]:
    """The staged queries in parts whose lists a task can hold."""
    most = max(1, min(HELD // max(n, 1), SENT // width))
    waves = -(-queries.count() // most)
    return [queries] if waves < 2 else [queries.where(F.pmod(F.xxhash64(key), F.lit(waves)) == i) for i in range(waves)]


def _limits(rows: DataFrame, groups: list[tuple], count: int, n: int) -> np.ndarray:
    """Of each query a distance, in units, that no row of its list exceeds: every task gives the distances of the few rows nearest to it
    (by the matrix product), and the nth of all of them is such a bound. Queries with fewer rows have none."""
    each = min(n, max(EACH, -(-EACH * n // rows.sparkSession.sparkContext.defaultParallelism)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.full((count, each), np.inf)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                for _, x in _by_length(batch.column(1).slice(start, ROWS)):
                    with np.errstate(all="ignore"):
                        xx = _running(x * x)
                    for places, vectors, sizes, _ in groups:
                        for of in range(0, len(places) if vectors.shape[1] == x.shape[1] else 0, QUERIES):
                            some = slice(of, of + QUERIES)
                            held[places[some]] = nearest(x, xx, vectors[some], sizes[some], held[places[some]])
        query, place = np.nonzero(held < np.inf)
        ends = np.searchsorted(query, np.arange(count + 1)).astype(np.int32)
        for at in range(0, count, 65_536):
            some = ends[at : at + 65_537]
            away = pa.ListArray.from_arrays(pa.array(some - some[0]), pa.array(held[query, place][some[0] : some[-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(some) - 1)), away], names=["query", "away"])

    nth = F.get(F.sort_array(F.flatten(F.collect_list("away"))), n - 1)
    found = rows.mapInArrow(run, "query long, away array<double>").where(F.size("away") > 0).groupBy("query").agg(nth.alias("nth"))
    bounds = found.where(F.col("nth").isNotNull()).toArrow()  # of a wave's queries at most
    limits = np.full(count, LAST)
    limits[bounds.column("query").to_numpy()] = rounded(bounds.column("nth").to_numpy()) + 1
    return limits


def dense(rows: DataFrame, queries: DataFrame, n: int, probed: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """qid, id, rank, dist: of each query (qid, qvec) the n nearest ``rows`` (id, embedding) by cosine distance, ties by id.

    With ``probed``, which gives the cells of each query vector, a query meets only the rows whose ``cell`` is among them.
    """
    spark, columns = rows.sparkSession, ["id", "embedding"] + (["cell"] if probed else [])
    asked = stage(_no_nulls(queries.select("qid", F.col("qvec").cast("array<double>").alias("qvec")), "qvec"), "asked")
    width = asked.agg(F.max(F.size("qvec"))).first()[0] or 1
    waves = _waves(asked, n, "qid", 8 * width)
    rows = _no_nulls(rows.select(*columns), "embedding")
    # Cells in few tasks each, those with many rows in several; without cells a wave reads the rows twice.
    rows = rows.repartitionByRange(tasks(spark), "cell", "id").sortWithinPartitions("cell") if probed else rows.repartition(tasks(spark))
    rows = rows if probed and len(waves) == 1 else stage(rows, "rows")
    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((asked, "qid"), (rows, "id"))}
    arrow = pa.string() if kinds["id"] == "string" else None

    def wave(part: DataFrame) -> DataFrame:
        sent = part.toArrow().combine_chunks()  # HELD / n queries, SENT bytes at most
        names = sent.column(0).chunk(0) if sent.num_rows else pa.array([], sent.schema.field(0).type)
        groups = []
        for at, vectors in _by_length(sent.column(1).chunk(0)) if sent.num_rows else ():
            groups.append((at, vectors, _running(vectors * vectors), probed(vectors) if probed else None))

        limits = np.full(len(names), LAST) if probed else _limits(rows, groups, len(names), n)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lists = Lists(len(names), n, limits)
            asking: dict[int, list[np.ndarray]] = {}
            for g, (_, _, _, cells) in enumerate(groups if probed else []):
                order = np.argsort(cells.ravel(), kind="stable")
                values, starts = np.unique(cells.ravel()[order], return_index=True)
                for cell, mine in zip(values.tolist(), np.split(order // max(cells.shape[1], 1), starts[1:]), strict=True):
                    asking.setdefault(cell, [np.zeros(0, np.int64)] * len(groups))[g] = np.unique(mine)
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    cut = batch.slice(start, ROWS)
                    ids = _ids(cut.column(0))
                    cells = cut.column(2).to_numpy() if probed else np.zeros(cut.num_rows, int)
                    for at, x in _by_length(cut.column(1)):
                        with np.errstate(all="ignore"):
                            xx = _running(x * x)
                        for g, (places, vectors, sizes, _) in enumerate(groups):
                            if vectors.shape[1] != x.shape[1]:
                                continue
                            for cell in np.unique(cells[at]).tolist():
                                here = cells[at] == cell
                                mine = asking[cell][g] if probed and cell in asking else np.arange(0 if probed else len(places))
                                for of in range(0, len(mine), QUERIES):
                                    some = mine[of : of + QUERIES]
                                    row, query, dist = near_pairs(x[here], xx[here], vectors[some], sizes[some], lists.limit[places[some]], n)
                                    lists.add(places[some[query]], ids[at[here][row]], rounded(dist), dist)
            yield from lists.batches(names, arrow, ["qid", "id", "dist"])

        return rows.mapInArrow(run, f"qid {kinds['qid']}, id {kinds['id']}, dist double")

    found = reduce(DataFrame.unionAll, [wave(part) for part in waves]).withColumn("dist", F.round("dist", PLACES))
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= n).select("qid", "id", "rank", "dist")


def term_sets(queries: DataFrame) -> DataFrame:
    """terms, qids: each distinct set of terms once, with the queries that ask for it. Queries without terms, or with a null, find nothing."""
    sets = queries.select("qid", F.array_sort(F.array_distinct("terms")).alias("terms"))
    return _no_nulls(sets, "terms").where(F.size("terms") > 0)


def lexical(counted: Callable[[pa.Array], DataFrame], corpus: Callable[[], tuple[int, float]] | None, queries: DataFrame, n: int, k1: float, b: float) -> DataFrame:
    """qid, id, rank, bm25: of the rows that hold all of a query's terms, the n with the highest BM25, ties by id.

    ``counted`` gives id, length, codes, tfs of all rows: which of the asked terms (by their places) a row holds, and how often; a null
    length is that of a null content. ``corpus`` gives the number of rows and their mean length; None takes them from ``counted``.
    """
    # Written before they are filtered: a filter on terms that are still to be cut would cut those of every row it is pushed down to.
    asked = stage(term_sets(stage(queries.select("qid", "terms"), "asked-terms")), "asked-sets")
    sets = stage(asked.groupBy("terms").agg(F.min("qid").alias("qid")), "term-sets")  # one of the queries names the set
    kind = sets.schema["qid"].dataType.simpleString()

    def wave(part: DataFrame) -> DataFrame:
        sent = part.toArrow().combine_chunks()  # HELD / n sets at most
        listed = sent.column("terms").chunk(0) if sent.num_rows else pa.array([], pa.list_(pa.string()))
        names = sent.column("qid").chunk(0) if sent.num_rows else pa.array([], sent.schema.field("qid").type)
        terms = listed.flatten().unique()
        rows = stage(counted(terms), "counted")
        total = corpus() if corpus else tuple(rows.agg(F.count(F.lit(1)), F.avg("length")).first())
        held = rows.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("df"))
        idf = F.log(1 + (F.lit(total[0]) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weights = np.zeros(len(terms))
        for r in held.select("code", idf.alias("idf")).collect():  # the asked terms at most
            weights[r.code] = r.idf
        mean = total[1] or 1.0
        codes = np.array(terms.dictionary_encode().indices) if len(terms) else np.zeros(0, int)
        place = dict(zip(terms.to_pylist(), codes.tolist(), strict=True))
        sizes: dict[int, list] = {}
        for i, one in enumerate(listed.to_pylist()):
            sizes.setdefault(len(one), []).append((i, [place[t] for t in one]))
        groups = [(np.array([i for i, _ in g]), np.array([c for _, c in g])) for g in sizes.values()]
        step = max(64, min(ROWS, CELLS // max(len(terms), 1)))
        id_kind = rows.schema["id"].dataType.simpleString()
        arrow = pa.string() if id_kind == "string" else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lists = Lists(len(names), n)
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    cut = batch.slice(start, step)
                    ids, lengths = _ids(cut.column(0)), cut.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                    row = np.repeat(np.arange(cut.num_rows), cut.column(2).value_lengths().to_numpy(zero_copy_only=False))
                    code, tf = (cut.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
                    parts = np.full((len(weights), cut.num_rows), -np.inf)
                    parts[code, row] = weights[code] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[row] / mean))
                    for which, of in groups:
                        for at in range(0, len(which), QUERIES // 2):
                            some, mine = of[at : at + QUERIES // 2], which[at : at + QUERIES // 2]
                            score = parts[some[:, 0]]
                            for c in range(1, some.shape[1]):
                                score += parts[some[:, c]]
                            limit = lists.limit[mine]
                            least = np.where(limit == LAST, -np.inf, -limit * 10.0**-PLACES)
                            open_ = np.flatnonzero(np.isinf(least))
                            if len(open_) and n < len(ids):
                                least[open_] = np.partition(score[open_], len(ids) - n, axis=1)[:, len(ids) - n]
                            query, r = np.nonzero((score >= (least - 2 * 10.0**-PLACES)[:, None]) & (score > -np.inf))
                            found = score[query, r]
                            lists.add(mine[query], ids[r], -rounded(found), found)
            yield from lists.batches(names, arrow, ["set", "id", "bm25"])

        return rows.mapInArrow(run, f"set {kind}, id {id_kind}, bm25 double")

    found = reduce(DataFrame.unionAll, [wave(part) for part in _waves(sets, n, "terms")]).withColumn("bm25", F.round("bm25", PLACES))
    rank = F.row_number().over(Window.partitionBy("set").orderBy(F.desc("bm25"), "id"))
    best = stage(found.withColumn("rank", rank).where(F.col("rank") <= n), "set-lists")
    named = asked.join(sets.withColumnRenamed("qid", "set"), "terms").select("qid", "set")
    return best.join(named, "set").select("qid", "id", "rank", "bm25")


def count_terms(rows: DataFrame, terms: pa.Array) -> DataFrame:
    """id, length, codes, tfs of ``rows`` (id, terms): how often each of some terms stands in a row; other terms count in its length alone."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(1).value_lengths()
            coded = batch.column(1).flatten().dictionary_encode()
            which = pc.index_in(coded.dictionary, terms).fill_null(-1).to_numpy(zero_copy_only=False)
            code = which[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int32)
            row = np.repeat(np.arange(batch.num_rows), lengths.fill_null(0).to_numpy(zero_copy_only=False))[code >= 0]
            key, tfs = np.unique(row * max(len(terms), 1) + code[code >= 0], return_counts=True)
            ends = np.searchsorted(key // max(len(terms), 1), np.arange(batch.num_rows + 1)).astype(np.int32)
            listed = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (key % max(len(terms), 1), tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), lengths.cast(pa.int32()), *listed], names=["id", "length", "codes", "tfs"])

    return rows.select("id", "terms").mapInArrow(run, f"id {kind}, length int, codes array<int>, tfs array<int>")
