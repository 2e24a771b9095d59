"""A stored positional index: for each term its postings in blocks, below the folder of the term's bucket.

A posting is a row's id, its length, and the positions of the term in it. Blocks hold :data:`BLOCK` postings of one term at
most, in order of id, with what bounds their scores (the largest term frequency, the smallest length). Files are ordered by
term, so a search reads the buckets of its terms and, within them, the row groups that may hold those terms.

An index is a list of segments that never change. New rows are a new segment; rows that went are listed as dead and left out
when postings are read, until :func:`refreshed` finds it worth while to write the index anew.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators import toplists
from ..operators.search import B, DEPTH, K1, LexicalQuery, top
from ..staging import drop_staged, stage

#: Folders that terms are dealt to, postings of a block, segments and share of dead rows from which the index is written anew.
BUCKETS, BLOCK, MOST_SEGMENTS, MOST_DEAD = 64, 128, 8, 0.25
#: Postings that are scored before blocks are skipped by their bounds, as a multiple of the rows asked for.
HEAD = 4
#: Queries from which on each posting of their terms is read once for all of them, not once a query.
MANY = 16

BLOCKS = "term string, first_id long, last_id long, n int, ids array<long>, lengths array<int>, positions array<array<int>>, max_tf int, min_length int, bucket int"


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _postings(rows: pa.RecordBatch) -> pa.RecordBatch:
    """(term, id, length, positions) of rows (id, terms): places are grouped by row and term in one sort."""
    lengths = pc.list_value_length(rows.column(1)).to_numpy().astype(np.int64)
    coded = pc.dictionary_encode(rows.column(1).flatten())
    row = np.repeat(np.arange(rows.num_rows), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key = row * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.diff(key[order], prepend=-1))
    one = order[starts]
    places = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()), pa.array(place[order].astype(np.int32)))
    columns = [coded.dictionary.take(coded.indices.take(pa.array(one))), rows.column(0).take(pa.array(row[one])), pa.array(lengths[row[one]].astype(np.int32)), places]
    return pa.RecordBatch.from_arrays(columns, names=["term", "id", "length", "positions"])


def _cut(rows: pa.Table, size: int, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
    """(blocks, what is left) of postings (bucket, term, id, length, positions) in order; the last block stays open until the end."""
    rows = rows.combine_chunks()
    numbers, terms, ids, lengths, places = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in rows.columns)
    change = np.flatnonzero(pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)) + 1
    runs = np.concatenate([[0], change, [len(terms)]]) if len(terms) else np.array([0])
    cuts = np.concatenate([np.arange(a, b, size) for a, b in zip(runs[:-1], runs[1:], strict=True)] + [[len(terms)]]).astype(np.int32)
    if not last:
        cuts = cuts[:-1]
    end = int(cuts[-1]) if len(cuts) else 0
    first, n = cuts[:-1], np.diff(cuts)
    some = lambda ufunc, values: ufunc.reduceat(values[:end], first).astype(np.int32) if len(first) else np.zeros(0, np.int32)
    listed = lambda values: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values[:end]) if len(first) else pa.array([], pa.list_(values.type))
    at, until = pa.array(first), pa.array(cuts[1:] - 1)
    columns = [terms.take(at), ids.take(at), ids.take(until), pa.array(n.astype(np.int32)), listed(ids), listed(lengths), listed(places),
               pa.array(some(np.maximum, pc.list_value_length(places).to_numpy())), pa.array(some(np.minimum, lengths.to_numpy())), numbers.take(at)]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in BLOCKS.split(", ")]), rows.slice(end)


def write_segment(rows: DataFrame, folder: str, terms: Column | None = None) -> None:
    """Index ``rows`` (id, content) below ``folder``: blocks by bucket, and the rows' lengths (null for a null content).

    ``terms`` gives a row's terms in order (all tokens of the content, if it is None); they are cut once, dealt evenly to all tasks,
    and staged, as sampling the ranges reads them a second time and the lengths a third. Postings are range-partitioned by
    bucket, term and id, so a term that stands in every row is cut over as many tasks as it needs; a task holds one block.
    """
    spread = toplists.spread(rows.select(F.col("id").cast("long").alias("id"), "content"))
    listed = stage(spread.select("id", (tokens("content") if terms is None else terms).alias("terms")), "terms")

    size = BLOCK

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield _postings(batch.slice(at, 256))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            for at in range(0, batch.num_rows, 16_384):
                part = pa.Table.from_batches([batch.slice(at, 16_384)])
                whole, rest = _cut(part if rest is None else pa.concat_tables([rest, part]), size, last=False)
                yield whole
        if rest is not None:
            yield _cut(rest, size, last=True)[0]

    single = listed.where("terms IS NOT NULL").mapInArrow(postings, "term string, id long, length int, positions array<int>")
    keyed = single.select(bucket(F.col("term")).alias("bucket"), "term", "id", "length", "positions")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(parts, "bucket", "term", "id").sortWithinPartitions("bucket", "term", "id")
    ordered.mapInArrow(blocks, BLOCKS).write.partitionBy("bucket").parquet(f"{folder}/blocks")
    listed.select("id", F.when(F.col("terms").isNotNull(), F.size("terms")).alias("length")).write.parquet(f"{folder}/lengths")
    drop_staged(listed)


def bm25(df: Column, tf: Column, length: Column, n_docs: Column, mean: Column) -> Column:
    idf = F.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


@dataclass(frozen=True)
class Postings:
    """The segments of an index and, if rows of them went, the folder that lists these rows' ids."""

    spark: SparkSession
    segments: list[str] = field(default_factory=list)
    dead: str | None = None

    def _read(self, what: str, schema: str) -> DataFrame:
        parts = [self.spark.read.schema(schema).parquet(f"{s}/{what}") for s in self.segments]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _living(self, rows: DataFrame) -> DataFrame:
        return rows if self.dead is None else rows.join(self.spark.read.schema("id long").parquet(self.dead), "id", "left_anti")

    def known(self) -> DataFrame:
        """id, length of every indexed row, dead ones included."""
        return self._read("lengths", "id long, length int")

    def blocks(self, terms: list[str]) -> DataFrame:
        """The blocks of some terms: only their buckets are read, and the terms are a filter of the scan."""
        listed = self.spark.range(1).select(F.explode(F.array(*map(F.lit, terms)).cast("array<string>")).alias("t"))
        numbers = [r.b for r in listed.select(bucket(F.col("t")).alias("b")).distinct().collect()]
        return self._read("blocks", BLOCKS).where(F.col("bucket").isin(sorted(numbers)) & F.col("term").isin(terms))

    def corpus(self) -> DataFrame:
        """n_docs, mean length: one row."""
        return self._living(self.known()).agg(F.count(F.lit(1)).alias("n_docs"), F.avg("length").alias("mean"))

    def topk(self, queries: DataFrame, n: int = DEPTH) -> DataFrame:
        """qid, rank, id, bm25: of the rows that hold all of a query's terms, the n with the highest BM25, ties by id.

        A query's rarest term is read first. Of its blocks those with the highest bounds are scored, and the n-th best score
        then rules out all blocks whose bound (with the best that the other terms can add) is lower. MANY queries and more meet
        the rows of their terms in one pass over these terms' postings.
        """
        if queries.limit(MANY).count() < MANY:
            return self._topk(queries, n)
        corpus = self.corpus().first()
        return toplists.lexical(self._counted, lambda: (corpus.n_docs, corpus.mean), queries, n, K1, B).select("qid", "id", "bm25", "rank")

    def _counted(self, terms: pa.Array) -> DataFrame:
        """id, length, codes, tfs of the living rows that hold some of the terms."""
        if not len(terms):
            return self.spark.createDataFrame([], "id long, length int, codes array<int>, tfs array<int>")
        coded = self.spark.createDataFrame([(t, i) for i, t in enumerate(terms.to_pylist())], "term string, code int")
        # Of many terms neither a list of literals nor a filter of the scan: their blocks are found by the join.
        numbers = [r.b for r in coded.select(bucket(F.col("term")).alias("b")).distinct().collect()]
        blocks = self._read("blocks", BLOCKS).where(F.col("bucket").isin(sorted(numbers))).join(F.broadcast(coded), "term")
        each = blocks.select("code", F.explode(F.arrays_zip("ids", "lengths", F.transform("positions", F.size).alias("tfs"))).alias("p"))
        rows = self._living(each.select(F.col("p.ids").alias("id"), F.col("p.lengths").alias("length"), "code", F.col("p.tfs").alias("tf")))
        # A row holds no more of them than it has words.
        found = rows.groupBy("id").agg(F.max("length").alias("length"), F.collect_list(F.struct("code", "tf")).alias("held"))
        return found.select("id", "length", F.col("held.code").alias("codes"), F.col("held.tf").alias("tfs"))

    def _topk(self, queries: DataFrame, n: int) -> DataFrame:
        once = queries.select("qid", F.array_distinct("terms").alias("terms")).select("qid", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
        asked = F.broadcast(stage(once, "asked-terms"))  # the terms of one block of queries
        terms = [r.term for r in asked.select("term").distinct().collect()]  # of a bounded block of queries
        blocks = self.blocks(terms)
        if self.dead is None:
            df = blocks.groupBy("term").agg(F.sum("n").alias("df"))
        else:
            df = self._living(blocks.select("term", F.explode("ids").alias("id"))).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        corpus = self.corpus().first()
        n_docs, mean = F.lit(corpus.n_docs), F.lit(corpus.mean)
        # One row for each term and one for each asked term: both bounded by the block of queries.
        bests = blocks.groupBy("term").agg(F.max("max_tf").alias("__tf"), F.min("min_length").alias("__length"))
        stats = df.join(bests, "term").withColumn("most", bm25(F.col("df"), F.col("__tf"), F.col("__length"), n_docs, mean)).select("term", "df", "most")
        of_query = Window.partitionBy("qid")
        plan = asked.join(F.broadcast(stats), "term").withColumns({
            "__found": F.count(F.lit(1)).over(of_query), "__all": F.sum("most").over(of_query),
            "__turn": F.row_number().over(of_query.orderBy("df", "term")),
        }).where("__found = n_terms")
        plan = stage(plan.select("qid", "n_terms", "term", "df", (F.col("__turn") == 1).alias("first"), (F.col("__all") - F.col("most")).alias("others")), "term-plan")

        def postings(of: DataFrame, found: DataFrame) -> DataFrame:
            """qid, id, part of the postings in ``found`` for the asked terms ``of``."""
            one = found.join(F.broadcast(of), "term").select("qid", "df", F.explode(F.arrays_zip("ids", "lengths", F.transform("positions", F.size).alias("tfs"))).alias("p"))
            return one.select("qid", F.col("p.ids").alias("id"), bm25(F.col("df"), F.col("p.tfs"), F.col("p.lengths"), n_docs, mean).alias("part"))

        def scored(firsts: DataFrame) -> DataFrame:
            """qid, id, bm25 of the rows in ``firsts`` (qid, id, part) that hold the query's other terms as well."""
            firsts = self._living(firsts)
            others = postings(plan.where("NOT first"), blocks).join(firsts.select("qid", "id"), ["qid", "id"], "left_semi")
            each = firsts.unionByName(others).groupBy("qid", "id").agg(F.round(F.sum("part"), 6).alias("bm25"), F.count(F.lit(1)).alias("__n"))
            return each.join(F.broadcast(plan.where("first").select("qid", "n_terms")), "qid").where("__n = n_terms").select("qid", "id", "bm25")

        heads = blocks.select("term", "first_id", "last_id", "n", "max_tf", "min_length").join(F.broadcast(plan.where("first")), "term")
        bound = bm25(F.col("df"), F.col("max_tf"), F.col("min_length"), n_docs, mean) + F.col("others")
        best_first = of_query.orderBy(F.desc("bound"), "first_id", "last_id").rowsBetween(Window.unboundedPreceding, -1)
        heads = heads.withColumn("bound", bound).withColumn("__before", F.coalesce(F.sum("n").over(best_first), F.lit(0)))
        heads = stage(heads.select("qid", "term", "first_id", "last_id", "df", "bound", (F.col("__before") < HEAD * n).alias("early")), "bounds")

        def of_blocks(chosen: DataFrame) -> DataFrame:
            named = blocks.join(chosen.select("qid", "term", "first_id", "last_id", "df"), ["term", "first_id", "last_id"])
            one = named.select("qid", "df", F.explode(F.arrays_zip("ids", "lengths", F.transform("positions", F.size).alias("tfs"))).alias("p"))
            return one.select("qid", F.col("p.ids").alias("id"), bm25(F.col("df"), F.col("p.tfs"), F.col("p.lengths"), n_docs, mean).alias("part"))

        found = scored(of_blocks(heads.where("early")))
        if not heads.where("NOT early").isEmpty():
            found = stage(found, "first-scores")
            least = top(found, n, F.desc("bm25")).where(F.col("rank") == n).select("qid", (F.col("bm25") - 1e-6).alias("__least"))
            later = heads.where("NOT early").join(least, "qid", "left").where("__least IS NULL OR bound >= __least")
            found = found.unionByName(scored(of_blocks(later)))
        return top(found, n, F.desc("bm25"))

    def phrases(self, phrases: list[list[str]]) -> DataFrame:
        """id, phrase: the rows that hold each phrase (by its number), by joining positions: a phrase starts where each of its
        words stands as far on as its place in it."""
        words = [(word, at, i, len(p)) for i, p in enumerate(phrases) for at, word in enumerate(p)]
        asked = self.spark.createDataFrame(words, "term string, at int, phrase int, size int")
        met = self.blocks(sorted({w[0] for w in words})).join(F.broadcast(asked), "term")
        rows = met.select("phrase", "size", "at", F.explode(F.arrays_zip("ids", "positions")).alias("p"))
        single = rows.where("size = 1").select(F.col("p.ids").alias("id"), "phrase")
        starts = rows.where("size > 1").select("phrase", "size", "at", F.col("p.ids").alias("id"), F.explode("p.positions").alias("place"))
        whole = starts.groupBy("id", "phrase", "size", (F.col("place") - F.col("at")).alias("start")).agg(F.count_distinct("at").alias("n"))
        return self._living(single.unionByName(whole.where("n = size").select("id", "phrase"))).distinct()

    def match(self, query: LexicalQuery) -> DataFrame:
        """id of the rows that meet a web-search query, from the postings of its terms."""
        listed = [*query.required, *(p for group in query.alternatives for p in group), *query.excluded]
        if not query.required and not query.alternatives:
            return self.spark.createDataFrame([], "id long")
        sets = self.phrases(listed).groupBy("id").agg(F.collect_set("phrase").alias("has"))  # no larger than the query
        number, fits = 0, F.lit(True)
        for _ in query.required:
            fits, number = fits & F.array_contains("has", number), number + 1
        for group in query.alternatives:
            fits, number = fits & F.arrays_overlap("has", F.array(*[F.lit(number + i) for i in range(len(group))])), number + len(group)
        for _ in query.excluded:
            fits, number = fits & ~F.array_contains("has", number), number + 1
        return sets.where(fits).select("id")


def refreshed(index: Postings, rows: DataFrame, new_folder: str, dead_folder: str) -> Postings:
    """The index of just ``rows`` (id, content): those it doesn't know are a new segment, those that went are dead.

    A row's id stands for its content, so a row that comes back is alive again as it was. With MOST_SEGMENTS segments, or
    MOST_DEAD of the rows dead, all is written as one segment.
    """
    ids = rows.select(F.col("id").cast("long").alias("id"))
    known = index.known().select("id")
    gone = known.join(ids, "id", "left_anti")
    if index.segments:
        total, dead = known.count(), gone.count()
        if len(index.segments) < MOST_SEGMENTS and dead <= MOST_DEAD * total:
            new, segments = rows.join(known, "id", "left_anti"), list(index.segments)
            if not new.isEmpty():
                write_segment(new, new_folder)
                segments.append(new_folder)
            if dead:
                gone.write.parquet(dead_folder)
            return Postings(index.spark, segments, dead_folder if dead else None)
    write_segment(rows, new_folder)
    return Postings(index.spark, [new_folder])
