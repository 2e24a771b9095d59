"""Hybrid search: dense and lexical top-k lists, weighted reciprocal-rank fusion, distance gate, deterministic order.

All operators take many queries at once: a query frame has ``qid``, ``qvec`` and ``terms`` or ``q``. ``dense_topk`` and
``lexical_topk`` also give the chunks, for ``QUERY_BLOCK`` queries at most; ``dense_lists``, ``lexical_lists`` and ``search``
take any number (:mod:`.toplists`).
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..staging import stage
from . import toplists

DEPTH, FINAL_K, RRF_K = 50, 8, 60
STEMMED_WEIGHT = 0.0
QUERY_BLOCK = 1000
K1, B = 1.2, 0.75
#: Characters by which hits are told apart.
HEAD = 200
COLUMNS = ["id", "repo", "path", "lang", "kind", "symbol", "content"]


def scope(chunks: DataFrame, repo=None, gen=None, kind=None, prefix=None) -> DataFrame:
    """The chunks of a repository, generation, kind and path prefix; None leaves a condition out."""
    for name, value in (("repo", repo), ("gen", gen), ("kind", kind)):
        if value is not None:
            chunks = chunks.where(F.col(name) == value)
    return chunks if prefix is None else chunks.where(F.col("path").startswith(prefix))


def dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine, in double precision: 0 for equal directions, 2 for opposite ones."""
    return 1.0 - F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def _bounded(queries: DataFrame) -> DataFrame:
    """A query frame of one block."""
    n = queries.limit(QUERY_BLOCK + 1).count()
    if n > QUERY_BLOCK:
        raise ValueError(f"more than {QUERY_BLOCK} queries in one call; pass them in blocks (query_blocks)")
    return queries


def query_blocks(queries: DataFrame, block: int = QUERY_BLOCK) -> list[DataFrame]:
    """The queries in blocks that the functions for one block accept, dealt by a hash of their ids."""
    n = max(1, -(-queries.count() * 2 // block))
    return [queries.where(F.pmod(F.xxhash64("qid"), F.lit(n)) == i) for i in range(n)]


def top(lists: DataFrame, n: int, *order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(*order, "id"))
    return lists.withColumn("rank", rank).where(F.col("rank") <= n)


def dense_lists(chunks: DataFrame, queries: DataFrame, n: int = DEPTH) -> DataFrame:
    """qid, id, rank, dist: of any number of queries the n nearest chunks by cosine distance, ties by id."""
    return toplists.dense(chunks, queries, n)


def dense_topk(chunks: DataFrame, queries: DataFrame, n: int = DEPTH) -> DataFrame:
    """qid, rank, dist and the chunk: the n nearest chunks by cosine distance, ties by id."""
    return dense_lists(chunks, _bounded(queries), n).join(chunks.drop("embedding"), "id")


def dense_topk_one(chunks: DataFrame, vector: list[float], n: int = DEPTH) -> DataFrame:
    """The n nearest chunks to one vector: a partial top-k in each task, no shuffle of the chunks."""
    literal = F.array(*[F.lit(float(x)) for x in vector])
    found = chunks.withColumn("dist", F.round(cosine_distance(F.col("embedding"), literal), 6))
    return found.where("dist IS NOT NULL").orderBy("dist", "id").limit(n)


@dataclass
class LexicalQuery:
    """A web-search query: terms and phrases that are required, groups of alternatives, and what is excluded."""

    required: list[list[str]] = field(default_factory=list)
    alternatives: list[list[list[str]]] = field(default_factory=list)
    excluded: list[list[str]] = field(default_factory=list)

    def positive_terms(self) -> list[str]:
        phrases = [*self.required, *(p for group in self.alternatives for p in group)]
        return sorted({t for p in phrases for t in p})


def parse_websearch(text: str) -> LexicalQuery:
    """Words are required, "quoted words" form a phrase, a - excludes, OR joins its neighbours."""
    query, pending_or, last = LexicalQuery(), False, None
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|(\S+))', text):
        if not minus and word.lower() == "or":
            pending_or = last is not None
            continue
        words = [w for w in re.split(r"[^\w]+", (phrase or word.removeprefix("-")).lower()) if w]
        if not words:
            continue
        if minus or word.startswith("-"):
            query.excluded.append(words)
        elif pending_or:
            if last in query.required:
                query.required.remove(last)
                query.alternatives.append([last])
            query.alternatives[-1].append(words)
            last = words
        else:
            query.required.append(words)
            last = words
        pending_or = False
    return query


def lexical_match(terms: Column, query: LexicalQuery) -> Column:
    """Whether an array of terms meets a query."""

    def has(phrase: list[str]) -> Column:
        if len(phrase) == 1:
            return F.array_contains(terms, phrase[0])
        return F.contains(F.concat(F.lit(" "), F.array_join(terms, " "), F.lit(" ")), F.lit(f" {' '.join(phrase)} "))

    found = F.lit(bool(query.required or query.alternatives))
    for phrase in query.required:
        found = found & has(phrase)
    for group in query.alternatives:
        any_of = F.lit(False)
        for phrase in group:
            any_of = any_of | has(phrase)
        found = found & any_of
    for phrase in query.excluded:
        found = found & ~has(phrase)
    return found


def postings(chunks: DataFrame) -> DataFrame:
    """term, id, tf, dl: the inverted index, one row for each distinct term of a chunk."""
    listed = chunks.select("id", tokens("content").alias("t"))
    return (
        listed.select("id", F.size("t").alias("dl"), F.explode("t").alias("term"))
        .groupBy("term", "id").agg(F.count(F.lit(1)).alias("tf"), F.max("dl").alias("dl"))
    )


def lexical_lists(chunks: DataFrame, queries: DataFrame, n: int = DEPTH) -> DataFrame:
    """qid, id, rank, bm25: of the chunks that hold all of a query's terms, the n with the highest BM25, for any number of queries."""
    listed = toplists.spread(chunks.select("id", "content")).select("id", tokens("content").alias("terms"))
    return toplists.lexical(lambda terms: toplists.count_terms(listed, terms), None, queries, n, K1, B)


def lexical_topk(chunks: DataFrame, queries: DataFrame, n: int = DEPTH) -> DataFrame:
    """qid, rank, bm25 and the chunk: of the chunks that hold all of a query's terms, the n with the highest BM25."""
    return lexical_lists(chunks, _bounded(queries), n).join(chunks.select(*COLUMNS), "id")


def reciprocal_rank_fusion(lists: list[DataFrame], weights: list[float] | None = None, k: int = RRF_K) -> DataFrame:
    """qid, id, score, vec_rank, lex_rank, dist: the sum of weight / (k + rank) over ranked lists (qid, id, rank [, dist]).

    The first list is the dense one, the second the lexical one. One shuffle for any number of lists.
    """
    weights = weights or [1.0] * len(lists)
    parts = []
    for i, (ranked, weight) in enumerate(zip(lists, weights, strict=True)):
        dist = F.col("dist") if "dist" in ranked.columns else F.lit(None).cast("double")
        parts.append(ranked.select("qid", "id", "rank", dist.alias("dist"), F.lit(i).alias("list"), F.lit(float(weight)).alias("weight")))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("qid", "id").agg(
        F.round(F.sum(F.col("weight") / (k + F.col("rank"))), 6).alias("score"),
        F.max(F.when(F.col("list") == 0, F.col("rank"))).alias("vec_rank"),
        F.max(F.when(F.col("list") == 1, F.col("rank"))).alias("lex_rank"),
        F.max(F.when(F.col("list") == 0, F.col("dist"))).alias("dist"),
    )


def distance_gate(fused: DataFrame, gate: float | None) -> DataFrame:
    """All of a query's results, or none: those queries whose nearest dense candidate is within ``gate``. None is off."""
    if gate is None:
        return fused
    nearest = F.min("dist").over(Window.partitionBy("qid"))
    return fused.withColumn("__nearest", nearest).where(F.col("__nearest") <= gate).drop("__nearest")


def final_order(fused: DataFrame, k: int = FINAL_K) -> DataFrame:
    """The k best by (score descending, path, symbol, id), numbered by ``pos``."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "path", F.coalesce("symbol", F.lit("")), "id")
    return fused.withColumn("pos", F.row_number().over(order)).where(F.col("pos") <= k)


def search(chunks: DataFrame, queries: DataFrame, k: int = FINAL_K, depth: int = DEPTH, rrf_k: int = RRF_K, gate: float | None = None,
           weights: tuple[float, float] = (1.0, 1.0), stemmed: DataFrame | None = None, stemmed_weight: float = STEMMED_WEIGHT,
           dense: Callable[[DataFrame, int], DataFrame] | None = None, lexical: Callable[[DataFrame, int], DataFrame] | None = None,
           joined: DataFrame | None = None) -> DataFrame:
    """Hybrid search of many queries (qid, qvec, terms). The stemmed list is joined in only where its weight isn't 0.

    ``dense`` and ``lexical`` give the lists of (queries, depth) from an index (cells, postings) of the same chunks.
    ``joined`` are the same chunks as hits should have them, such as with the heads of their contents alone.
    """
    queries = stage(queries, "queries")  # read once for both lists
    dense = dense or (lambda all, n: dense_lists(chunks, all, n))
    lexical = lexical or (lambda all, n: lexical_lists(chunks, all, n))
    lists = [dense(queries, depth).select("qid", "id", "rank", "dist"), lexical(queries, depth).select("qid", "id", "rank")]
    used = list(weights)
    if stemmed is not None and stemmed_weight:
        lists.append(stemmed)
        used.append(stemmed_weight)
    fused = distance_gate(reciprocal_rank_fusion(lists, used, rrf_k), gate)
    return final_order(fused.join((chunks if joined is None else joined).select(*COLUMNS), "id"), k)


def provenance() -> Column:
    dense, lexical = F.col("vec_rank").isNotNull(), F.col("lex_rank").isNotNull()
    return (
        F.when(dense & lexical, "hybrid").when(dense, "dense_only").when(lexical, "lexical_only").otherwise("unknown")
    )


def source_label() -> Column:
    """path[::symbol] [kind]"""
    symbol = F.when(F.coalesce("symbol", F.lit("")) != "", F.concat(F.lit("::"), F.col("symbol"))).otherwise("")
    return F.concat("path", symbol, F.lit(" ["), F.col("kind"), F.lit("]"))


def dedupe_hits(hits: DataFrame, order: str = "pos") -> DataFrame:
    """Of hits that agree in path, symbol, kind and the first 200 characters (HEAD), the first."""
    key = ["qid", "path", F.coalesce("symbol", F.lit("")), "kind", F.substring("content", 1, HEAD)]
    return hits.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("__n = 1").drop("__n")


def context_blocks(hits: DataFrame, separator: str = "\n\n---\n\n") -> DataFrame:
    """qid, context: the hits' contents, numbered and labelled, in order."""
    block = F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("] "), source_label(), F.lit("\n"), F.col("content"))
    blocks = hits.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("pos", block.alias("block")))).alias("b"))
    return blocks.select("qid", F.array_join(F.transform("b", lambda x: x["block"]), separator).alias("context"))


def clamp_k(k: int | None, omitted: int = 6) -> tuple[int, int]:
    """(how many to return, how deep to search): an omitted k is 6, others are held within 1 to 50; 8 deep at least."""
    k = omitted if k is None else max(1, min(k, 50))
    return k, max(k, FINAL_K)


def shown_hits(chunks: DataFrame, queries: DataFrame, k: int | None = None, **options) -> DataFrame:
    """What a caller is shown: of a search that goes deeper than ``k`` (:func:`clamp_k`), without hits that repeat an earlier one, the
    first ``k``, numbered by ``shown``. A smaller k shows the start of what a larger one shows, as long as both search 8 deep."""
    wanted, depth = clamp_k(k)
    once = dedupe_hits(search(chunks, queries, depth, **options))
    return once.withColumn("shown", F.row_number().over(Window.partitionBy("qid").orderBy("pos"))).where(F.col("shown") <= wanted)
