"""Frames of the library's data model, derived from the shared tables, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(spark, sf_dir, head: int | None = None) -> DataFrame:
    """Chunks: documents with the embedding of the same number; with ``head``, only so many first characters, cut where they are read."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    texts = table(spark, sf_dir, "documents")
    texts = texts if head is None else texts.withColumn("text", F.substring("text", 1, head))
    return texts.join(vectors, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("repo"),
        F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"),
        "lang",
        kind("doc_id").alias("kind"),
        F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("s"), (F.col("doc_id") % 4).cast("string"))).alias("symbol"),
        F.col("text").alias("content"),
        "embedding",
        "label",
        (F.col("doc_id") % 2).alias("gen"),
    )


def kind(c: str):
    return F.element_at(F.array(F.lit("code"), F.lit("doc"), F.lit("config")), (F.col(c) % 3 + 1).cast("int"))


KIND_SQL = "list_extract(['code', 'doc', 'config'], (doc_id % 3 + 1)::INT)"
TOKENS_SQL = "list_filter(string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}_]+'), lambda t: t <> '')"

CHUNKS_SQL = f"""chunks AS (SELECT doc_id AS id, source AS repo, concat_ws('/', source, lang, doc_id) AS path, lang, {KIND_SQL} AS kind,
  CASE WHEN doc_id % 4 > 0 THEN 's' || (doc_id % 4) END AS symbol, text AS content, embedding::DOUBLE[] AS embedding, label, doc_id % 2 AS gen
  FROM documents JOIN embeddings ON doc_id = vec_id)"""


def search_queries(spark, sf_dir, every: int = 50) -> DataFrame:
    """Queries: vectors of every 50th chunk and two of its terms."""
    c = chunks(spark, sf_dir).where(F.col("id") % every == 0)
    terms = F.array_distinct(F.filter(tokens("content"), lambda t: F.length(t) <= 5))
    return c.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"), F.slice(terms, 1, 2).alias("terms"))


QUERIES_SQL = f"""asked AS (SELECT id AS qid, embedding AS qvec, (SELECT list(t ORDER BY i) FROM (SELECT t, min(i) AS i FROM
  (SELECT unnest(w) AS t, unnest(range(len(w))) AS i FROM (SELECT list_filter({TOKENS_SQL.format('content')}, lambda t: length(t) <= 5) AS w))
  GROUP BY t ORDER BY i LIMIT 2)) AS terms FROM chunks WHERE id % 50 = 0)"""

COSINE_SQL = "round(1 - list_cosine_similarity({0}, {1}), 6)"

DENSE_SQL = f"""dense AS (SELECT * FROM (SELECT qid, id, {COSINE_SQL.format('embedding', 'qvec')} AS dist,
  row_number() OVER (PARTITION BY qid ORDER BY {COSINE_SQL.format('embedding', 'qvec')}, id) AS rank FROM chunks, asked) WHERE rank <= 50)"""

LEXICAL_SQL = f"""postings AS (SELECT term, id, count(*) AS tf, any_value(dl) AS dl FROM
  (SELECT id, len(t) AS dl, unnest(t) AS term FROM (SELECT id, {TOKENS_SQL.format('content')} AS t FROM chunks)) GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, avg(len({TOKENS_SQL.format('content')})) AS avg_dl FROM chunks),
terms AS (SELECT qid, len(terms) AS n_terms, unnest(terms) AS term FROM asked),
found AS (SELECT *, count(*) OVER (PARTITION BY qid, term) AS df FROM postings JOIN terms USING (term)),
bm AS (SELECT qid, id, round(sum(ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg_dl))), 6) AS bm25
  FROM found, corpus GROUP BY qid, id HAVING count(*) = any_value(n_terms)),
lexical AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY bm25 DESC, id) AS rank FROM bm) WHERE rank <= 50)"""


def fused_sql(dense_weight: float = 1.0, lexical_weight: float = 1.0, k: int = 60) -> str:
    return f"""fused AS (SELECT qid, id, round(sum(w / ({k} + rank)), 6) AS score, max(CASE WHEN l = 0 THEN rank END) AS vec_rank,
  max(CASE WHEN l = 1 THEN rank END) AS lex_rank, max(dist) AS dist
  FROM (SELECT qid, id, rank, dist, 0 AS l, {dense_weight} AS w FROM dense UNION ALL SELECT qid, id, rank, NULL, 1, {lexical_weight} FROM lexical) GROUP BY qid, id)"""


def hits_sql(source: str = "fused", k: int = 8) -> str:
    return f"""hits AS (SELECT * FROM (SELECT f.*, c.* EXCLUDE (id, embedding), row_number() OVER (PARTITION BY qid ORDER BY score DESC, path, coalesce(symbol, ''), f.id) AS pos
  FROM {source} f JOIN chunks c ON f.id = c.id) WHERE pos <= {k})"""


SEARCH_SQL = ",\n".join([CHUNKS_SQL, QUERIES_SQL, DENSE_SQL, LEXICAL_SQL, fused_sql()])
