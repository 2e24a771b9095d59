"""Queries of the retrieval evaluation, over questions made from the embeddings' labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as op
from ..operators import search
from ..staging import stage
from .fixtures import CHUNKS_SQL, COSINE_SQL, chunks, table

GATE = 0.15


def questions(spark, d):
    """Every 25th chunk asks, with a vector between its own and its label's first, for these two; every other time only for its kind."""
    c = chunks(spark, d)
    lead = c.groupBy("label").agg(F.min_by("embedding", "id").alias("lead"), F.min_by("path", "id").alias("lead_path"))
    between = F.zip_with("embedding", "lead", lambda a, b: a.cast("double") + 1.5 * b.cast("double"))
    none = F.array().cast("array<string>")
    return c.where("id % 25 = 0").join(lead, "label").select(
        F.col("id").cast("string").alias("id"), F.col("id").alias("qid"), between.alias("qvec"),
        F.when(F.col("id") % 75 == 0, none).otherwise(F.array("path", "lead_path")).alias("expect_paths"),
        none.alias("expect_symbols"), F.when(F.col("id") % 50 == 0, F.array("kind")).otherwise(none).alias("expect_kinds"),
        F.when(F.col("id") % 100 == 0, "external").otherwise("curated").alias("source"), (F.col("id") % 75 == 0).alias("should_refuse"),
        F.lit(2).alias("targets"),
    )


def retrieved(spark, d, asked):
    c = chunks(spark, d)
    dense = search.dense_lists(c, asked, 10).join(c.select("id", "path", "symbol", "kind"), "id").drop("id")
    return search.distance_gate(dense, GATE).select(F.col("qid").cast("string").alias("id"), F.col("rank").alias("pos"), "path", "symbol", "kind")


def per_question(spark, d):
    asked = stage(questions(spark, d), "questions")  # asked, and compared with what is found, twice
    per = op.per_question(asked.drop("qid", "qvec"), retrieved(spark, d, asked))
    return per.withColumns({c: F.col(c).cast("long") for c in ("rank", "targets", "covered")})


def recall_overall(spark, d):
    return op.quality(per_question(spark, d)).where("dimension = 'overall'").drop("dimension", "value")


def recall_breakdown(spark, d):
    return op.quality(per_question(spark, d))


def recall_gate(spark, d):
    return op.check_gate(recall_overall(spark, d))


def recall_misses(spark, d):
    return op.misses(per_question(spark, d))


def question_lines(spark, d):
    c = table(spark, d, "documents")
    line = F.when(F.col("doc_id") % 5 == 0, F.lit("# comment")).when(F.col("doc_id") % 5 == 1, F.lit("  ")).when(
        F.col("doc_id") % 5 == 2, F.concat(F.lit('{"id": "q'), F.col("doc_id").cast("string"), F.lit('", "expect_paths": ["a", "b"]}'))
    ).otherwise(F.concat(F.lit('{"id": "q'), F.col("doc_id").cast("string"), F.lit('", "question": "why", "expect_kinds": ["doc"], "source": "external", "should_refuse": true, "expect_targets": 4}')))
    return op.load_questions(c.select(line.alias("value"))).select("id", "question", F.size("expect_paths").alias("paths"), F.array_join("expect_kinds", ",").alias("kinds"), "source", "should_refuse", "targets")


QUERIES = {
    "per_question": per_question, "recall_overall": recall_overall, "recall_breakdown": recall_breakdown, "recall_gate": recall_gate,
    "recall_misses": recall_misses, "load_questions": question_lines,
}

_PER = f"""{CHUNKS_SQL},
lead AS (SELECT label, arg_min(embedding, id) AS lead, arg_min(path, id) AS lead_path FROM chunks GROUP BY label),
q AS (SELECT id::VARCHAR AS id, id AS qid, list_transform(range(1, len(embedding) + 1), lambda i: embedding[i] + 1.5 * lead[i]) AS qvec, CASE WHEN id % 75 = 0 THEN [] ELSE [path, lead_path] END AS paths,
  CASE WHEN id % 50 = 0 THEN [kind] ELSE [] END AS kinds, CASE WHEN id % 100 = 0 THEN 'external' ELSE 'curated' END AS source, id % 75 = 0 AS negative FROM chunks JOIN lead USING (label) WHERE id % 25 = 0),
dense AS (SELECT * FROM (SELECT qid, c.path, c.kind, {COSINE_SQL.format('c.embedding', 'qvec')} AS dist, row_number() OVER (PARTITION BY qid ORDER BY {COSINE_SQL.format('c.embedding', 'qvec')}, c.id) AS pos
  FROM chunks c, q) WHERE pos <= 10),
gated AS (SELECT * FROM dense QUALIFY min(dist) OVER (PARTITION BY qid) <= {GATE}),
m AS (SELECT gated.*, list_contains(paths, path) AND (len(kinds) = 0 OR list_contains(kinds, kind)) AS hit FROM gated JOIN q USING (qid)),
sums AS (SELECT qid, min(CASE WHEN hit THEN pos END) AS rank, count(DISTINCT CASE WHEN hit THEN path END) AS covered FROM m GROUP BY qid),
per AS (SELECT q.id, source, CASE WHEN len(kinds) = 1 THEN kinds[1] ELSE 'mixed' END AS kind_group, negative, sums.qid IS NULL AS refused, rank, 2::BIGINT AS targets, coalesce(covered, 0) AS covered
  FROM q LEFT JOIN sums USING (qid))"""
_RECALL = ", ".join(f"round(avg(CASE WHEN negative THEN refused ELSE coalesce(rank <= {k}, false) END::INT), 4) AS recall_{k}" for k in op.KS)
_QUALITY = f"""count(*) AS n, {_RECALL}, round(coalesce(avg(CASE WHEN NOT negative THEN coalesce(1.0::DOUBLE / rank, 0) END), 0), 4) AS mrr,
  round(avg(CASE WHEN NOT negative THEN least(1.0, covered::DOUBLE / targets) END), 4) AS coverage, round(avg(CASE WHEN negative THEN refused::INT END), 4) AS refusal,
  round(avg(CASE WHEN NOT negative THEN coalesce(rank <= 8, false)::INT END), 4) AS positive_recall"""

ORACLE_SQL = {
    "per_question": f"WITH {_PER} SELECT * FROM per",
    "recall_overall": f"WITH {_PER} SELECT {_QUALITY} FROM per",
    "recall_breakdown": f"""WITH {_PER} SELECT 'overall' AS dimension, '' AS value, {_QUALITY} FROM per UNION ALL SELECT 'kind', kind_group, {_QUALITY} FROM per GROUP BY kind_group
        UNION ALL SELECT 'source', source, {_QUALITY} FROM per GROUP BY source""",
    "recall_gate": f"WITH {_PER} SELECT recall_8 AS metric, 0.9::DOUBLE AS threshold, coalesce(recall_8 >= 0.9, false) AS passed FROM (SELECT {_QUALITY} FROM per)",
    "recall_misses": f"WITH {_PER} SELECT id, negative FROM per WHERE CASE WHEN negative THEN NOT refused ELSE rank IS NULL END",
    "load_questions": """SELECT 'q' || doc_id AS id, CASE WHEN doc_id % 5 = 2 THEN '' ELSE 'why' END AS question, CASE WHEN doc_id % 5 = 2 THEN 2 ELSE 0 END AS paths,
        CASE WHEN doc_id % 5 = 2 THEN '' ELSE 'doc' END AS kinds, CASE WHEN doc_id % 5 = 2 THEN 'curated' ELSE 'external' END AS source, doc_id % 5 <> 2 AS should_refuse,
        CASE WHEN doc_id % 5 = 2 THEN 2 ELSE 4 END AS targets FROM documents WHERE doc_id % 5 >= 2""",
}
