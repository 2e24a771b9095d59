"""A cleaning pipeline over ``documents``: each stage reads what the stage before it wrote.

Language ID drops what has no language, the n-gram Jaccard join leaves one document of each group, substring dedup cuts
repeated passages, mixing samples towards target weights, and BPE encodes what is left. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, language_id, mixing, near_duplicates, substring_dedup
from tidemark.staging import mark, release, stage

#: Documents whose best cosine is lower have no language: LEAST_SCORE up to FEW trigrams, growing to LONG_SCORE at MANY.
#: Gibberish has cosines up to about 0.15 at any length, clean texts of 200 characters 0.20 and more, short ones 0.03 and more.
LEAST_SCORE, LONG_SCORE, FEW, MANY = 0.02, 0.15, 40, 100


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a language: rejected are nulls, texts without letters, and scores below what their length asks for.

    The prediction is of the text alone, so it is made and joined by a 64-bit hash of the text: of several texts under one id
    each stays or goes by itself, repeated rows stay or go together, and a null id makes no difference. The rejected hashes
    are written first, so that Spark knows their size and needn't shuffle the texts when they are few.
    """
    of_text = F.xxhash64(F.coalesce("text", F.lit("")))
    predicted = language_id.identify(docs.select(of_text.alias("doc_id"), "text"), language_id.learn_prototypes(docs))
    long = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("trigrams") - FEW) / (MANY - FEW)))
    least = LEAST_SCORE + (LONG_SCORE - LEAST_SCORE) * long
    rejected = predicted.where((F.col("lang_pred") == language_id.UNDETERMINED) | (F.col("score") < least))
    rejected = stage(rejected.select(F.col("doc_id").alias("__rejected")).distinct(), "rejected")
    return docs.join(rejected, of_text == F.col("__rejected"), "left_anti")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 on five-word shingles: the one with the smallest id."""
    return near_duplicates.keep_one(docs, n=5, percent=80)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred before are cut; documents of which nothing is left go, others get a new n_chars."""
    left = substring_dedup.deduplicate(docs)
    left = left.where(~((F.col("removed_bytes") > 0) & (F.trim("text") == "")))
    cut = F.when(F.col("removed_bytes") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", cut).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents with token weights raked to the source, language and topic targets, mixing.KEEP of the tokens at least."""
    return mixing.mix(docs, keep=mixing.KEEP)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, text, n_tokens, ids (byte-level BPE) and whether decoding gives the text back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode_rows(docs.select("doc_id", "source", "lang", "text"), path)


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("source_mixing", mixing_stage),
    ("bpe_encoding", encoding_stage),
]

#: No SQL says gear hashes, trained prototypes or BPE; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written to the shared folder and read again.

    What a stage wrote besides its result, and the result before it, are deleted once its own result is written.
    """
    docs, began = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark()
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
        release(spark, began, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
