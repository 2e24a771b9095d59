"""Queries of the training-data operators over the shared tables, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import additive_search, bpe, hard_negatives, language_id, mixing, near_duplicates, prefix_trie, quality_rules, sharding, substring_dedup, telephony, token_counts, token_files
from .rows import table


def op1_telephony_audio(spark, sf_dir):
    return telephony.audio_digests(table(spark, sf_dir, "documents"))


def op2_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_additive_search(spark, sf_dir):
    return additive_search.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op4_jaccard_components(spark, sf_dir):
    return near_duplicates.near_duplicate_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op5_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op6_substring_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return substring_dedup.deduplicate(documents).select("doc_id", "text", "removed_chunks", "removed_bytes")


def op7_source_mix(spark, sf_dir):
    mixed = mixing.calibrate(table(spark, sf_dir, "documents"))
    return mixed.withColumns({c: F.round(c, 9) for c in ("factor", "prob", "residual")})


def op8_token_files(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    manifest, folder = token_files.write_token_files(documents, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_digests(manifest, folder)


def op9_language_id(spark, sf_dir):
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op10_byte_shards(spark, sf_dir):
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)


def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_quality_rules(spark, sf_dir):
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality_rules.BASE_MEASURES, "base_failed", "kept")


QUERIES = {
    "op1_telephony_audio": op1_telephony_audio,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_additive_search": op3_additive_search,
    "op4_jaccard_components": op4_jaccard_components,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_source_mix": op7_source_mix,
    "op8_token_files": op8_token_files,
    "op9_language_id": op9_language_id,
    "op10_byte_shards": op10_byte_shards,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_rules": op13_quality_rules,
}

ORACLE_SQL: dict[str, str] = {
    "op3_additive_search": additive_search.exact_sql(),
    "op4_jaccard_components": near_duplicates.components_sql(3, 90),
    "op7_source_mix": mixing.calibrate_sql(),
    "op10_byte_shards": sharding.shards_sql(40),
    "op11_hard_negatives": hard_negatives.exact_sql(),
    "op12_prefix_trie": prefix_trie.trie_sql(),
    "op13_quality_rules": quality_rules.rules_sql(),
}
