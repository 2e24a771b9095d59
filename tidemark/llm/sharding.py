"""Contiguous shards of nearly equal bytes: global prefix sums from per-partition totals, cut at equal targets.

DataFrame operations only. Rows are range-partitioned by id once; every
partition reports its total, the totals' prefix sums are the partitions'
bases, and a row's global offset is its base plus its running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .rows import range_partitions

OVERHEAD = 16


def document_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for a null) and a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(OVERHEAD)).cast("long")


def byte_offsets(sized: DataFrame, keys: list[str], size: str = "size", parts: int | None = None) -> DataFrame:
    """``sized`` with ``row`` and ``offset`` (rows and bytes before it, in order of ``keys``) and ``total`` (bytes of all).

    ``parts`` range partitions, or as many as the session's shuffle partitions.
    Rows that tie in ``keys`` stand in the order in which they were read; nulls come first.
    The frame is written to the shared folder once, so the partitions stay as they were totalled.
    """
    tie, part = "__read_order", "__range"
    ranged = sized.withColumn(tie, F.monotonically_increasing_id())
    n = parts or int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(ranged.repartitionByRange(n, *keys, tie).withColumn(part, F.spark_partition_id()), "ranged")
    totals = ranged.groupBy(part).agg(F.sum(size).alias("__sum"), F.count(F.lit(1)).alias("__count"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition.
    bases = totals.select(
        part,
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"),
        F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__row_base"),
        F.sum("__sum").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    ordered = Window.partitionBy(part).orderBy(*keys, tie)
    within = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("__within", F.coalesce(F.sum(size).over(within), F.lit(0)))
        .withColumn("__row", F.row_number().over(ordered) - 1)
        .join(F.broadcast(bases), part)
        .withColumn("offset", F.col("__base") + F.col("__within"))
        .withColumn("row", (F.col("__row_base") + F.col("__row")).cast("long"))
        .drop(tie, part, "__base", "__row_base", "__within", "__row")
    )


def shard_by_bytes(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: documents in order of doc_id, cut at equal byte targets.

    A document belongs to the shard in whose byte range its middle lies, so no shard misses its target by more
    than one document's size. ``slot`` counts from 0 within the shard. ``law`` is ``bytes`` and ``grown_shard`` null.
    A null text has size 16 and the crc of no bytes, 0; a null doc_id comes first; repeated rows are kept, each with a slot of
    its own; an empty table gives no rows; other columns are not read.
    """
    sized = docs.select(
        "doc_id",
        document_size(F.col("text")).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    placed = byte_offsets(sized, ["doc_id", "text_crc32", "size"], parts=range_partitions(docs))
    placed = placed.withColumn(
        "shard", F.least(F.lit(shards - 1), F.expr(f"(2 * offset + size) * {shards} DIV (2 * total)")).cast("int")
    )
    # One row per shard.
    firsts = placed.groupBy("shard").agg(F.min("row").alias("__first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("__first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shards_sql(shards: int = 40, docs: str = "documents") -> str:
    """DuckDB SQL for the rows of :func:`shard_by_bytes`; the crc is folded byte by byte, so it is for small tables."""
    step = "lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"""WITH t AS MATERIALIZED (SELECT list(list_reduce(range(8), {step}, i) ORDER BY i) AS tab FROM range(256) r(i)),
h AS (SELECT doc_id, coalesce(strlen(text), 0) + {OVERHEAD} AS size, hex(encode(coalesce(text, ''))) AS h FROM {docs}),
b AS (SELECT doc_id, size, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM h),
c AS (SELECT doc_id, size, xor(list_reduce(b, lambda a, x: xor(a >> 8, tab[xor(a & 255, x) + 1]), 4294967295::BIGINT), 4294967295) AS crc FROM b, t),
o AS (SELECT *, row_number() OVER w - 1 AS row, sum(size) OVER w - size AS before, sum(size) OVER () AS total FROM c
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, crc, size ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, least({shards - 1}, (2 * before + size) * {shards} // (2 * total))::INTEGER AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'bytes' AS law, shard, row - min(row) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard FROM s"""
