"""Sections of ordered rows: what a heading says to the rows below it, fences, slices between marks, sizes by group.

Windows are partitioned by the rows' key (a document, a conversation), so a task holds whole keys and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens


def _upto(key: str, order: str):
    return Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def carry_forward(rows: DataFrame, key: str, order: str, mark: Column, value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the value at the last row so far that has the mark; null before the first one."""
    return rows.withColumn(name, F.last(F.when(mark, value), ignorenulls=True).over(_upto(key, order)))


def inside_fence(rows: DataFrame, key: str, order: str, mark: Column, name: str = "fenced") -> DataFrame:
    """``rows`` with ``name``: whether an odd number of fences stands at or before the row."""
    fences = F.sum(F.when(mark, 1).otherwise(0)).over(_upto(key, order))
    return rows.withColumn(name, fences % 2 == 1)


def slices(rows: DataFrame, key: str, order: str, mark: Column) -> DataFrame:
    """key, start, end (behind the last row): from each marked row to the next one, or to the key's end."""
    last = rows.groupBy(key).agg(F.max(order).alias("__last"))
    marks = rows.where(mark).withColumn("__next", F.lead(order).over(Window.partitionBy(key).orderBy(order)))
    return marks.join(last, key).select(key, F.col(order).alias("start"), F.coalesce("__next", F.col("__last") + 1).alias("end"))


def sizes(chunks: DataFrame, *by: str) -> DataFrame:
    """n and tokens of each group of chunks."""
    return chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(tokens("content"))).alias("tokens"))
