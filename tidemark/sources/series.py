"""Append-only series of report rows, and the raw evidence of a run."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import redact_signed_urls

_DAMAGED = "__damaged"


def read_series(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a series, in no order; each lies in a file of its own append."""
    return spark.read.schema(schema).json(path)


def append_series(entry: DataFrame, path: str) -> DataFrame:
    """Append ``entry``, the rows of a report, to the series at ``path``, and return the series.

    Fractions are rounded to six places. A series with a line that isn't a row of this kind is put aside whole, under a name of
    its own, and begun anew with ``entry``. An append that fails adds nothing. One writer at a time.
    """
    spark = entry.sparkSession
    fractions = [f.name for f in entry.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(place):
        checked = T.StructType([*entry.schema.fields, T.StructField(_DAMAGED, T.StringType())])
        lines = spark.read.schema(checked).option("columnNameOfCorruptRecord", _DAMAGED).json(path)
        if lines.where(F.col(_DAMAGED).isNotNull()).limit(1).collect():
            system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}-damaged-{uuid.uuid4().hex}"))
    rounded = entry.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in fractions}) if fractions else entry
    rounded.write.mode("append").option("ignoreNullFields", "false").json(path)
    return read_series(spark, path, entry.schema)


def write_evidence(rows: DataFrame, path: str) -> None:
    """Append raw rows as JSON lines; addresses with credentials in their query lose it, in every string column."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    rows.withColumns({c: redact_signed_urls(F.col(f"`{c}`"))["text"] for c in texts}).write.mode("append").json(path)
