"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Input that a range partition gets, at most in the mean.
PARTITION_BYTES = 64_000_000


def range_partitions(docs: DataFrame, bytes_each: int = PARTITION_BYTES) -> int:
    """So many partitions that each gets ``bytes_each`` of the input, and the session's shuffle partitions at least.

    The size is the files' as Spark's plan states it; a frame that states none is counted by its texts.
    """
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // bytes_each))


def map_texts(docs: DataFrame, fn: Callable[[pa.Array, list], list], schema: str, rows: int = 512) -> DataFrame:
    """Apply ``fn(ids, texts)`` to slices of (doc_id, text) and return its columns.

    ``ids`` is an Arrow array, ``texts`` a list of str (a null text is None).
    Slices hold at most ``rows`` documents, which bounds what a task holds.
    """
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(schema)
    names = wanted.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(wanted)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                columns = fn(part.column(0), part.column(1).to_pylist())
                arrays = [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                    for c, f in zip(columns, arrow, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
