"""Streaming variants: windowed latency of a search log, and ingest of what has arrived."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.telemetry import parse_events


def read_log(spark: SparkSession, folder: str, files_a_trigger: int = 100) -> DataFrame:
    """The search events of a growing folder of JSON lines, with a timestamp ``at``."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_a_trigger).text(folder)
    return parse_events(lines).where("type = 'search'").withColumn("at", F.timestamp_seconds("ts"))


def windowed_latency(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Calls, mean, maximum and breaches by window and profile; events later than ``late`` are left out."""
    seen = events.withWatermark("at", late).groupBy(F.window("at", width), "profile")
    return seen.agg(
        F.count(F.lit(1)).alias("calls"), F.avg("latency_ms").alias("mean_ms"), F.max("latency_ms").alias("max_ms"),
        F.approx_percentile("latency_ms", 0.95).alias("p95_ms"), F.count_if("slo_breach").alias("breaches"),
    ).select("window.start", "window.end", "profile", "calls", "mean_ms", "max_ms", "p95_ms", "breaches")


def deduplicated(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("at", late).dropDuplicatesWithinWatermark(keys)


def ingest_available(files: DataFrame, checkpoint: str, sync: Callable[[DataFrame, int], None]):
    """Hand each batch of a file stream that has arrived to ``sync``, then stop."""
    query = files.writeStream.foreachBatch(sync).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
