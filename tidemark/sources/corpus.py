"""Reading a tree of files into the corpus: one listing, then filters on path, size and content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import MAX_FILE_BYTES, classify_path, git_blob_sha, looks_binary, read_text


def load_corpus(spark: SparkSession, root: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """path, kind, lang, blob_sha, size, content of the indexed text files below ``root``, in order of path.

    The folder .git, unknown extensions, lock files, files over ``max_bytes`` and binary ones are left out. Paths are what stands
    behind the root as the file system writes it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    stem = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getPath().toString().rstrip("/") + "/"
    relative = F.substring(F.col("path"), len(stem) + 1, 1 << 20)
    listed = files.where(F.col("length") <= max_bytes).select(relative.alias("path"), "length", "content")
    known = listed.withColumn("c", classify_path("path")).where(F.col("c").isNotNull() & ~F.col("path").rlike("(^|/)\\.git/"))
    return (
        known.where(~looks_binary("content"))
        .select("path", "c.kind", "c.lang", git_blob_sha("content").alias("blob_sha"), F.col("length").alias("size"), read_text("content").alias("content"))
        .orderBy("path")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value: the lines of text files (JSON lines, logs), which the parsers of the operators take."""
    return spark.read.text(path)


def read_matrix(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV matrix with a header, as strings; columns that the file lacks are null."""
    found = spark.read.option("header", "true").csv(path)
    return found.select(*[F.col(c) if c in found.columns else F.lit(None).cast("string").alias(c) for c in columns])


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_matrix(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def markdown_table(df: DataFrame, limit: int = 1000) -> str:
    """A report table of a small aggregate; one of more than ``limit`` rows isn't a report, and is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report of more than {limit} rows; aggregate it, or give a higher limit")
    cell = lambda v: "" if v is None else f"{v:.1f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(cell, r)) + " |" for r in rows)]) + "\n"
