"""Index maintenance as relational operators: plan, resume, upsert, copy forward, parity, publication, collection.

Generations are partitions of a chunk table; :mod:`tidemark.sources.generations` keeps them on disk. All joins are equi joins
on paths or row keys, which shuffle both sides once and split where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROW_KEY = ["repo", "path", "content_hash", "gen"]


def sync_plan(live: DataFrame, stored: DataFrame, repeated: bool = False) -> DataFrame:
    """path, action: live (path, blob_sha) against stored (path, file_hash): new, changed, unchanged or removed. With ``repeated`` paths
    may stand there several times: those of a path are paired in the order of their hashes."""
    new, old = live.select("path", "blob_sha"), stored.select(F.col("path").alias("__path"), "file_hash")
    same = F.col("path") == F.col("__path")
    if repeated:
        new = new.withColumn("__n", F.row_number().over(Window.partitionBy("path").orderBy("blob_sha")))
        old = old.withColumn("__m", F.row_number().over(Window.partitionBy("__path").orderBy("file_hash")))
        same &= F.col("__n") == F.col("__m")
    both = new.join(old, same, "full_outer")
    action = (
        F.when(F.col("path").isNull(), "removed").when(F.col("__path").isNull(), "new")
        .when(F.col("blob_sha") == F.col("file_hash"), "unchanged").otherwise("changed")
    )
    return both.select(F.coalesce("path", "__path").alias("path"), action.alias("action"))


def plan_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("files"))


def remaining(plan: DataFrame, live: DataFrame, done: DataFrame) -> DataFrame:
    """Files that are new or changed and not in the generation yet with just this content."""
    todo = plan.where(F.col("action").isin("new", "changed")).join(live, "path")
    return todo.join(done.select("path", F.col("file_hash").alias("blob_sha")).distinct(), ["path", "blob_sha"], "left_anti")


def first_rows(rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """One row for each key: of equal contents in a file the first."""
    n = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy(order))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


def upsert(target: DataFrame, rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """The rows to append: those whose key isn't in the target; on conflict nothing happens."""
    return first_rows(rows, order).join(target.select(*ROW_KEY).distinct(), ROW_KEY, "left_anti")


def upsert_counts(target: DataFrame, rows: DataFrame, order: str = "ordinal") -> DataFrame:
    """inserted, unchanged"""
    keys = first_rows(rows, order).select(*ROW_KEY).join(
        target.select(*ROW_KEY).distinct().withColumn("__there", F.lit(1)), ROW_KEY, "left"
    )
    new = keys.agg(F.count_if(F.col("__there").isNull()).alias("inserted"))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return new.join(F.broadcast(total)).select("inserted", (F.col("total") - F.col("inserted")).alias("unchanged"))  # one row each


def delete_stale(target: DataFrame, repo: str, paths: DataFrame) -> DataFrame:
    """What is left without a repository's rows at ``paths``."""
    gone = paths.select("path", F.lit(repo).alias("repo")).distinct()
    return target.join(gone, ["repo", "path"], "left_anti")


def delete_removed(target: DataFrame, repo: str, live: DataFrame) -> DataFrame:
    """What is left when a repository's rows stay only at live paths; no live paths, no rows of it."""
    kept = target.where(F.col("repo") == repo).join(live.select("path").distinct(), "path", "left_semi")
    return target.where(F.col("repo") != repo).unionByName(kept.select(*target.columns))


def copy_forward(target: DataFrame, source_gen: int, new_gen: int, paths: DataFrame) -> DataFrame:
    """The rows of unchanged files, relabelled to a new generation, that aren't there yet."""
    old = target.where(F.col("gen") == source_gen).join(paths.select("path").distinct(), "path", "left_semi")
    moved = old.withColumn("gen", F.lit(new_gen).cast(target.schema["gen"].dataType)).select(*target.columns)
    return moved.join(target.where(F.col("gen") == new_gen).select(*ROW_KEY).distinct(), ROW_KEY, "left_anti").select(*target.columns)


def parity_gaps(target: DataFrame, source_gen: int, new_gen: int, unchanged: DataFrame) -> DataFrame:
    """Unchanged paths that the old generation has and the new one lacks; none may be left before publication."""
    old = target.where(F.col("gen") == source_gen).select("path").distinct().join(unchanged.select("path"), "path", "left_semi")
    return old.join(target.where(F.col("gen") == new_gen).select("path").distinct(), "path", "left_anti")


def only_live(generation: DataFrame, live: DataFrame) -> DataFrame:
    """Rows of a generation whose file has just this content in the live tree: what an aborted attempt left goes."""
    return generation.join(live.select("path", F.col("blob_sha").alias("file_hash")), ["path", "file_hash"], "left_semi")


def collect_old(target: DataFrame, published: int) -> DataFrame:
    return target.where(F.col("gen") >= published)


def latest_hashes(target: DataFrame) -> DataFrame:
    """path, file_hash of each path's latest row, ties by the larger id."""
    return target.groupBy("path").agg(F.max_by("file_hash", F.struct("created_at", "id")).alias("file_hash"))


def generation_hashes(target: DataFrame, gen: int) -> DataFrame:
    return target.where(F.col("gen") == gen).select("path", "file_hash").distinct()


def chunk_counts(target: DataFrame, *by: str) -> DataFrame:
    return target.groupBy(*by).agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("path").alias("files"))


def rotate(lines: DataFrame, limit: int = 1000, keep: int = 500, order: str = "ordinal") -> DataFrame:
    """All lines of a log of up to ``limit``, else the last ``keep``."""
    n = lines.agg(F.count(F.lit(1)).alias("__n"))  # one row
    last = lines.orderBy(F.desc(order)).limit(keep)
    return lines.join(F.broadcast(n)).where(F.col("__n") <= limit).drop("__n").unionByName(
        last.join(F.broadcast(n)).where(F.col("__n") > limit).drop("__n")
    )


def version_gaps(versions: DataFrame) -> DataFrame:
    """Migration numbers that don't follow the one before by one."""
    before = F.lag("version", 1, 0).over(Window.orderBy("version"))
    return versions.withColumn("before", before).where(F.col("version") != F.col("before") + 1)


#: Shapes of secrets that stop an ingest (fixed values).
SECRET_RULES = {
    "quoted_token": "(?i)(?:token|secret|password|api_key)\\s*=\\s*\"[0-9a-zA-Z_\\-]{16,}\"",
    "prefixed_key": "\\b(?:sk-|sk_live_|sk_test_|ghp_|AKIA)[A-Za-z0-9_\\-]{8,}",
    "private_key": "-----BEGIN [A-Z ]*PRIVATE KEY-----",
}


def secret_findings(docs: DataFrame, text: str = "text", rules: dict[str, str] | None = None) -> DataFrame:
    """The input's rows once for each rule that their text meets, with the rule's name."""
    hits = F.filter(F.array(*[F.when(F.col(text).rlike(p), F.lit(n)) for n, p in (rules or SECRET_RULES).items()]), lambda r: r.isNotNull())
    return docs.withColumn("rule", F.explode(hits))
