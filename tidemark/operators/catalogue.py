"""Catalogue work: inventories, enrichment joins, pairing, divergence and conformance tables, keyed updates, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col, family, redact

#: Modalities by the word behind the inventory's prefix (fixed values).
MODALITIES = {"embed-": "embedding", "image-": "image", "tts-": "tts", "asr-": "asr"}


def modality(name: Column | str, prefix: str) -> Column:
    found = F.lit(None).cast("string")
    for word, kind in MODALITIES.items():
        found = F.coalesce(found, F.when(col(name).startswith(prefix + word), kind))
    return F.coalesce(found, F.when(col(name).endswith("-fast"), "chat-fast").otherwise("chat"))


def parse_model_list(lines: DataFrame, prefix: str, order: str = "line_no", text: str = "line") -> DataFrame:
    """group, modality, upstream_id of each ``model_name`` under ``model_list:`` and the ``model:`` that follows it.

    Lines are numbered within a file column ``file``; names without ``prefix`` are passed over.
    """
    w = Window.partitionBy("file").orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    line = F.col(text)
    name = F.nullif(F.regexp_extract(line, "^\\s*-\\s*model_name:\\s*(\\S+)\\s*$", 1), F.lit(""))
    model = F.nullif(F.regexp_extract(line, "^\\s*model:\\s*(\\S+)\\s*$", 1), F.lit(""))
    begun = F.max(line.rlike("^model_list:\\s*$")).over(upto)
    marked = lines.select("file", order, name.alias("name"), model.alias("model"), begun.alias("begun"), line.rlike("^[a-z_]+:").alias("top"))
    ended = F.max(F.col("begun") & F.col("top") & F.lag("begun", 1, False).over(w)).over(upto)
    inside = marked.withColumn("ended", ended).where("begun AND NOT ended AND (name IS NOT NULL OR model IS NOT NULL)")
    pending = inside.withColumn("pending", F.lag("name").over(w)).where("model IS NOT NULL").where(F.col("pending").startswith(prefix))
    return pending.select(
        "file", F.col("pending").alias("group"), modality("pending", prefix).alias("modality"), F.regexp_replace("model", "^openai/", "").alias("upstream_id")
    )


#: Parts of names that aren't chat models (fixed values).
NOT_CHAT = ("embed", "image", "tts", "asr", "ocr", "rerank", "speech", "audio", "wan", "seedream", "3d")


def chat_models(inventory: DataFrame, hints: tuple[str, ...] = NOT_CHAT) -> DataFrame:
    return inventory.where(~F.lower("id").rlike("|".join(hints))).orderBy("id")


def in_families(inventory: DataFrame, families: tuple[str, ...]) -> DataFrame:
    """The groups of some families; none named are all."""
    return inventory.where(family("group").isin(*families)) if families else inventory


def representatives(inventory: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    """place, group, modality: of each wanted modality the first group (``ordinal``), in the order of ``wanted``."""
    place = F.coalesce(*[F.when(F.col("modality") == name, F.lit(i)) for i, name in enumerate(wanted)])
    first = inventory.withColumn("place", place).where("place IS NOT NULL").groupBy("place").agg(F.min_by(F.struct("group", "modality"), "ordinal").alias("f"))
    return first.select("place", "f.group", "f.modality").orderBy("place")


def enrich(models: DataFrame, modalities: DataFrame, slugs: DataFrame, pages: DataFrame) -> DataFrame:
    """One row for each id that any source has: models (id, owned_by, pricing), modalities (id, modality), slugs (id), pages (id, ..)."""
    ids = models.select("id").union(modalities.select("id")).union(slugs.select("id")).union(pages.select("id")).distinct()
    lists = modalities.groupBy("id").agg(F.array_sort(F.collect_set("modality")).alias("modalities"))
    return (
        ids.join(models, "id", "left").join(lists, "id", "left").join(pages.withColumn("has_page", F.lit(True)), "id", "left")
        .withColumn("modalities", F.coalesce("modalities", F.array().cast("array<string>"))).withColumn("has_page", F.coalesce("has_page", F.lit(False)))
    )


def match_inventory(inventory: DataFrame, models: DataFrame, only_inventory: bool = False) -> DataFrame:
    """Models and inventory by upstream id; of several inventory rows the first (``ordinal``) counts."""
    first = inventory.groupBy(F.col("upstream_id").alias("id")).agg(F.min_by(F.struct("group", "modality"), "ordinal").alias("f"))
    first = first.select("id", "f.group", "f.modality")
    return first.join(models, "id", "left" if only_inventory else "full_outer")


def base_fast_pairs(inventory: DataFrame) -> DataFrame:
    """slug, on, off of those chat groups that have both forms."""
    slug = F.regexp_replace("group", "-fast$", "")
    fast = F.col("group").endswith("-fast")
    return inventory.where(F.col("modality").isin("chat", "chat-fast")).groupBy(slug.alias("slug")).agg(
        F.max(F.when(~fast, F.col("group"))).alias("on"), F.max(F.when(fast, F.col("group"))).alias("off")
    ).where("on IS NOT NULL AND off IS NOT NULL")


def ghost_models(inventory: DataFrame, models: DataFrame) -> DataFrame:
    """Upstream ids that the inventory names and no source has."""
    return inventory.select(F.col("upstream_id").alias("id")).subtract(models.select("id"))


def divergence(results: DataFrame) -> DataFrame:
    """group, test, class of the last result (``ordinal``) of each target: gateway and proxy. Skipped counts as missing."""
    state = F.when(F.col("skipped"), "missing").otherwise(F.when(F.col("passed"), "pass").otherwise("fail"))

    def of(target: str) -> Column:
        mine = F.col("target") == target
        return F.coalesce(F.max_by(F.when(mine, state), F.when(mine, F.col("ordinal"))), F.lit("missing"))

    pairs = results.groupBy("group", "test").agg(of("gateway").alias("g"), of("proxy").alias("p"), F.min("ordinal").alias("ordinal"))
    kind = (
        F.when((F.col("g") == "missing") | (F.col("p") == "missing"), "incomplete").when(F.col("g") == F.col("p"), F.concat(F.lit("same_"), "g"))
        .when(F.col("g") == "pass", "gateway_only").otherwise("proxy_only")
    )
    return pairs.select("group", "test", kind.alias("class"), (kind == "gateway_only").alias("ours"), "ordinal")


DIVERGENCE_CLASSES = ("same_pass", "same_fail", "divergent", "gateway_only", "proxy_only", "incomplete")


def divergence_counts(classified: DataFrame) -> DataFrame:
    """All classes in their order, with how many pairs each has."""
    order = classified.sparkSession.createDataFrame(list(enumerate(DIVERGENCE_CLASSES)), "place int, class string")
    counts = classified.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    return order.join(counts, "class", "left").select("place", "class", F.coalesce("n", F.lit(0)).alias("n"))


SEVERITY = ("skipped", "pass", "diverged", "fail")


def conformance(results: DataFrame, targets: tuple[str, ...] = ("gateway", "proxy")) -> DataFrame:
    """endpoint, a column for each target, and the verdict over them: fail before diverged, pass and skipped."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), F.col("status"))
    worst = lambda c: F.coalesce(F.try_element_at(F.array(*[F.lit(s) for s in SEVERITY]), c.cast("int")), F.lit("skipped"))
    columns = [worst(F.max(F.when(F.col("target") == t, rank))).alias(t) for t in targets]
    return results.groupBy("endpoint").agg(*columns, worst(F.max(rank)).alias("verdict"))


def sweep_summary(results: DataFrame) -> DataFrame:
    """target, test, passes, failures, the last envelope and how many of each envelope."""
    target = F.coalesce(F.nullif("target", F.lit("")), F.lit("?"))
    counts = results.groupBy(target.alias("target"), "test", "envelope").agg(
        F.count_if("passed").alias("p"), F.count(F.lit(1)).alias("n"), F.max("ordinal").alias("last")
    )
    return counts.groupBy("target", "test").agg(
        F.sum("p").alias("passes"), (F.sum("n") - F.sum("p")).alias("failures"), F.max_by("envelope", "last").alias("envelope"), F.count(F.lit(1)).alias("envelopes")
    )


def update_matrix(matrix: DataFrame, results: DataFrame) -> DataFrame:
    """The matrix with status and evidence of the last result of its key; measured values stay where there is none."""
    last = results.groupBy("group", "test").agg(F.max_by(F.struct("status", "evidence"), "ordinal").alias("r"))
    joined = matrix.join(last, ["group", "test"], "left")
    return joined.withColumn("status", F.coalesce("r.status", "status")).withColumn("evidence", F.coalesce("r.evidence", "evidence")).select(*matrix.columns)


def most_common(values: DataFrame, value: str, order: str) -> DataFrame:
    """Frequencies, the largest first, of equals the one seen first."""
    counted = values.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("seen"))
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "seen"))).select("place", value, "n")


def coverage(frame: DataFrame, fields: list[str]) -> DataFrame:
    """How many rows there are, and how many have each field: neither null nor empty."""
    filled = lambda c: F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return frame.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(filled(c)).alias(c) for c in fields])


def log_records(results: DataFrame, run_id: str) -> DataFrame:
    """What the result log holds of each check that wasn't skipped: secrets out, passed as success or failure."""
    text = [f.name for f in results.schema.fields if f.dataType.simpleString() == "string"]
    status = F.when(F.col("passed"), "success").otherwise("failure")
    shown = results.where(~F.col("skipped")).withColumns({c: redact(c) for c in text})
    return shown.withColumns({"status": status, "run_id": F.lit(run_id)})


def result_counts(results: DataFrame) -> DataFrame:
    """passed, failed, skipped: a skipped check is only that."""
    skipped, passed = F.col("skipped"), F.col("passed")
    return results.agg(F.count_if(~skipped & passed).alias("passed"), F.count_if(~skipped & ~passed).alias("failed"), F.count_if(skipped).alias("skipped"))
