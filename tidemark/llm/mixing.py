"""Mixing sources to target weights by iterative proportional fitting (raking), with DataFrame operations only.

Documents are summed to cells (source, language, topic) of token weight. Each sweep scales the cells to the targets of one
margin after the other, until no scale of a sweep differs from 1 by more than a tolerance; a margin is an aggregate with map-side
combining, joined back by its value. A document's probability is its cell's scaling factor over the largest one, so
probabilities stay below 1 and the kept tokens have the fitted margins in expectation. Sampling compares it with a hash of the
document's id.

The largest factor is the rarest value's, so that rule keeps 1 / (largest factor) of the tokens, however few that are. With a
keep rate or a budget of tokens, the targets are cut to what each value has, the cells are raked with no cell above its own
weight, and the scale is the one at which the kept tokens are that many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import mark, release, stage

MARGINS = ("source", "lang", "topic")
#: The target share of a value is its own share to this power, scaled to sum to 1; 1 leaves a margin as it is.
POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Sweeps end when all scales of one are this near to 1, or after so many.
TOLERANCE, SWEEPS, CAPPED_SWEEPS = 0.01, 20, 3
#: Sweeps of one Spark job. Sums are windows over the cells of a value: cells are few beside the rows they stand for.
SWEEPS_A_JOB = 3
#: The share of the tokens that the pipeline keeps at least.
KEEP = 0.2
NONE = "(none)"
#: {margin: {value: share of the tokens}}; margins and values that aren't named keep the rules of :func:`margin_targets`.
Shares = dict[str, dict[str, float]]


def layout_topic(text: Column) -> Column:
    """The stand-in for a topic where the table has none: how a text is laid out in lines."""
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, NONE)
        .when(lines == 1, "line")
        .when(F.length(text) < 120 * lines, "list")
        .otherwise("prose")
    )


def token_weight(text: Column) -> Column:
    """A quarter of the characters, 1 at least."""
    return F.greatest(F.lit(1), F.floor(F.coalesce(F.length(text), F.lit(0)) / 4)).cast("double")


def own_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(margin, target): the margin's values and the weight each should have; they sum to the cells' total."""
    shares = cells.groupBy(margin).agg(F.sum("base").alias("size")).withColumn("pull", F.pow("size", F.lit(power)))
    sums = shares.agg(F.sum("size").alias("total"), F.sum("pull").alias("pulls"))  # one row
    return shares.join(F.broadcast(sums)).select(margin, (F.col("pull") * F.col("total") / F.col("pulls")).alias("target"))


def margin_targets(cells: DataFrame, margin: str, powers: dict[str, float], shares: Shares | None) -> DataFrame:
    """(margin, target) by the powers of the own shares, or by given shares: what these leave of the whole goes to the values that
    aren't named, by their sizes. Shares above 1 in all are scaled to 1. Named values that don't occur are left out."""
    if not shares or margin not in shares:
        return own_targets(cells, margin, powers[margin])
    given, scale = shares[margin], max(1.0, sum(shares[margin].values()))
    left = 1.0 - sum(given.values()) / scale
    sizes = cells.groupBy(margin).agg(F.sum("base").alias("size"))
    share = F.lit(None).cast("double")
    for value, part in given.items():
        share = F.when(F.col(margin) == value, F.lit(part / scale)).otherwise(share)
    sizes = sizes.withColumn("share", share)
    sums = sizes.agg(F.sum("size").alias("total"), F.sum(F.when(F.col("share").isNull(), F.col("size"))).alias("unnamed"))  # one row
    rest = F.lit(left) * F.col("size") / F.col("unnamed")
    return sizes.join(F.broadcast(sums)).select(margin, (F.coalesce("share", rest) * F.col("total")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, capped: bool = False, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (margins, base) with ``weight`` (base fitted to the targets, the last margin exactly), ``sweeps`` (how many it
    took) and ``residual`` (the most by which a scale of the last of them differed from 1).

    A value without a target keeps its weight. A job does SWEEPS_A_JOB sweeps over all margins and writes the cells to the shared
    folder with the weights after each of them; the first sweep within the tolerance counts. ``capped`` starts from the cells'
    own weight and holds it to their base; what a cell lacks goes to the others of its values in the later sweeps.
    """
    fitted, columns = (cells if capped else cells.withColumn("weight", F.col("base"))), [f"__to_{m}" for m in targets]
    for m, target in targets.items():
        fitted = fitted.join(target.withColumnRenamed("target", f"__to_{m}"), m, "left")
    kept = [c for c in fitted.columns if c not in (*columns, "weight")]
    fitted, done, residual = stage(fitted, "raked"), 0, None
    while done < sweeps and (residual is None or residual > tolerance):
        several = range(1, min(SWEEPS_A_JOB, sweeps - done) + 1)
        for i in several:
            gap = F.lit(0.0)
            for m in targets:
                now = F.sum("weight").over(Window.partitionBy(m))
                fitted = fitted.withColumn("__scale", F.coalesce(F.try_divide(F.col(f"__to_{m}"), now), F.lit(1.0)))
                scaled = F.col("weight") * F.col("__scale")
                fitted = fitted.withColumn("weight", F.least("base", scaled) if capped else scaled)
                gap = F.greatest(gap, F.abs(F.col("__scale") - 1))
                fitted = fitted.withColumn(f"__gap_{i}", gap).drop("__scale")
                gap = F.col(f"__gap_{i}")
            fitted = fitted.withColumn(f"__weight_{i}", F.col("weight"))
        fitted = stage(fitted, "raked")
        gaps = fitted.agg(*[F.max(f"__gap_{i}") for i in several]).first()
        if gaps[0] is None:
            done, residual = done + 1, None
            break
        last = next((i for i in several if gaps[i - 1] <= tolerance), several[-1])
        done, residual = done + last, gaps[last - 1]
        fitted = fitted.select(*kept, *columns, F.col(f"__weight_{last}").alias("weight"))
    return fitted.select(*kept, "weight").withColumns({"sweeps": F.lit(done), "residual": F.lit(residual).cast("double")})


def fill(parts: DataFrame, total: float) -> float:
    """The c for which the sum of min(size, c * pull) over ``parts`` (size, pull) is ``total``.

    Parts that reach their size are set aside, and c is found anew for the others, until no more reach it.
    """
    c = 0.0
    while True:
        full = F.col("pull") * c >= F.col("size")
        sums = parts.agg(F.sum(F.when(full, F.col("size")).otherwise(0.0)).alias("full"), F.sum(F.when(~full, F.col("pull"))).alias("pulls")).first()
        if not sums.pulls or (total - sums.full) / sums.pulls <= c * (1 + 1e-9):
            return c
        c = (total - sums.full) / sums.pulls


def kept_share(cells: DataFrame, wanted: dict[str, DataFrame], budget: float, sweeps: int = CAPPED_SWEEPS) -> DataFrame:
    """The cells (margins, base, factor) with the prob at which ``budget`` tokens stay in expectation, as near to the targets
    as the cells allow. The sweeps start from the fitted factors, scaled so that the whole is right."""
    targets = {}
    for m in MARGINS:
        sizes = cells.groupBy(m).agg(F.sum("base").alias("size")).join(wanted[m], m).withColumnRenamed("target", "pull")
        sizes = stage(sizes, f"sizes-{m}")
        targets[m] = sizes.select(m, F.least("size", F.col("pull") * fill(sizes, budget)).alias("target"))
    c = fill(cells.select(F.col("base").alias("size"), (F.col("factor") * F.col("base")).alias("pull")), budget)
    started = cells.withColumn("weight", F.col("base") * F.least(F.lit(1.0), c * F.col("factor")))
    fitted = rake(started, targets, sweeps, capped=True)
    c = fill(fitted.select(F.col("base").alias("size"), F.col("weight").alias("pull")), budget)
    return fitted.select(*MARGINS, F.least(F.lit(1.0), c * F.col("weight") / F.col("base")).alias("prob"))


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) made from a key: the first 32 bits of an MD5."""
    digest = F.md5(F.encode(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(NONE))), "UTF-8"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def keys_of(text: Column, topic: Column | None = None, tokens: Column | None = None) -> dict[str, Column]:
    """The columns that a document is dealt to a cell by, and its weight: ``topic`` and ``tokens`` where the caller has them (a
    classifier's label, a tokenizer's counts), else the layout and a quarter of the characters."""
    return {
        "source": F.coalesce("source", F.lit(NONE)),
        "lang": F.coalesce("lang", F.lit(NONE)),
        "topic": layout_topic(text) if topic is None else F.coalesce(topic.cast("string"), F.lit(NONE)),
        "tokens": token_weight(text) if tokens is None else F.greatest(F.lit(1.0), F.coalesce(tokens.cast("double"), F.lit(0.0))),
    }


def probabilities(
    keyed: DataFrame, powers: dict[str, float] | None = None, shares: Shares | None = None, keep: float | None = None,
    budget: float | None = None, tolerance: float = TOLERANCE,
) -> DataFrame:
    """The fitted cells: margins, factor (fitted over own weight), prob (factor over the largest factor), sweeps and residual.

    A small table in the shared folder: a row for each combination of values that occurs. Where the largest factor would leave
    less than ``keep`` of the tokens, and with a ``budget`` of tokens always, prob is that of :func:`kept_share`. A budget above
    what there is keeps all.
    """
    spark, began, powers = keyed.sparkSession, mark(), POWERS | (powers or {})
    cells = stage(keyed.groupBy(*MARGINS).agg(F.sum("tokens").alias("base")), "cells")
    targets = {m: stage(margin_targets(cells, m, powers, shares), f"target-{m}") for m in MARGINS}
    factors = rake(cells, targets, tolerance=tolerance).withColumn("factor", F.col("weight") / F.col("base")).drop("weight")
    top = factors.agg(F.max("factor").alias("__top"))  # one row
    probs = factors.join(F.broadcast(top)).select(*MARGINS, "factor", F.coalesce(F.try_divide("factor", "__top"), F.lit(0.0)).alias("prob"), "sweeps", "residual")
    probs = stage(probs, "probabilities")
    total = cells.agg(F.sum("base")).first()[0]
    largest = probs.agg(F.max("factor")).first()[0]
    wanted = min(budget, total) if budget is not None and total else keep * total if keep and largest and 1 / largest < keep else None
    if wanted is not None:
        raised = kept_share(cells.join(probs.drop("prob"), list(MARGINS)), targets, wanted)
        probs = stage(probs.drop("prob").join(raised, list(MARGINS)), "probabilities")
    release(spark, began, probs)
    return probs


def calibrate(docs: DataFrame, powers: dict[str, float] | None = None, seed: str = "mix:", shares: Shares | None = None,
              budget: float | None = None, topic: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, factor, prob, kept, sweeps and residual of every document.

    Targets are powers of the own shares, or ``shares`` of the tokens by margin and value; ``budget`` is how many tokens stay in
    expectation. A null source or language counts as the value ``(none)``, a null or empty text as topic ``(none)`` with one token.
    Documents that share an id share the draw. Repeated rows are kept or left together; an empty table gives no rows;
    a table's own column ``topic``, if it has one, is used only when it is given as ``topic``, and other columns aren't used.
    """
    keys = keys_of(F.col("text"), topic, tokens)
    keyed = stage(docs.select("doc_id", *[c.alias(k) for k, c in keys.items()]), "keyed")
    return keyed.join(probabilities(keyed, powers, shares, budget=budget), list(MARGINS)).select(
        "doc_id", *MARGINS, "tokens", "factor", "prob", (uniform(F.col("doc_id"), seed) < F.col("prob")).alias("kept"), "sweeps", "residual"
    )


def mix(docs: DataFrame, powers: dict[str, float] | None = None, seed: str = "mix:", keep: float | None = None, shares: Shares | None = None,
        budget: float | None = None, topic: Column | None = None, tokens: Column | None = None) -> DataFrame:
    """The documents that the draw of :func:`calibrate` keeps, with the columns they came with.

    With ``keep``, no fewer than that share of the tokens in expectation, whatever the rarest value is.
    The fitted cells are joined to the documents, which aren't shuffled while Spark can broadcast the cells.
    """
    keys = keys_of(F.col("text"), topic, tokens)
    probs = probabilities(docs.select(*[c.alias(k) for k, c in keys.items()]), powers, shares, keep, budget)
    probs = probs.select(F.col("prob").alias("__prob"), *[F.col(m).alias(f"__{m}") for m in MARGINS])
    matched = docs.withColumns({f"__own_{m}": keys[m] for m in MARGINS}).join(probs, [F.col(f"__own_{m}") == F.col(f"__{m}") for m in MARGINS])
    return matched.where(uniform(F.col("doc_id"), seed) < F.col("__prob")).select(*docs.columns)


def calibrate_sql(powers: dict[str, float] | None = None, seed: str = "mix:", docs: str = "documents") -> str:
    """DuckDB SQL for the rows of :func:`calibrate`, with factor, prob and residual rounded to nine places."""
    powers = POWERS | (powers or {})
    parts = [
        f"""keyed AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
  CASE WHEN coalesce(length(text), 0) = 0 THEN '{NONE}' WHEN lines = 1 THEN 'line'
       WHEN length(text) < 120 * lines THEN 'list' ELSE 'prose' END AS topic,
  greatest(1, floor(coalesce(length(text), 0) / 4))::DOUBLE AS tokens
  FROM (SELECT *, length(text) - length(replace(text, chr(10), '')) + 1 AS lines FROM {docs}))""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS base FROM keyed GROUP BY ALL)",
    ]
    for m in MARGINS:
        parts.append(
            f"t_{m} AS MATERIALIZED (SELECT {m}, pow(size, {powers[m]}) * sum(size) OVER () / sum(pow(size, {powers[m]})) OVER () AS to_{m} "
            f"FROM (SELECT {m}, sum(base) AS size FROM cells GROUP BY {m}))"
        )
    step = "SELECT *, weight AS w0 FROM r WHERE residual > " + f"{TOLERANCE} AND sweeps < {SWEEPS}"
    for i, m in enumerate(MARGINS):
        step = f"SELECT *, to_{m} / sum(w{i}) OVER (PARTITION BY {m}) AS s{i}, w{i} * s{i} AS w{i + 1} FROM ({step})"
    parts.append(
        f"""r AS (SELECT source, lang, topic, base, to_source, to_lang, to_topic, base AS weight, 0 AS sweeps, 1e9::DOUBLE AS residual
  FROM cells JOIN t_source USING (source) JOIN t_lang USING (lang) JOIN t_topic USING (topic)
  UNION ALL SELECT source, lang, topic, base, to_source, to_lang, to_topic, w3, sweeps + 1,
    max(greatest(abs(s0 - 1), abs(s1 - 1), abs(s2 - 1))) OVER () FROM ({step}))"""
    )
    parts.append("f AS (SELECT *, weight / base AS factor, weight / base / max(weight / base) OVER () AS prob FROM r WHERE sweeps = (SELECT max(sweeps) FROM r))")
    return (
        "WITH RECURSIVE " + ",\n".join(parts) + "\nSELECT doc_id, source, lang, topic, tokens, round(factor, 9) AS factor, round(prob, 9) AS prob, "
        f"('0x' || substr(md5('{seed}' || coalesce(doc_id::VARCHAR, '{NONE}')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 < prob AS kept, "
        "sweeps, round(residual, 9) AS residual FROM keyed JOIN f USING (source, lang, topic)"
    )
