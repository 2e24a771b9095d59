import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_responses import ev
from tidemark.functions import text as tx
from tidemark.functions import web
from tidemark.operators import embedding as em


def lengths(texts):
    return [[float(len(t)), 1.0] for t in texts]


def test_embed(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(40)], "id int, content string")
    got = em.embed(df, lengths, 2, batch_size=3).collect()
    assert all(r.embedding == [float(r.id), 1.0] for r in got) and len(got) == 40
    with pytest.raises(Exception, match="vectors of 3"):
        em.embed(df, lengths, 3).collect()
    assert em.only_new(df.withColumn("content_hash", F.col("id")), df.where("id < 30").withColumn("content_hash", F.col("id"))).count() == 10


def test_retry():
    tries, waits = [], []

    def flaky(texts):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("429")
        return lengths(texts)

    assert em.with_retry(flaky, ["ab"], waits.append) == [[2.0, 1.0]] and waits == [1.5, 3.0]
    with pytest.raises(em.EmbedError):
        em.with_retry(lambda t: 1 / 0, ["a"], lambda s: None)


def test_forms(spark):
    assert em.half_bytes([1.0, -2.0]) == b"\0\2\0\1" + np.array([1, -2], ">f2").tobytes()
    assert em.resolve_gate("profile", 0.5) == 0.5 and em.resolve_gate(None, 0.5) is None and em.resolve_gate("0.3", 0.5) == 0.3
    df = spark.createDataFrame([([0.1234567, 1.0],)], "v array<double>")
    assert df.select(em.six_digits("v")).first()[0].startswith("[0.123457,1")
    assert df.select(em.embedding_verdict(F.col("v"), F.col("v"), F.lit(1e-4))).first()[0] is True
    assert df.select(em.embedding_verdict(F.col("v"), F.col("v"), F.lit(float("nan")))).first()[0] is False


def test_small_tables(spark):
    assert ev(spark, "m-fast")(lambda c: tx.is_reasoning_model(c, ("m",))) is False and ev(spark, "k-1")(lambda c: tx.can_switch_off(c, ("k-",))) is False
    assert ev(spark, "a")(lambda c: tx.with_default(c, {"a": "1"}, "0")) == "1" and ev(spark, "b")(lambda c: tx.with_default(c, {}, "0")) == "0"
    assert ev(spark, "x")(lambda c: tx.redact_map(F.create_map(F.lit("h"), F.lit("Bearer abcdef")))) == {"h": "Bearer ***REDACTED***"}
    assert ev(spark, "sk-abcdef")(lambda c: tx.redact_array(F.array(c))) == ["sk-***REDACTED***"]
    page = '{"size": "1024x1024", "n": 2, "size": "x", "cover": "og-cover.png"}'
    assert ev(spark, page)(lambda c: web.parameters(c, ("size", "n", "cover", "none"))) == {"size": "1024x1024", "n": "2"}


def test_half_precision_agrees_with_numpy(spark):
    rng = np.random.default_rng(3)
    whole = np.arange(65536, dtype=np.uint16).view(np.float16).astype(np.float64)
    whole = np.unique(whole[np.isfinite(whole)])
    ties = (whole[1:] + whole[:-1]) / 2  # between neighbours: to the even one
    values = np.concatenate([whole, ties, np.nextafter(ties, np.inf), rng.normal(size=2000) * 10.0 ** rng.integers(-9, 6, 2000), [65519.999, 65520, 1e300, -1e300, 2.0**-25, 3e-8, 0]])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(4)
    with np.errstate(over="ignore"):
        for x, y in df.select("x", em.to_half(F.col("x")).alias("y")).collect():
            assert y == float(np.float16(x)), x
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("-inf"),)], "x double").select(em.to_half(F.col("x")).alias("y")).collect()
    assert odd[0].y is None and np.isnan(odd[1].y) and odd[2].y == float("-inf")


def test_stored_vectors_are_parsed(spark):
    cases = {"[1,2.5,-3e-2]": [1.0, 2.5, -0.03], " [ 1 , 2 ] ": [1.0, 2.0], "4,5": [4.0, 5.0], "[]": [], "": [], "[1,x]": [], "[1,,2]": [], None: []}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", em.parse_vector("t").alias("v")).collect()
    assert {r.t: r.v for r in rows} == cases
