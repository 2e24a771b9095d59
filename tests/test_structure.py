"""Nested redaction, parameters of addresses, and percentiles of large groups."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators import telemetry

HIDDEN = "sk-***REDACTED***"


def test_nested_values(spark):
    schema = "s struct<a: string, m: map<string, array<struct<b: string, n: int>>>, none: struct<c: string>>, t string, k int"
    row = ({"a": "sk-abcdef", "m": {"sk-abcdef": [{"b": "x sk-abcdef", "n": 3}, None], "e": None}, "none": None}, None, 1)
    got = tx.redact_columns(spark.createDataFrame([row], schema)).first().asDict(recursive=True)
    assert got == {"s": {"a": HIDDEN, "m": {"sk-abcdef": [{"b": f"x {HIDDEN}", "n": 3}, None], "e": None}, "none": None}, "t": None, "k": 1}
    one = tx.redact_columns(spark.createDataFrame([row], schema), "t").first()
    assert one.s.a == "sk-abcdef"


@pytest.mark.parametrize("value", [
    {"a": ["sk-abcdef", {"sk-abcdef": "q\nsk-abcdef \\ \" é"}], "n": 1.5, "t": True, "z": None}, [], {}, "sk-abcdef", 7, [[["Bearer abcdef"]]], {"a": ""},
])
def test_json_values(spark, value):
    def walk(v):
        if isinstance(v, dict):
            return {k: walk(x) for k, x in v.items()}
        if isinstance(v, list):
            return [walk(x) for x in v]
        return v.replace("sk-abcdef", HIDDEN).replace("Bearer abcdef", "Bearer ***REDACTED***") if isinstance(v, str) else v

    rows = [(json.dumps(value),), (json.dumps(value, ensure_ascii=False, indent=1),), (json.dumps(value).replace("sk-", "\\u0073k-"),)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(tx.redact_json("t")).collect()]
    assert [json.loads(g) for g in got[:2]] == [walk(value)] * 2
    assert "k-abcdef" not in got[2].replace('sk-abcdef":', "").replace('\\u0073k-abcdef":', "")


def test_what_is_no_json(spark):
    rows = [("{broken sk-abcdef",), (None,), ("",)]
    assert [r[0] for r in spark.createDataFrame(rows, "t string").select(tx.redact_json("t")).collect()] == [f"{{broken {HIDDEN}", None, ""]


@pytest.mark.parametrize(("query", "signed"), [
    ("a=1&TOKEN=x", True), ("q-sign-algorithm=sha1", True), ("OSSAccessKeyId=1", True), ("u=https%3A%2F%2Fi%3Fsignature%3D1", True), ("token", False), ("tokens=1", False),
    ("a=token", False), ("UCloudPublicKey=1", True), ("kind=pre-signed", True), ("X-Amz-SignedHeaders=host", True), ("a=1&b=2", False), ("", False), ("=x", False),
])
def test_parameters_that_sign(spark, query, signed):
    text = f"see https://h/p?{query} end"
    got = spark.createDataFrame([(text,)], "t string").select(tx.redact_signed_urls("t").alias("r")).first().r
    assert (got.n, got.text) == ((1, "see https://h/p?__REDACTED_SIGNED_URL__ end") if signed else (0, text))


@pytest.mark.parametrize("floor", [False, True])
def test_percentiles_of_groups(spark, floor):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, float(rng.randint(0, 30)), rng.random()])) for _ in range(3000)] + [("c", None), ("d", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)

    def want(values):
        values = sorted(v for v in values if v is not None)
        n = len(values)
        place = (lambda p: min(n - 1, math.floor(n * p))) if floor else (lambda p: max(1, math.ceil(n * p)) - 1)
        return (n, *(values[place(p / 100)] if n else None for p in (0, 50, 95, 100)))

    got = {r[0]: tuple(r)[1:] for r in telemetry.large_percentiles(df, "v", (0, 50, 95, 100), "g", floor=floor).collect()}
    assert got == {g: want([v for h, v in rows if h == g]) for g in {g for g, _ in rows}}
    assert [tuple(r) for r in telemetry.large_percentiles(df, "v", (0, 50, 95, 100), floor=floor).collect()] == [want([v for _, v in rows])]


def test_percentiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, v double")
    assert telemetry.large_percentiles(none, "v", (50,), "g").count() == 0
    assert [tuple(r) for r in telemetry.large_percentiles(none, "v", (50,)).collect()] == [(0, None)]


def test_percentiles_of_many_distinct_values(spark):
    n = 3_000_000
    rows = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("v"))
    assert tuple(telemetry.large_percentiles(rows, "v", (50, 95)).first()) == (n, n / 2 - 1, n * 0.95 - 1)
