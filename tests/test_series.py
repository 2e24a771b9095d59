"""Append-only series that begin anew after damage, evidence without credentials, and what a search shows."""

import json
import os

import pytest

from tidemark.operators import search as op
from tidemark.sources.series import append_series, read_series, write_evidence

SCHEMA = "taken_at string, calls long, spend double, note string"


def entry(spark, day, spend=0.12345678):
    return spark.createDataFrame([(day, 3, spend, None)], SCHEMA)


def test_series_grows_and_rounds(spark, tmp_path):
    path = f"{tmp_path}/deep/series"
    for day in ("a", "b", "b"):
        series = append_series(entry(spark, day), path)
    assert sorted(series.collect()) == [("a", 3, 0.123457, None), ("b", 3, 0.123457, None), ("b", 3, 0.123457, None)]
    append_series(spark.createDataFrame([], SCHEMA), path)
    assert read_series(spark, path, series.schema).count() == 3


@pytest.mark.parametrize("line", ['{"taken_at": "x", "ca', "[1, 2", '{"calls": "many"}', "\0\0"])
def test_a_damaged_series_begins_anew(spark, tmp_path, line):
    path = f"{tmp_path}/series"
    append_series(entry(spark, "a"), path)
    (tmp_path / "series/part-x.json").write_text(line + "\n")
    assert [r.taken_at for r in append_series(entry(spark, "b"), path).collect()] == ["b"]
    assert [r.taken_at for r in append_series(entry(spark, "c"), path).orderBy("taken_at").collect()] == ["b", "c"]
    aside = [name for name in os.listdir(tmp_path) if name.startswith("series-damaged-")]
    assert len(aside) == 1 and "part-x.json" in os.listdir(tmp_path / aside[0])


def test_evidence_has_no_credentials(spark, tmp_path):
    signed = "see https://h/x.png?Signature=abcdef&Expires=1 and https://h/y?q=1"
    rows = spark.createDataFrame([(1, signed, None)], "n int, body string, other string")
    for _ in range(2):
        write_evidence(rows, f"{tmp_path}/e")
    texts = [r.value for r in spark.read.text(f"{tmp_path}/e").collect()]
    assert len(texts) == 2 and all("abcdef" not in t and "https://h/y?q=1" in json.loads(t)["body"] for t in texts)


def test_shown_hits_are_a_start_of_deeper_ones(spark):
    vec = lambda x: [1.0, x]
    rows = [(i, "r", f"p{i // 2}", None, None, "doc", "same words" if i < 4 else f"words {i}", 0, vec(i / 10)) for i in range(20)]
    chunks = spark.createDataFrame(rows, "id long, repo string, path string, lang string, symbol string, kind string, content string, gen int, embedding array<double>")
    queries = spark.createDataFrame([(1, vec(0.0), ["words"]), (2, vec(1.0), ["absent"])], "qid long, qvec array<double>, terms array<string>")
    shown = {k: [(r.qid, r.shown, r.id) for r in op.shown_hits(chunks, queries, k).orderBy("qid", "shown").collect()] for k in (0, 3, None, 50)}
    for q in (1, 2):
        of = {k: [id for qid, _, id in hits if qid == q] for k, hits in shown.items()}
        assert len(of[0]) == 1 and of[0] == of[3][:1] and of[3] == of[None][:3] and len(of[None]) == 6
        assert len(of[50]) == 18 and len({0, 1} & set(of[50])) == len({2, 3} & set(of[50])) == 1
    assert [n for _, n, _ in shown[3]] == [1, 2, 3, 1, 2, 3]
