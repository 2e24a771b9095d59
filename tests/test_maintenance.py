import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import catalogue, maintenance

ROW = "id long, repo string, path string, content_hash string, file_hash string, created_at int, gen int"


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROW)


def test_plan(spark):
    live = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, blob_sha string")
    stored = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "path string, file_hash string")
    assert dict(map(tuple, maintenance.sync_plan(live, stored).collect())) == {"a": "unchanged", "b": "changed", "c": "new", "d": "removed"}
    assert {r.action for r in maintenance.sync_plan(live, stored.limit(0)).collect()} == {"new"}


def test_upsert_is_idempotent_and_first_wins(spark):
    new = spark.createDataFrame([("r", "a", "h", 1, 2), ("r", "a", "h", 1, 1), ("r", "a", "i", 1, 3)], "repo string, path string, content_hash string, gen int, ordinal int")
    target = rows(spark)
    first = maintenance.upsert(target, new)
    assert sorted(r.ordinal for r in first.collect()) == [1, 3]
    again = maintenance.upsert_counts(first, new).first()
    assert (again.inserted, again.unchanged) == (0, 3) and maintenance.upsert_counts(target, new).first() == (2, 1)


def test_deletes_and_copies(spark):
    t = rows(spark, (1, "r", "a", "h", "f", 1, 1), (2, "r", "b", "h", "f", 1, 1), (3, "s", "b", "h", "f", 1, 1))
    paths = spark.createDataFrame([("b",)], "path string")
    assert sorted(r.id for r in maintenance.delete_stale(t, "r", paths).collect()) == [1, 3]
    assert sorted(r.id for r in maintenance.delete_removed(t, "r", paths).collect()) == [2, 3]
    assert sorted(r.id for r in maintenance.delete_removed(t, "r", paths.limit(0)).collect()) == [3]
    moved = maintenance.copy_forward(t, 1, 2, paths)
    assert sorted((r.repo, r.path, r.gen) for r in moved.collect()) == [("r", "b", 2), ("s", "b", 2)]
    both = t.unionByName(moved)
    assert maintenance.copy_forward(both, 1, 2, paths).count() == 0 and maintenance.parity_gaps(both, 1, 2, paths).count() == 0
    assert [r.path for r in maintenance.parity_gaps(t, 1, 2, paths).collect()] == ["b"]
    assert maintenance.collect_old(both, 2).count() == 2


def test_rotation_and_secrets(spark):
    log = spark.range(12).withColumnRenamed("id", "ordinal")
    assert maintenance.rotate(log, 12, 5).count() == 12 and [r.ordinal for r in maintenance.rotate(log, 11, 5).orderBy("ordinal").collect()] == [7, 8, 9, 10, 11]
    docs = spark.createDataFrame([(1, 'token = "0123456789abcdef"'), (2, "AKIA12345678"), (3, None), (4, "plain"), (5, "-----BEGIN RSA PRIVATE KEY-----")], "id int, text string")
    assert sorted((r.id, r.rule) for r in maintenance.secret_findings(docs).collect()) == [(1, "quoted_token"), (2, "prefixed_key"), (5, "private_key")]


RESULT = "group string, test string, target string, passed boolean, skipped boolean, ordinal int"


def test_divergence(spark):
    results = spark.createDataFrame([
        ("g", "pp", "gateway", True, False, 1), ("g", "pp", "proxy", True, False, 2), ("g", "ff", "gateway", False, False, 3), ("g", "ff", "proxy", False, False, 4),
        ("g", "pf", "gateway", True, False, 5), ("g", "pf", "proxy", False, False, 6), ("g", "fp", "gateway", False, False, 7), ("g", "fp", "proxy", True, False, 8),
        ("g", "one", "gateway", True, False, 9), ("g", "skip", "gateway", True, True, 10), ("g", "skip", "proxy", True, False, 11), ("g", "last", "proxy", True, False, 12),
        ("g", "last", "gateway", True, False, 13), ("g", "last", "gateway", False, False, 14),
    ], RESULT)
    got = {r.test: (r["class"], r.ours) for r in catalogue.divergence(results).collect()}
    assert got == {"pp": ("same_pass", False), "ff": ("same_fail", False), "pf": ("gateway_only", True), "fp": ("proxy_only", False), "one": ("incomplete", False),
                   "skip": ("incomplete", False), "last": ("proxy_only", False)}
    assert {r["class"]: r.n for r in catalogue.divergence_counts(catalogue.divergence(results)).collect()}["divergent"] == 0


def test_conformance_and_matrix(spark):
    results = spark.createDataFrame([("e", "gateway", "pass"), ("e", "gateway", "diverged"), ("e", "proxy", "fail"), ("f", "gateway", "skipped")], "endpoint string, target string, status string")
    assert sorted(map(tuple, catalogue.conformance(results).collect())) == [("e", "diverged", "fail", "fail"), ("f", "skipped", "skipped", "skipped")]
    matrix = spark.createDataFrame([("g", "t", "old", "e"), ("g", "u", "kept", "e")], "group string, test string, status string, evidence string")
    new = spark.createDataFrame([("g", "t", "first", "x", 1), ("g", "t", "last", "y", 2)], "group string, test string, status string, evidence string, ordinal int")
    assert sorted(map(tuple, catalogue.update_matrix(matrix, new).collect())) == [("g", "t", "last", "y"), ("g", "u", "kept", "e")]


@pytest.mark.parametrize(("name", "kind"), [("m-embed-x", "embedding"), ("m-image-a-fast", "image"), ("m-tts-b", "tts"), ("m-asr-c", "asr"), ("m-d-fast", "chat-fast"), ("m-e", "chat")])
def test_modality(spark, name, kind):
    assert spark.range(1).select(catalogue.modality(F.lit(name), "m-")).first()[0] == kind


def test_model_list_ends_at_the_next_key(spark):
    text = "other:\n  - model_name: m-no\n    model: no\nmodel_list:\n  - model_name: m-a\n    params:\n      model: openai/up\n  - model_name: x-b\n      model: skipped\nrouter:\n  - model_name: m-c\n      model: late"
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(text.split("\n"))], "file string, line_no int, line string")
    assert [tuple(r) for r in catalogue.parse_model_list(lines, "m-").collect()] == [("f", "m-a", "chat", "up")]


def test_session_settings(spark):
    again = session.build_session()
    assert again.conf.get("spark.sql.session.timeZone") == "UTC" and again.conf.get("spark.sql.adaptive.enabled") == "true"
