import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import evaluation, search, telemetry
from tidemark.plans import evaluation_queries, search_queries


def ranked(spark, rows, dist=False):
    return spark.createDataFrame(rows, "qid int, id string, rank int" + (", dist double" if dist else ""))


def test_fusion_numbers(spark):
    one = search.reciprocal_rank_fusion([ranked(spark, [(1, "a", 1), (1, "b", 2)])]).collect()
    assert {r.id: r.score for r in one} == {"a": round(1 / 61, 6), "b": round(1 / 62, 6)}
    dense, lexical = ranked(spark, [(1, "a", 1, 0.1), (1, "b", 2, 0.2)], dist=True), ranked(spark, [(1, "b", 1), (1, "c", 2)])
    both = {r.id: r for r in search.reciprocal_rank_fusion([dense, lexical]).collect()}
    assert both["b"].score == round(1 / 62 + 1 / 61, 6) and (both["b"].vec_rank, both["b"].lex_rank, both["b"].dist) == (2, 1, 0.2)
    assert (both["c"].vec_rank, both["c"].dist) == (None, None)
    weighted = search.reciprocal_rank_fusion([ranked(spark, [(1, "a", 1)])] * 2, [2.0, 1.0]).first()
    assert weighted.score == round(3 / 61, 6)
    gated = search.reciprocal_rank_fusion([dense, lexical])
    assert search.distance_gate(gated, 0.1).count() == 3 and search.distance_gate(gated, 0.09).count() == 0 and search.distance_gate(gated, None).count() == 3
    only_lexical = search.reciprocal_rank_fusion([dense.limit(0), lexical])
    assert search.distance_gate(only_lexical, 1.0).count() == 0


def test_ties_by_path(spark):
    hits = spark.createDataFrame([(1, "x", 0.5, "b", None), (1, "y", 0.5, "a", None), (1, "z", 0.9, "c", None)], "qid int, id string, score double, path string, symbol string")
    assert [r.path for r in search.final_order(hits, 2).orderBy("pos").collect()] == ["c", "a"]


def test_queries_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    queries = spark.range(5).select(F.col("id").alias("qid"), F.array(F.lit(1.0)).alias("qvec"))
    with pytest.raises(ValueError):
        search.dense_topk(spark.createDataFrame([], "id int, embedding array<double>"), queries)
    assert sum(b.count() for b in search.query_blocks(queries, 3)) == 5


@pytest.mark.parametrize("name", ["flagship_hybrid_search", "dense_topk", "lexical_topk_bm25", "rrf_weighted", "recall_misses"])
def test_queries_beyond_a_block(spark, sf_dir, monkeypatch, name):
    query = {**search_queries.QUERIES, **evaluation_queries.QUERIES}[name]
    want = sorted(map(str, query(spark, sf_dir).collect()))
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(search, "query_blocks", lambda queries, _: [queries.where(F.col("qid").cast("long") % 100 == i) for i in (0, 25, 50, 75)])
    assert sorted(map(str, query(spark, sf_dir).collect())) == want and want


@pytest.mark.parametrize(("text", "hits"), [
    ("alpha", [0, 1]), ("alpha beta", [0]), ('"beta gamma"', [0]), ('"gamma beta"', []), ("beta OR delta", [0, 1, 2]), ("alpha -beta", [1]), ("-alpha", []), ("", []),
    ('alpha OR "x y" -delta', [0]),
])
def test_websearch(spark, text, hits):
    texts = [["alpha", "beta", "gamma"], ["alpha", "delta"], ["delta"]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t array<string>")
    assert [r.i for r in df.where(search.lexical_match(F.col("t"), search.parse_websearch(text))).orderBy("i").collect()] == hits


def test_clamp():
    assert [search.clamp_k(k) for k in (None, 0, 3, 99)] == [(6, 8), (1, 8), (3, 8), (50, 50)]


@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.sampled_from([0.5, 0.9, 0.95, 0.29]))
def test_percentile_rules_differ_only_where_they_should(values, p):
    ordered, n = sorted(values), len(values)
    ceil_rank = max(1, -(-int(round(p * 10000)) * n // 10000))
    floor_place = min(n - 1, int(n * p))
    assert ordered[ceil_rank - 1] <= ordered[floor_place]


def test_percentiles(spark):
    for n in (1, 2, 5, 10, 20, 40, 100):
        df = spark.range(1, n + 1).withColumnRenamed("id", "v")
        for p in (0.5, 0.9, 0.95):
            got = df.agg(telemetry.pct_ceil("v", p).alias("c"), telemetry.pct_floor("v", p).alias("f")).first()
            exact = int(round(p * 100)) * n
            assert got.c == max(1, -(-exact // 100)) and got.f == min(n - 1, int(n * p)) + 1, (n, p)
    empty = spark.range(0).withColumnRenamed("id", "v")
    assert empty.agg(telemetry.pct_ceil("v", 0.5)).first()[0] is None


def test_spend_edges(spark):
    calls = spark.createDataFrame([("free-fast", 100, 10, 150, 0.0, None), ("unknown", 100, 10, 20, 5.0, True)],
                                  "model_group string, prompt_tokens long, completion_tokens long, cached_tokens long, spend double, cache_hit boolean")
    prices = spark.createDataFrame([("free", 0.0, 0.0)], "group string, price_in double, price_out double")
    priced = telemetry.with_prices(calls, prices)
    total = telemetry.spend_metrics(priced).first()
    assert (total.calls, total.no_cache, total.savings, total.savings_pct) == (2, 0.0, 0.0, 0.0)
    assert telemetry.uncached_stats(priced).first().total == 80
    hits = telemetry.cache_hits(calls).first()
    assert (hits.hits, hits.misses, hits.unknown, hits.hit_rate) == (1, 0, 1, 1.0)
    none = telemetry.spend_metrics(priced.limit(0)).first()
    assert none.calls == 0 and none.hit_rate == 0.0 and telemetry.uncached_stats(priced.limit(0)).first().p95 == 0


def test_event_lines(spark):
    lines = ["", "  ", "noise", "[1]", '{"event": "other"}', '{"event": "rag_search"}', '{"event": "rag_search", "latency_ms": "x"}', '{"event": "rag_search_staleness", "stale": true}']
    got = telemetry.parse_events(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(r.type for r in got) == ["malformed"] * 4 + ["search", "staleness"]
    search_event = next(r for r in got if r.type == "search")
    assert (search_event.slo_ms, search_event.status, search_event.latency_ms) == (200.0, "ok", 0.0)


QUESTION = "id string, source string, expect_paths array<string>, expect_symbols array<string>, expect_kinds array<string>, should_refuse boolean, targets int"


def test_quality(spark):
    questions = spark.createDataFrame([
        ("hit", "curated", ["p", "q"], [], ["doc"], False, 2), ("miss", "curated", ["z"], [], [], False, 1), ("symbol", "external", ["p"], ["s"], [], False, 1),
        ("refused", "external", [], [], [], True, 0), ("answered", "external", [], [], [], True, 0),
    ], QUESTION)
    hits = spark.createDataFrame([("hit", 1, "x", None, "doc"), ("hit", 2, "p", None, "doc"), ("hit", 3, "q", None, "code"), ("miss", 1, "x", None, "doc"), ("symbol", 1, "p", None, "doc"),
                                  ("symbol", 2, "p", "s", "doc"), ("answered", 1, "x", None, "doc")], "id string, pos int, path string, symbol string, kind string")
    per = evaluation.per_question(questions, hits)
    by = {r.id: r for r in per.collect()}
    assert (by["hit"].rank, by["hit"].covered, by["hit"].kind_group) == (2, 1, "doc") and by["miss"].rank is None and by["symbol"].rank == 2
    assert by["refused"].refused and not by["answered"].refused
    overall = evaluation.quality(per).where("dimension = 'overall'").first()
    assert (overall.n, overall.recall_1, overall.recall_3, overall.refusal) == (5, 0.2, 0.6, 0.5) and overall.mrr == round((0.5 + 0 + 0.5) / 3, 4)
    assert sorted(r.id for r in evaluation.misses(per).collect()) == ["answered", "miss"]
    assert not evaluation.check_gate(evaluation.quality(per).where("dimension = 'overall'")).first().passed


def test_gate_edges(spark):
    metric = lambda v: evaluation.check_gate(spark.createDataFrame([(v,)], "recall_8 double")).first().passed
    assert metric(0.9) and not metric(0.8999) and not metric(None) and evaluation.gate_threshold() == 0.9
    lines = spark.createDataFrame([("# c",), ("",), ('{"id": "a"}',)], "value string")
    assert evaluation.load_questions(lines).count() == 1
    with pytest.raises(Exception, match="not a question"):
        evaluation.load_questions(spark.createDataFrame([("oops",)], "value string")).collect()
