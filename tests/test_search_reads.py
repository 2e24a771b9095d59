"""What the queries of search and evaluation read, and how often."""

import pytest

from tidemark.operators import search, toplists
from tidemark.plans import evaluation_queries, search_queries


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["hit_projection", "provenance_mix", "rrf_weighted", "search_gate", "flagship_hybrid_search"])
def test_texts_of_questions_are_read_once_for_both_lists(spark, sf_dir, monkeypatch, name):
    """The lists read the written questions, so neither of them joins documents and vectors again."""
    plans, staged = {}, toplists.stage
    monkeypatch.setattr(toplists, "stage", lambda df, name: plans.setdefault(name, plan(df)) and staged(df, name))
    assert search_queries.QUERIES[name](spark, sf_dir).count() > 0
    assert not any("Join" in plans[part] for part in ("asked", "asked-terms"))


@pytest.mark.parametrize("name", ["dedupe_hits", "search_shown"])
def test_hits_are_told_apart_by_heads_cut_where_texts_are_read(spark, sf_dir, name):
    assert "substring(text#" in plan(search_queries.QUERIES[name](spark, sf_dir))


def test_recall_of_cells_makes_the_exact_lists_once(spark, sf_dir, monkeypatch):
    seen, dense = [], toplists.dense
    monkeypatch.setattr(toplists, "dense", lambda *given: seen.append(len(given)) or dense(*given))
    assert search_queries.dense_cells_recall(spark, sf_dir).first().reached
    assert seen == [3, 4]  # the exact lists, and those of the probed cells


@pytest.mark.parametrize("name", ["per_question", "recall_overall", "recall_breakdown", "recall_gate", "recall_misses"])
def test_questions_are_made_once(spark, sf_dir, name):
    assert "arg_min" not in (made := plan(evaluation_queries.QUERIES[name](spark, sf_dir))).lower() and "min_by" not in made.lower()


def test_hits_keep_whole_contents_unless_others_are_joined(spark, sf_dir):
    c, q = search_queries.chunks(spark, sf_dir), search_queries.search_queries(spark, sf_dir)
    whole = {(r.qid, r.pos): r for r in search.search(c, q).collect()}
    heads = {(r.qid, r.pos): r for r in search.search(c, q, joined=search_queries.chunks(spark, sf_dir, 9)).collect()}
    assert whole.keys() == heads.keys() and all(r.content[:9] == heads[k].content and r.id == heads[k].id for k, r in whole.items())
    assert max(len(r.content) for r in whole.values()) > 9
