"""Vectors by cell and stored postings, against exact lists and plain matching."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.operators import search
from tidemark.operators.vector_cells import VectorCells, learn_centers, recall, unit
from tidemark.sources import generations, postings
from tidemark.sources.postings import Postings, refreshed, write_segment

WORDS = ["alpha", "beta", "gamma", "delta", "rare", "the", "of"]


def texts(seed, n, start=0):
    draw = random.Random(seed)
    return [(start + i, " ".join(draw.choices(WORDS, [5, 4, 3, 2, 0.2, 9, 7], k=draw.randrange(30)))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, content string").select("id", *[F.lit(None).cast("string").alias(c) for c in search.COLUMNS if c not in ("id", "content")], "content")


QUERIES = [(1, ["alpha"]), (2, ["the", "of"]), (3, ["rare", "the", "rare"]), (4, ["absent", "the"]), (5, ["gamma", "delta", "beta"]), (6, []), (7, ["rare"])]


def asked(spark):
    return spark.createDataFrame(QUERIES, "qid long, terms array<string>")


def ranked(df):
    return sorted(map(tuple, df.select("qid", "id", "rank", "bm25").collect()))


@pytest.mark.parametrize("n", [3, 50])
def test_stored_lists_are_the_plain_ones_and_skip_blocks(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(postings, "BLOCK", 8)
    monkeypatch.setattr(postings, "HEAD", 1)
    rows = frame(spark, [*texts(1, 600), (9_000, ""), (9_001, None)])
    write_segment(rows, f"{tmp_path}/s")
    assert ranked(Postings(spark, [f"{tmp_path}/s"]).topk(asked(spark), n)) == ranked(search.lexical_topk(rows, asked(spark), n))
    blocks = Postings(spark, [f"{tmp_path}/s"]).blocks(WORDS).collect()
    assert all(b.n <= 8 and b.ids == sorted(b.ids) and (b.first_id, b.last_id) == (b.ids[0], b.ids[-1]) for b in blocks) and len(blocks) > 100
    assert all(b.max_tf == max(map(len, b.positions)) and b.min_length == min(b.lengths) for b in blocks)


def test_only_the_asked_terms_are_read(spark, tmp_path):
    write_segment(frame(spark, texts(2, 50)), f"{tmp_path}/s")
    plan = Postings(spark, [f"{tmp_path}/s"]).blocks(["alpha"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(term,alpha)" in plan


@pytest.mark.parametrize("text", ["alpha", '"the of"', 'beta OR rare "of the" -gamma', '"alpha beta gamma"', "alpha OR beta OR rare -delta", "-alpha", "", 'alpha "alpha alpha"'])
def test_websearch_from_postings(spark, tmp_path, text):
    rows, query = frame(spark, texts(3, 300)), search.parse_websearch(text)
    write_segment(rows.where("id < 150"), f"{tmp_path}/a")
    write_segment(rows.where("id >= 150"), f"{tmp_path}/b")
    found = sorted(r.id for r in Postings(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]).match(query).collect())
    assert found == sorted(r.id for r in rows.where(search.lexical_match(tokens("content"), query)).select("id").collect())


def test_an_index_follows_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "MOST_SEGMENTS", 3)
    index, counts = Postings(spark), []
    first, second = texts(4, 200), texts(5, 60, start=1_000)
    steps = [first, first[20:] + second, first + second[:30], first + second + texts(6, 5, 2_000), second]
    for i, rows in enumerate(steps):
        index = refreshed(index, frame(spark, rows), f"{tmp_path}/s{i}", f"{tmp_path}/d{i}")
        counts.append((len(index.segments), index.dead is not None))
        assert ranked(index.topk(asked(spark), 20)) == ranked(search.lexical_topk(frame(spark, rows), asked(spark), 20))
        query = search.parse_websearch('"the of" -rare')
        assert sorted(r.id for r in index.match(query).collect()) == sorted(r.id for r in frame(spark, rows).where(search.lexical_match(tokens("content"), query)).collect())
    assert counts == [(1, False), (2, True), (2, True), (3, False), (1, False)]


def test_no_rows(spark, tmp_path):
    write_segment(frame(spark, []), f"{tmp_path}/s")
    index = Postings(spark, [f"{tmp_path}/s"])
    assert index.topk(asked(spark)).count() == 0 and index.match(search.parse_websearch("alpha")).count() == 0 and Postings(spark).topk(asked(spark)).count() == 0
    cells = VectorCells.write(spark.createDataFrame([], "id long, embedding array<float>"), f"{tmp_path}/c")
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "qid long, qvec array<float>")
    assert cells.topk(queries).count() == 0 and cells.topk(queries, n_probe=2).count() == 0 and cells.probes_for(queries) == 0


def vectors(seed, n, clusters):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(clusters, 16))[rng.integers(clusters, size=n)] + 0.2 * rng.normal(size=(n, 16))).astype(np.float32)


def test_cells_find_near_rows_and_all_cells_find_all(spark, tmp_path):
    x = vectors(1, 1_500, 30)
    rows = [(i, v.tolist(), "r" if i % 2 else "s") for i, v in enumerate(x)]
    odd = [(-1, None, "r"), (-2, [0.0] * 16, "r"), (-3, [1.0, 2.0], "r"), (-4, [math.nan] * 16, "r"), (-5, [None] * 16, "r")]
    chunks = spark.createDataFrame(rows + odd, "id long, embedding array<float>, repo string")
    queries = spark.createDataFrame([(i, x[i].tolist()) for i in range(0, 1_500, 50)] + [(-9, None), (-8, [0.0] * 16), (-7, [1.0])], "qid long, qvec array<float>")
    cells = VectorCells.write(chunks, f"{tmp_path}/c")
    exact = search.dense_topk(chunks.where("id >= 0"), queries.where("qid >= 0"), 10)
    shown = lambda df: sorted(map(tuple, df.select("qid", "id", "rank", "dist", "repo").collect()))
    assert shown(cells.topk(queries, 10)) == shown(exact)
    few = cells.topk(queries, 10, n_probe=3)
    sums = recall(few, exact).agg(F.sum("wanted"), F.sum("got")).first()
    assert sums[0] == 300 and sums[1] >= 270
    assert 1 <= cells.probes_for(queries, 0.9, 10) <= 3 and cells.probes_for(queries, 0.2, 10) == 1
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan or "PartitionFilters: [isnotnull(cell" in plan


def test_centers_are_units_even_of_copies():
    centers = learn_centers(np.ones((50, 3)), 8)
    assert centers.shape == (8, 3) and np.allclose(np.sqrt((centers**2).sum(1)), 1) and np.allclose(unit(np.zeros((1, 2))), 0)


def live(spark, files):
    return spark.createDataFrame([(p, "doc", "markdown", str(hash(c)), c) for p, c in files.items()], "path string, kind string, lang string, blob_sha string, content string")


def letters(texts):
    return [[1.0 + t.count("a"), 1.0 + t.count("e")] for t in texts]


def test_an_indexed_store_keeps_its_postings(spark, tmp_path):
    store = generations.Store(spark, f"file://{tmp_path}/s", generations.Profile("letters", 2), indexed=True)
    plain = generations.Store(spark, f"file://{tmp_path}/p", generations.Profile("letters", 2))
    queries = spark.createDataFrame([(1, [1.0, 9.0], ["bee"]), (2, [9.0, 1.0], ["banana"]), (3, [1.0, 1.0], ["gone"])], "qid int, qvec array<float>, terms array<string>")
    trees = [{"a.md": "a banana", "b.md": "the bee", "g.md": "gone", "h.md": "here"}, {"a.md": "a banana", "b.md": "a bee and a bee", "n.md": "new bee", "h.md": "here", "i.md": "i"}]
    for i, tree in enumerate(trees):
        for s in (store, plain):
            s.sync(live(spark, tree), "r", f"h{i}", call=letters)
        hits = [sorted(map(tuple, s.search(queries).select("qid", "pos", "path", "score", "lex_rank").collect())) for s in (store, plain)]
        assert hits[0] == hits[1] and any(h[4] for h in hits[0])
    assert store.postings() is not None and plain.postings() is None
    kept = {p.name for p in (tmp_path / "s" / "chunks_letters-postings").iterdir()}
    assert kept == {s.rsplit("/", 1)[1] for s in (*store.manifest()["segments"], store.manifest()["dead"]) if s}


def test_rows_without_vectors_get_them_and_contents_are_embedded_once(spark, tmp_path):
    profile, asked_for = generations.Profile("letters", 2), f"{tmp_path}/asked"
    store = generations.Store(spark, f"file://{tmp_path}/s", profile)
    with pytest.raises(ValueError, match="callable"):
        store.sync(live(spark, {"a.md": "one"}), "r")
    files = {"a.md": "one", "b.md": "one", "c.md": "two"}
    store.sync(live(spark, files), "r", call=letters)
    rows = store.rows().drop("gen").withColumn("embedding", F.when(F.col("path") != "c.md", F.col("embedding")))
    rows.write.mode("overwrite").parquet(f"{tmp_path}/bare")
    spark.read.parquet(f"{tmp_path}/bare").write.mode("overwrite").parquet(store._folder(1))

    def logged(texts):
        with open(asked_for, "a") as log:
            log.writelines(t + "\n" for t in texts)
        return letters(texts)

    store.sync(live(spark, files | {"d.md": "three", "e.md": "three"}), "r", call=logged)
    assert store.rows().where("embedding IS NULL").count() == 0 and store.rows().count() == 5
    assert sorted(open(asked_for).read().split()) == ["three", "two"]


def test_a_run_stopped_anywhere_goes_on_and_readers_see_whole_generations(spark, tmp_path, monkeypatch):
    class Stop(Exception):
        pass

    trees = [{"a.md": "one", "b.md": "two"}, {"a.md": "one", "b.md": "changed", "c.md": "three"}, {"a.md": "one", "b.md": "again", "c.md": "three"}]
    stops = (("_append", 1), ("_append", 2), ("_write_manifest", 2), ("_drop_dead", 1), ("_write_manifest", 3), ("_reindexed", 1), ("collect_old", 1))
    for method, when in stops:
        store = generations.Store(spark, f"file://{tmp_path}/{method}{when}", indexed=True, lease=-1.0)
        store.sync(live(spark, trees[0]), "r", "h0")
        real, calls = getattr(generations.Store, method), [0]

        def stopping(self, *args, real=real, calls=calls, **named):
            calls[0] += 1
            if calls[0] == when:
                raise Stop
            return real(self, *args, **named)

        with monkeypatch.context() as patch:
            patch.setattr(generations.Store, method, stopping)
            try:
                store.sync(live(spark, trees[1]), "r", "h1")
            except Stop:
                pass
        seen = sorted((r.path, r.content) for r in store.rows().collect())
        assert seen in [sorted(t.items()) for t in trees[:2]]
        store.sync(live(spark, trees[2]), "r", "h2")
        assert sorted((r.path, r.content) for r in store.rows().collect()) == sorted(trees[2].items())
        assert all(ok for ok, _ in generations.verify(store)) and len(store.generations()) == 1


def test_a_lease_that_ran_out_is_taken_over_and_fenced(spark, tmp_path):
    late, other = (generations.Store(spark, f"file://{tmp_path}/s", lease=lease) for lease in (-1.0, 60.0))
    with pytest.raises(generations.Locked, match="took over"), late.lock():
        with other.lock():
            with pytest.raises(generations.Locked, match="exists"), generations.Store(spark, f"file://{tmp_path}/s").lock():
                pass
        late._write_manifest(head="stolen")
    assert other.manifest()["head"] is None
    with other.lock():
        other._write_manifest(head="mine")
    assert other.manifest()["head"] == "mine"
