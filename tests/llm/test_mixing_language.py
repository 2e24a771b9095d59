import random
import re
import zlib
from collections import defaultdict

import corpus_pipeline
import duckdb
import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language_id, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, topic int, prob string, held_out int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 0, 7, "p", 1) for r in rows], SCHEMA)


def some_rows(n, seed):
    pick = random.Random(seed)
    rows = [
        (i, pick.choice(["ab cd", "line\n" * 9, "word " * 60, "x" * 500 + "\n" + "y" * 500]), pick.choice(["en", "en", "de", None]),
         pick.choice(["hot", "hot", "hot", "a", "b", None]))
        for i in range(n)
    ]
    return [*rows, (n, None, "en", "a"), (n + 1, "", None, None), (None, "no id", "en", "a"), rows[0], rows[0]]


def test_margins_reach_their_targets(spark):
    got = mixing.calibrate(docs(spark, some_rows(300, 4))).toPandas()
    assert len(got) == 305 and got.prob.max() == 1 and (got.prob > 0).all()
    weight = got.tokens * got.factor
    for margin in mixing.MARGINS:
        size = got.groupby(margin).tokens.sum()
        pull = size ** mixing.POWERS[margin]
        want = pull / pull.sum() * size.sum()
        assert np.allclose(weight.groupby(got[margin]).sum(), want, rtol=0.01), margin


def test_sql_says_the_same(spark):
    rows = some_rows(200, 5)
    got = mixing.calibrate(docs(spark, rows)).withColumns({c: F.round(c, 9) for c in ("factor", "prob", "residual")})
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    want = con.sql(mixing.calibrate_sql()).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_mix_keeps_whole_rows(spark):
    df = docs(spark, some_rows(300, 6))
    kept = mixing.mix(df)
    assert kept.columns == df.columns
    by = {r.doc_id: r.kept for r in mixing.calibrate(df).collect()}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in some_rows(300, 6) if by[r[0]])
    assert 0 < kept.count() < 305
    assert mixing.mix(df.limit(0)).count() == 0


def test_one_rare_document_leaves_the_others(spark):
    pick = random.Random(9)
    rows = [(i, "word " * pick.randint(40, 400), pick.choice(["en", "en", "en", "de"]), pick.choice(["hot", "hot", "a", "b"])) for i in range(2000)]
    rows += [(2000, "word " * 40, "en", "its own"), (2001, "", None, "a")]
    kept = corpus_pipeline.mixing_stage(spark, docs(spark, rows), "").select("doc_id", "source", F.length("text").alias("n")).collect()
    total = sum(len(r[1]) for r in rows)
    share = sum(r.n for r in kept) / total
    assert abs(share - mixing.KEEP) < 0.03 and {2000, 2001} <= {r.doc_id for r in kept}
    size = {s: sum(len(r[1]) for r in rows if r[3] == s) for s in ("hot", "a", "b")}
    pulls = sum(n ** mixing.POWERS["source"] for n in size.values())
    for s, n in size.items():
        got, want = sum(r.n for r in kept if r.source == s), n ** mixing.POWERS["source"] / pulls * mixing.KEEP * total
        assert abs(got / want - 1) < 0.2, s


def test_given_shares_and_a_budget(spark):
    rows = some_rows(400, 12)
    shares = {"source": {"hot": 0.2, "a": 0.5, "nowhere": 0.1}, "lang": {"de": 3.0, "en": 1.0}}
    got = mixing.calibrate(docs(spark, rows).withColumn("topic", F.col("topic") + F.col("doc_id") % 2), shares=shares, topic=F.col("topic"), tokens=F.length("text")).toPandas()
    assert set(got.topic) == {"7", "8", mixing.NONE} and got.residual.nunique() == 1
    # Raking by hand, with the shares' rules: what is left goes to the values without a share; those of lang leave none.
    cell = got.groupby(["source", "lang", "topic"]).tokens.sum()
    total, weight = cell.sum(), cell.copy()
    size = {m: cell.groupby(m).sum() for m in mixing.MARGINS}
    pull = size["topic"] ** mixing.POWERS["topic"]
    rest = size["source"].drop(["hot", "a"])
    want = {"source": {"hot": 0.2 * total, "a": 0.5 * total, **(0.2 * total * rest / rest.sum()).to_dict()},
            "lang": {"de": 0.75 * total, "en": 0.25 * total, mixing.NONE: 0.0}, "topic": (pull / pull.sum() * total).to_dict()}
    for _ in range(int(got.sweeps.iloc[0])):
        for m in mixing.MARGINS:
            now = weight.groupby(m).sum()
            weight = weight * weight.index.get_level_values(m).map(lambda v: want[m][v] / now[v] if now[v] else 1.0).to_numpy()
    factor = (weight / cell).rename("by_hand").reset_index()
    both = got.merge(factor, on=list(mixing.MARGINS))
    assert np.allclose(both.factor, both.by_hand) and np.allclose(both.prob, both.by_hand / both.by_hand.max())
    few = mixing.calibrate(docs(spark, rows), budget=3000).toPandas()
    assert abs((few.tokens * few.prob).sum() - 3000) < 1 and few.prob.max() <= 1
    everything = mixing.calibrate(docs(spark, rows), budget=10**9).toPandas()
    assert np.allclose(everything.prob, 1)


def test_fill_sets_full_parts_aside(spark):
    parts = spark.createDataFrame([(1.0, 10.0), (4.0, 2.0), (100.0, 2.0)], "size double, pull double")
    for total, want in ((0.5, 0.5 / 14), (5.0, 1.0), (25.0, 10.0)):
        assert abs(mixing.fill(parts, total) - want) < 1e-9


def test_rake_leaves_values_without_a_target(spark):
    cells = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, base double")
    target = spark.createDataFrame([("a", 5.0)], "source string, target double")
    assert {tuple(r) for r in mixing.rake(cells, {"source": target}, 1).select("source", "weight").collect()} == {("a", 5.0), ("b", 3.0)}


def test_trigram_vectors_bind_permuted_letters():
    space = language_id.TrigramSpace(64, 1)
    abc = space.trigram(97 << 42 | 98 << 21 | 99)
    want = np.array([space.letter(97)[i - 2] * space.letter(98)[i - 1] * space.letter(99)[i] for i in range(64)])
    assert (abc == want).all()
    total = defaultdict(int)
    for gram in ("\0ab", "abc", "bc\0", "c\0d", "\0d\0"):
        total[tuple(map(ord, gram))] += 1
    plain = sum(n * np.roll(space.letter(a), 2) * np.roll(space.letter(b), 1) * space.letter(c) for (a, b, c), n in total.items())
    assert np.allclose(space.text("ABC, d!"), plain / np.linalg.norm(plain))


def test_trigram_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(language_id, "MEMO_TRIGRAMS", 30)
    small, large = language_id.TrigramSpace(32, 1), language_id.TrigramSpace(32, 1)
    for text in ("some words that go on", "and other words", "some words that go on"):
        vector = small.text(text)
        assert len(small.keys) <= 30
        monkeypatch.setattr(language_id, "MEMO_TRIGRAMS", 10_000)
        assert np.allclose(vector, large.text(text))
        monkeypatch.setattr(language_id, "MEMO_TRIGRAMS", 30)


def test_odd_rows(spark):
    rows = [(i, "the and of that with " * 5, "en", "a") for i in range(6)] + [(i, "der und nicht ein sich " * 5, "de", "a") for i in range(6, 12)]
    rows += [(20, None, "en", "a"), (21, "", "de", "a"), (22, "12 !! 34", None, "a"), (None, "the and of", "en", "a"), (1, rows[1][1], "en", "a")]
    got = {r.doc_id: r for r in language_id.predict_languages(docs(spark, rows)).collect()}
    assert {got[i].lang_pred for i in range(6)} == {"en"} and {got[i].lang_pred for i in range(6, 12)} == {"de"}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (20, 21, 22))
    assert got[None].lang_pred == "en" and not got[None].held_out
    assert language_id.predict_languages(docs(spark, rows).limit(0)).count() == 0
    unlabelled = docs(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.predict_languages(unlabelled).collect()} == {"und"}


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.predict_languages(documents).where("held_out").join(documents.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred = lang").count() >= 0.97 * got.count()


def plain_prediction(rows, dimensions=language_id.DIMENSIONS):
    """Prototypes and cosines from the definition, trigram by trigram, without memos or batches."""
    space, letters = language_id.TrigramSpace(dimensions), language_id.is_letter()

    def vector(text):
        marked = "".join(c if letters[ord(c)] else "\0" for c in (text or "").lower())
        total = np.zeros(dimensions)
        padded = re.sub("\0+", "\0", f"\0{marked}\0")
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            total += np.roll(space.letter(ord(a)), 2) * np.roll(space.letter(ord(b)), 1) * space.letter(ord(c))
        size = np.sqrt(total @ total)
        return total / size if len(padded.strip("\0")) and size > 0 else None

    learnt, out = {}, set()
    held = lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
    for doc_id, text, lang in {r[:3] for r in rows}:
        if lang is not None and doc_id is not None and not held(doc_id) and vector(text) is not None:
            learnt[lang] = learnt.get(lang, 0) + vector(text)
    for doc_id, text, _ in {r[:3] for r in rows}:
        v, best = vector(text), []
        if v is not None:
            best = sorted((-round(float(p @ v / np.sqrt(p @ p)), 9), lang) for lang, p in learnt.items())
        out.add((doc_id, held(doc_id), best[0][1] if best else "und", round(min(1, max(0, -best[0][0])), 6) if best else 0.0))
    return out


def test_rows_against_the_definition(spark):
    pick, words = random.Random(3), {"en": "the and of that with".split(), "de": "der und nicht ein sich".split(), "fr": "le la que dans vous été".split()}
    rows = [(i, " ".join(pick.choice(words[lang]) for _ in range(pick.randint(1, 30))), lang if i % 4 else None, "a") for i in range(90) for lang in [pick.choice(list(words))]]
    rows += [(200, None, "en", "a"), (201, "12 !!", "de", "a"), (202, "the of", None, "a"), (202, "der und sich", "de", "a"), (202, "le la", "fr", "a"),
             (203, "und " * 30_000, "de", "a"), (203, "und " * 30_000, "de", "a"), (None, "que dans", "fr", "a")]
    got = {(r.doc_id, r.held_out, r.lang_pred, round(r.score, 6)) for r in language_id.predict_languages(docs(spark, rows)).collect()}
    assert got == plain_prediction(rows)


def test_a_row_teaches_its_own_language_only(spark):
    rows = [(3 * i, "the and of that with " * 3, "en", "a") for i in range(20)] + [(3 * i, "der und nicht ein sich " * 3, None, "a") for i in range(20)]
    with_nulls, alone = (language_id.learn_prototypes(docs(spark, r)) for r in (rows, rows[:20]))
    assert np.allclose(with_nulls["en"], alone["en"]) and list(with_nulls) == ["en"]


def test_rare_languages_are_learnt_whatever_the_cap(spark):
    rows = [(1000 * k + i, f"{'abcdefghijkl'[k]}oru mina tel " * 3, f"l{k:02}", "a") for k in range(12) for i in range(400 if k else 12)]
    df = docs(spark, rows)
    for in_all in (60, 24):
        assert sorted(language_id.learn_prototypes(df, 30, in_all, 64)) == [f"l{k:02}" for k in range(12)]
