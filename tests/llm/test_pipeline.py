import random
import shutil

import corpus_pipeline
import duckdb
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.test_near_duplicates import brute_force as components
from tests.llm.test_substring_dedup import brute_force as cut
from tidemark.llm import language_id, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed):
    pick = random.Random(seed)
    words = {"en": "the and of that with on in over thing other".split(), "de": "der und nicht ein sich auf über ding ander".split()}
    make = lambda lang, n: " ".join(pick.choice(words[lang]) + pick.choice(["", "", "er", "ing", "ung"]) for _ in range(n))
    shared, rows = make("en", 60), []
    for i in range(80):
        lang = pick.choice(["en", "de"])
        text = make(lang, pick.randint(5, 120)) + (f"\n{shared}\n{make(lang, 15)}" if i % 5 == 0 else "")
        rows.append((i, text, lang if i % 7 else None, pick.choice(["a", "a", "b", None]), len(text)))
    rows += [(100 + i, rows[i][1], *rows[i][2:]) for i in range(10)]
    rows += [(200, None, "en", "a", None), (201, "12 34 !!", None, "a", 8), (202, "", "de", "b", 0), (None, "the and of", "en", "a", 10), rows[3]]
    return rows


def test_run_against_brute_force(spark, tmp_path):
    rows = corpus(1)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.text, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect() if r.doc_id is not None)

    prototypes = language_id.learn_prototypes(spark.createDataFrame(rows, SCHEMA))
    space = language_id.TrigramSpace()
    kept = []
    for r in rows:
        vector = space.text(r[1])
        best = max((float(p @ vector) for p in prototypes.values()), default=0) if vector is not None else 0
        if r[0] is None or vector is not None and best >= corpus_pipeline.LEAST_SCORE:
            kept.append(r)
    groups = {d: c for d, _, c in components(kept, 5, 80)}
    kept = list({r[0]: r for r in kept if r[0] is None or groups[r[0]] == r[0]}.values())
    texts = cut(kept)
    kept = [(r[0], texts.get((r[0], r[1]), r[1]), *r[2:]) for r in kept]
    kept = [r for r in kept if r[1].strip()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", kept)
    chosen = {d for d, k in con.sql(f"SELECT doc_id, kept FROM ({mixing.calibrate_sql()})").fetchall() if k}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r[0], r[1], len(library.encode(r[1], add_special_tokens=False).ids)) for r in kept if r[0] is not None and r[0] in chosen)
    assert got == want and 5 < len(got) < len(kept)


def test_stages_keep_the_columns_and_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.createDataFrame(corpus(2), SCHEMA)
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == empty.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    shutil.rmtree(tmp_path)


def test_clean_documents_stay_in_the_language_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert corpus_pipeline.language_stage(spark, docs, "").count() == docs.count()


def test_of_two_texts_under_one_id_each_is_judged_by_itself(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    clean = docs.where("lang = 'en' AND length(text) > 500").select("text").first()[0]
    rows = [(10**6, clean, None, "a", 1), (10**6, "12 34 56", None, "a", 2), (None, clean + " more", None, "a", 3), (None, "77 88", None, "a", 4), (10**6 + 1, None, None, "a", 5)]
    left = corpus_pipeline.language_stage(spark, docs.unionByName(spark.createDataFrame(rows, SCHEMA)), "")
    assert sorted(r.n_chars for r in left.where(f"doc_id IS NULL OR doc_id >= {10**6}").collect()) == [1, 3]


def test_gibberish_and_unlearnt_languages_go(spark):
    pick = random.Random(7)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    make = lambda letters, n: "".join(pick.choice(letters) for _ in range(n))
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz    ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
                 "".join(map(chr, range(0x430, 0x450))) + "     ", "".join(map(chr, range(0x4E00, 0x5E00)))]
    junk = [make(a, n) for a in alphabets for n in (100, 200, 400, 1000) for _ in range(10)]
    junk.append("Все люди рождаются свободными и равными в своём достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.")
    planted = spark.createDataFrame([(10**6 + i, t, None, "a", len(t)) for i, t in enumerate(junk)], SCHEMA)
    left = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs.unionByName(planted), "").select("doc_id").collect()}
    assert len([i for i in left if i >= 10**6]) <= 0.1 * len(junk) and 10**6 + len(junk) - 1 not in left
    assert len([i for i in left if i < 10**6]) == docs.count()
