import re
from collections import Counter

import duckdb
import pytest

from tidemark.llm import quality_rules as rules

FIELDS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def by_hand(text):
    """The base measures, window by window."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    under = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(under),
            n < 50 or 100 * len(under) > 50 * n)


PROSE = " ".join(f"the w{i} of it and x{i}" for i in range(20))
TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "one", "a b c", "a b c a b c", "a a a a", "x y z x y z x y", "é ü 😀 \x01   word", PROSE,
    PROSE + "\n#tag $5 100% <b> & | *", "same line\nsame line\n\n \n other\nsame line", "a\n\nb\r\na\r\na", "word " * 30_000,
    " ".join(f"{i % 900} {i}" for i in range(30_000)), " ".join(str(i % 700) for i in range(5_000)), "\n".join(["- point of the day"] * 60),
    PROSE.upper(), PROSE + "!" * 200, "\n".join(f"the e{i} of it{i} c{i} x{i} and y{i} ..." for i in range(30)),
]


def run(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept string, words string")
    return frame, rules.apply_rules(frame)


def test_base_measures_agree_with_counting_by_hand(spark):
    found = {r.doc_id: r for r in run(spark, [(i, t, "x", "y", "z") for i, t in enumerate(TEXTS)])[1].collect()}
    for i, text in enumerate(TEXTS):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == by_hand(text), text
        assert not (r.base_failed and r.kept)


def test_rules_reject_what_the_table_says(spark):
    kept = {r.doc_id: (r.kept, set(r.broken_rules)) for r in run(spark, [(i, t, None, None, None) for i, t in enumerate(TEXTS)])[1].collect()}
    by_text = {t: kept[i] for i, t in enumerate(TEXTS)}
    assert by_text[PROSE] == (True, set()) and by_text[None] == by_text[""]
    assert by_text[PROSE + "!" * 200][1] == {"shouting"} and "stop_words" in by_text[PROSE.upper()][1]
    assert "bullets" in by_text["\n".join(["- point of the day"] * 60)][1]
    assert by_text["\n".join(f"the e{i} of it{i} c{i} x{i} and y{i} ..." for i in range(30))][1] == {"ellipses"}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    frame, found = run(spark, [(None, PROSE, None, None, None), (7, PROSE, None, None, None), (7, PROSE, None, None, None), (7, "other", None, None, None)])
    rows = found.select("doc_id", "n_words", "kept").collect()
    assert sorted(((r.doc_id or -1, r.n_words, r.kept) for r in rows)) == [(-1, 120, True), (7, 1, False), (7, 120, True), (7, 120, True)]
    assert rules.keep_good(frame).count() == 3 and rules.keep_good(frame).columns == frame.columns
    assert run(spark, [])[1].collect() == []


def test_a_table_of_own_rules(spark):
    frame, _ = run(spark, [(1, PROSE, None, None, None), (2, PROSE + " $", None, None, None)])
    own = (rules.Rule("no_symbols", "n_symbols", most=0),)
    assert {r.doc_id: r.broken_rules for r in rules.apply_rules(frame, own).collect()} == {1: [], 2: ["no_symbols"]}
    with pytest.raises(ValueError, match="unknown"):
        rules.judge(frame["text"], (rules.Rule("odd", "n_odd", most=0),))
    with pytest.raises(ValueError, match="no limit"):
        rules.judge(frame["text"], (rules.Rule("odd", "n_words"),))


def test_one_projection_without_user_functions(spark):
    plan = run(spark, [(1, "x", None, None, None)])[1]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan


def test_sql_says_the_same(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = sorted(con.execute(f"SELECT {', '.join(FIELDS)} FROM ({rules.rules_sql()})").fetchall())
    assert sorted(map(tuple, rules.apply_rules(frame).select(*FIELDS).collect())) == expected
