import random

import numpy as np
import pytest

from tidemark.llm import near_duplicates as nd
from tidemark.llm.components import connected_components

SCHEMA = "doc_id long, text string, rep long, node string, component string"


def brute_force(rows, n, percent):
    sets = []
    for doc_id, text, *_ in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
        w = [x for x in __import__("re").split("[\x20\x09-\x0d]+", w) if x]
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        sets.append((doc_id, grams))
    forest = nd.Forest(len(sets))
    for i, (a, s) in enumerate(sets):
        for j in range(i):
            b, t = sets[j]
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                forest.join(i, j)
    least = {}
    for i, (a, _) in enumerate(sets):
        if a is not None:
            least[forest.root(i)] = min(a, least.get(forest.root(i), a))
    return sorted(((a, len(s), least.get(forest.root(i)) if a is not None else None) for i, (a, s) in enumerate(sets)), key=str)


def near_copies(seed, families=4, copies=25, others=40):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefghij") for _ in range(pick.randint(1, 5)))
    texts = []
    for _ in range(families):
        base = [word() for _ in range(pick.choice([4, 12, 60, 200]))]
        for _ in range(copies):
            new = list(base)
            for _ in range(pick.randint(0, 1 + len(base) // 25)):
                new[pick.randrange(len(new))] = word().upper()
            texts.append(" ".join(new))
    texts += [" ".join(word() for _ in range(pick.randint(0, 30))) for _ in range(others)]
    pick.shuffle(texts)
    return [(i * 3 % 1009, t, 1, "n", "c") for i, t in enumerate(texts)]


ODD = [
    (2000, None, 1, "", ""), (2001, "", 1, "", ""), (2002, " \n\t", 1, "", ""), (2003, "One two", 1, "", ""), (2004, "one  TWO", 1, "", ""),
    (2005, "É a b", 1, "", ""), (2006, "é a b", 1, "", ""), (None, "one two", 1, "", ""), (2007, "x " * 50_000, 1, "", ""),
    (2003, "One two", 1, "", ""), (2008, "a\xa0b c\x1cd e", 1, "", ""), (2009, "a\xa0b c\x1cd e", 1, "", ""),
]


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature(percent):
    pick = np.random.default_rng(percent)
    for _ in range(300):
        size = int(pick.integers(1, 400))
        a = np.unique(pick.integers(0, 1 << 64, size, np.uint64))
        drop = int(pick.integers(0, max(1, len(a) * (100 - percent) // 100) + 1))
        kept = pick.permutation(a)[drop:]
        b = np.unique(np.concatenate([kept, pick.integers(0, 1 << 64, int(pick.integers(0, 3)), np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < percent * (len(a) + len(b) - common) or not len(b):
            continue
        known = nd.bands(percent)
        of = [{s for d in (0, 1) for s in nd.signatures(x, known.band(len(x)) + d, percent, 3).tolist()} for x in (a, b)]
        assert of[0] & of[1]


@pytest.mark.parametrize(("n", "percent", "block", "subparts"), [(3, 90, 2048, 2), (5, 80, 2048, 3), (3, 80, 6, 2)])
def test_against_brute_force(spark, n, percent, block, subparts):
    rows = near_copies(n * percent + block) + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    got = nd.near_duplicate_components(df, n, percent, subparts, block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(rows, n, percent)


def test_keep_one(spark):
    rows = near_copies(7) + ODD
    df = spark.createDataFrame(rows, SCHEMA)
    kept = nd.keep_one(df, 3, 90)
    assert kept.columns == df.columns
    want = {r[2] for r in brute_force(rows, 3, 90)} - {None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(want)
    assert kept.where("doc_id IS NULL").count() == 1
    assert nd.near_duplicate_components(df.limit(0)).count() == 0


def test_rows_of_one_id_are_documents_of_their_own(spark):
    pick = random.Random(3)
    a, b, c = (" ".join(f"w{pick.randrange(500)}" for _ in range(40)) for _ in range(3))
    rows = [(5, a), (5, b), (3, a + " more"), (7, c), (7, c), (8, c), (None, a), (9, None), (9, None)]
    df = spark.createDataFrame([(*r, 1, "n", "c") for r in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in nd.keep_one(df, 3, 90).collect()), key=str)
    assert kept == sorted([(3, a + " more"), (5, b), (7, c), (9, None), (None, a)], key=str)
    got = {(r.doc_id, r.component_id) for r in nd.near_duplicate_components(df, 3, 90).collect()}
    assert got == {(5, 3), (5, 5), (3, 3), (7, 7), (8, 7), (None, None), (9, 9)}


def test_hubs_leave_no_link_out(spark, monkeypatch):
    monkeypatch.setattr(nd, "HUBS", 2)
    pick = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    chain = [" ".join(base[: 60 - i] + [f"x{j}" for j in range(i)]) for i in range(30)]
    copies = [" ".join(w if pick.random() > 0.02 else f"y{i}" for w in base) for i in range(60)]
    rows = [(i * 5 % 1009, t, 1, "n", "c") for i, t in enumerate(chain + copies)]
    got = nd.near_duplicate_components(spark.createDataFrame(rows, SCHEMA), 2, 80, 2, 8).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force(rows, 2, 80)


def test_what_a_hot_family_lists_grows_in_proportion(spark, monkeypatch):
    listed, write = {}, nd.stage

    def counted(df, name):
        out = write(df, name)
        if name == "shared":
            listed[len(listed)] = out.count()
        return out

    monkeypatch.setattr(nd, "stage", counted)
    pick, sizes = random.Random(4), (4000, 20_000)
    base = [f"w{pick.randrange(900)}" for _ in range(40)]
    for size in sizes:
        rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :]), 1, "n", "c") for i in range(size) for k in [i % 40]]
        got = nd.near_duplicate_components(spark.createDataFrame(rows, SCHEMA).repartition(4), 2, 80, block=256)
        assert got.where("component_id <> 0").count() == 0 and got.count() == size
    small, large = listed[0] + listed[1], listed[2] + listed[3]
    assert len(listed) == 4 and large <= 1.1 * small * sizes[1] / sizes[0]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 50)] + [(7, 7), (900, 800), (800, 900), (None, 3)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{500 + i: 500 for i in range(50)}, 800: 800, 900: 800}
