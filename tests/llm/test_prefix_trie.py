import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from tidemark.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_hand(rows):
    """Every prefix of every rebuilt conversation, in dictionaries."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = sum(saved[c] for c in children[path]) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        out.append((min(members[path]), len(path), parent, len(members[path]), len(children[path]), leaves[path], saved[path], digest))
    return sorted(out, key=repr)


def built(spark, rows):
    found = trie.prefix_trie(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).select(*COLUMNS).collect()
    return sorted(map(tuple, found), key=repr)


def talk(seed, n, words):
    draw, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(draw.randrange(9)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), draw.choice(words)))
    return rows


def test_shared_prefixes_over_many_ranges(spark):
    rows = talk(1, 900, ["hi", "é😀", "no"])
    assert built(spark, rows) == by_hand(rows)


def test_nulls_ties_empty_texts_repeated_rows_and_turnless_conversations(spark):
    rows = talk(2, 250, ["", "a", None]) + [(None, 1, "user", "x"), (5, None, None, None), (5, None, "z", "b"), (5, None, "a", "c"), (7, 3, "u", "t"), (7, 3, "u", "t")]
    rows += [(c, 0, "user", "only") for c in range(300, 420)] + [(-5, 0, "u", "below"), (-105, 1, "u", "zero"), (-100, 1, "u", "zero"), (-100, 2, "u", "v")]
    assert built(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "u", "t")], [(1, 0, None, None)], [(0, 0, "u", "t"), (0, 1, "u", "t")]])
def test_small_tables(spark, rows):
    assert built(spark, rows) == by_hand(rows)


def test_a_very_long_conversation_and_a_very_large_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 300)
    monkeypatch.setattr(trie, "RUN_ROWS", 70)
    rows = [(1, t, "user", f"t{t}") for t in range(3_000)] + [(c, t, "user", "the same") for c in range(100, 1_100) for t in range(2)]
    rows += [(2, t, "user", f"t{t}") for t in range(2_500)] + [(2_000, 0, "user", "é" * 50_000)]
    assert built(spark, rows) == by_hand(rows)


def test_merging_looks_only_beyond_the_common_turns(monkeypatch):
    draw = random.Random(3)
    keys = sorted({b"".join(bytes([draw.choice([1, 2])]) * trie.KEY for _ in range(draw.randrange(12))) for _ in range(600)})
    rows = [(k, bytes(len(k) // trie.KEY * trie.SIZE), i) for i, k in enumerate(keys)] * 2
    draw.shuffle(rows)
    runs = [trie.one_run(rows[i::7]) for i in range(7)]
    known, real = [], trie.shared_turns
    packed = [trie.packed_run(0, run) for run in runs]
    monkeypatch.setattr(trie, "shared_turns", lambda a, b, k=0: known.append((real(a, b) >= k, k)) or real(a, b, k))
    merged = list(trie.LoserTree([trie.unpacked_run(*row[1:]) for row in packed]))
    assert [m[1] for m in merged] == sorted(e[0] for run in runs for e in run)
    assert [m[0] for m in merged] == [0, *(real(a[1], b[1]) for a, b in zip(merged, merged[1:], strict=False))]
    assert all(right for right, _ in known) and len(known) < 3 * len(merged) and sum(k for _, k in known) > len(known)


def test_shared_turns_agrees_with_counting():
    draw = random.Random(4)
    for _ in range(300):
        one, two = (b"".join(draw.choice([b"a", b"a", b"a", b"b"]) * trie.KEY for _ in range(draw.randrange(40))) for _ in range(2))
        expected = next((i for i in range(len(one) // trie.KEY) if one[i * 16 : i * 16 + 16] != two[i * 16 : i * 16 + 16]), len(one) // trie.KEY)
        assert trie.shared_turns(one, two) == min(expected, len(two) // trie.KEY)


def test_sql_says_the_same(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    expected = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({trie.trie_sql()})").fetchall()
    found = trie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet")).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr) and found
