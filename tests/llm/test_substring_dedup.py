import random

import numpy as np

from tidemark.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, crc long, at string, removed_bytes string"


def words(pick, n):
    return " ".join("".join(pick.choice("abcdefghiklmnoprstuv") for _ in range(pick.randint(2, 8))) for _ in range(n))


def brute_force(rows):
    """Passages in order of document and place, each digest compared with all before."""
    seen, out = set(), {}
    for doc_id, text in sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[1]}):
        data = text.encode()
        ends, first, last = sd.passages(data)
        starts = [0, *ends[:-1].tolist()]
        gone = [False] * len(ends)
        for a, b in zip(first.tolist(), last.tolist()):
            passage = data[starts[a] : ends[b]]
            if passage in seen:
                gone[a : b + 1] = [True] * (b + 1 - a)
            seen.add(passage)
        out[doc_id, text] = b"".join(data[s:e] for s, e, g in zip(starts, ends.tolist(), gone) if not g).decode()
    return out


def test_gear_hash_rolls():
    data = np.frombuffer(random.Random(1).randbytes(200), np.uint8)
    h = 0
    for i, (byte, got) in enumerate(zip(data.tolist(), sd.gear_hashes(data).tolist())):
        h = ((h << 1) + int(sd.GEAR[byte])) & 0xFFFF
        assert i < 16 or got == h & 0xFFFF
    # 16 shifts push a byte out of a 16-bit hash, so the rolled and the windowed hash agree everywhere.


def test_chunks_cover_the_text_and_cut_no_character():
    pick = random.Random(2)
    for text in (words(pick, 400), "é" * 900, "日本語" * 300, "x" * 1000, " " * 500, "a", "ab " * 200):
        data = text.encode()
        ends = sd.chunk_ends(data)
        assert ends[-1] == len(data) and (np.diff(ends, prepend=0) > 0).all()
        assert (np.diff(ends, prepend=0) <= sd.MAX_CHUNK + sd.MIN_CHUNK).all()
        assert b"".join(data[a:b] for a, b in zip([0, *ends[:-1]], ends)).decode() == text
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            data[a:b].decode()


def test_an_insertion_moves_no_boundary_far_behind_it():
    pick = random.Random(3)
    text = words(pick, 500)
    data, moved = text.encode(), ("inserted words " + text).encode()
    shift = len(moved) - len(data)
    assert set((sd.chunk_ends(data) + shift).tolist()[20:]) <= set(sd.chunk_ends(moved).tolist())


def test_against_brute_force(spark):
    pick = random.Random(4)
    shared = [words(pick, 60) for _ in range(5)]
    rows = []
    for i in range(120):
        parts = [words(pick, pick.randint(1, 60)), *([pick.choice(shared)] if i % 3 == 0 else []), words(pick, 10)]
        rows.append((i, "\n".join(parts), 1, "x", "y"))
    rows += [(200, rows[0][1], 1, "", ""), (200, rows[0][1], 1, "", ""), (201, None, 1, "", ""), (202, "", 1, "", ""),
             (None, shared[0], 1, "", ""), (203, shared[0] + " " + shared[0], 1, "", ""), (204, "short", 1, "", ""), (7, words(pick, 40), 1, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sd.deduplicate(df.repartition(5), buckets=3).collect()
    want = brute_force(rows)
    assert len(got) == len(rows)
    before = {}
    for r in rows:
        before.setdefault(r[0], []).append(r[1])
    for r in got:
        texts = [want.get((r.doc_id, t), t) for t in before[r.doc_id]]
        assert r.text in texts, r.doc_id
    by = {r.doc_id: r for r in got}
    assert by[200].text == "" and by[200].removed_bytes == len(rows[0][1].encode()) and by[None].text == shared[0]
    planted = [r for r in got if r.doc_id is not None and r.doc_id < 120 and r.doc_id % 3 == 0]
    assert sum(r.removed_bytes > 150 for r in planted) >= len(planted) - len(shared) - 1
    assert all(r.removed_bytes == 0 for r in got if r.doc_id is not None and r.doc_id < 120 and r.doc_id % 3)


def test_short_copies_go_and_parts_of_texts_stay(spark):
    pick = random.Random(5)
    long = words(pick, 80)
    rows = [(1, "a short line of fifty bytes, more or less, it is."), (2, "another line"), (3, "a short line of fifty bytes, more or less, it is."),
            (4, "another line, longer"), (5, long + " another line"), (6, "another line"), (6, "another line"), (7, "é"), (8, "é"), (9, ""), (None, "é")]
    got = sd.deduplicate(spark.createDataFrame([(*r, 1, "", "") for r in rows], SCHEMA).repartition(3), buckets=2).collect()
    left = sorted(((r.doc_id, r.text) for r in got), key=str)
    gone = {3, 6, 8}
    assert left == sorted([(d, "" if d in gone else t) for d, t in rows], key=str)


def test_repeats_in_a_script_without_blanks(spark):
    pick = random.Random(6)
    make = lambda n: "".join(chr(pick.randrange(0x4E00, 0x9000)) for _ in range(n))
    shared = make(200)
    rows = [(i, make(pick.randint(50, 400)) + shared + make(pick.randint(50, 400)), 1, "", "") for i in range(40)]
    got = sd.deduplicate(spark.createDataFrame(rows, SCHEMA), buckets=2).collect()
    assert sum(r.removed_bytes > 0.6 * 600 for r in got) == 39 and all(r.removed_bytes <= 600 for r in got)


def test_empty(spark):
    assert sd.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0
