import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
from tokenizers import Tokenizer

from tidemark.llm import token_counts, token_files

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "th", "Er", " ", "  ", "\n", "'", "'s", "'RE", "'re", "'ll", "'v", "!", "1", "２", "é", "Σ", "İ", "日本", "\xa0", "　",
         "😀", "<|endoftext|>", "zx" * 30, "\t", "\x1c", "½", "_", "--", "́", "\0"]


def odd_texts(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 15))) for _ in range(n)]


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, part int, n_tokens string")


def test_splitter_state_maps_compose():
    splitter, pick = token_counts.Splitter(), random.Random(0)
    symbols = np.array([pick.randrange(11) for _ in range(1000)], np.uint8)
    state, want = token_counts.CLOSED, []
    for s in symbols.tolist():
        state, begins = token_counts.splitter_step(state, s)
        want.append(begins)
    assert splitter.piece_starts(symbols).tolist() == want


def test_counts_equal_the_library():
    texts = [*odd_texts(4000, 1), "x" * 70_000, "ab " * 30_000, None, ""]
    library = Tokenizer.from_file(BYTE_BPE)
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert token_counts.counter(BYTE_BPE).counts(texts).tolist() == want


def test_merger_recompiles_when_full(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    merger = token_counts.Merger(token_counts.counter(BYTE_BPE).vocabulary)
    for piece in ("another", "thereinafter", "ononondaga", "zzzzxy"):
        assert merger.count(piece.encode()) == len(merger.vocabulary.merged(piece))


def test_counts_of_odd_rows(spark):
    df = docs(spark, [(1, None, 0, ""), (2, "", 0, ""), (3, "word " * 600, 0, ""), (3, "word " * 600, 0, ""), (None, "a", 0, "")])
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(df, BYTE_BPE).collect()}
    assert got == {(1, 0, 0, False), (2, 0, 0, False), (3, 3000, 601, True), (None, 1, 1, False)}
    assert token_counts.count_tokens(df.limit(0), BYTE_BPE).count() == 0


def test_word_encoder_equals_the_library():
    encoder = token_files.word_encoder(WORD_BPE)
    library = Tokenizer.from_file(WORD_BPE)
    sure = [chr(p) for p in range(0x250) if token_files.SURE.fullmatch(chr(p))]
    for text in [*odd_texts(3000, 2), *(f"a{c}1 {c}B{c}{c}" for c in sure)]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want, text


def test_files_hold_the_ids_in_order(spark):
    texts = odd_texts(200, 3)
    rows = [(i * 7 % 200, t, 1, "x") for i, t in enumerate(texts)] + [(None, "no id", 0, ""), (500, None, 0, ""), (3, texts[0], 0, ""), (3, texts[0], 0, "")]
    manifest, folder = token_files.write_token_files(docs(spark, rows), WORD_BPE, end_id=1)
    got = token_files.read_digests(manifest, folder).collect()
    library, start, want = Tokenizer.from_file(WORD_BPE), 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()) if r[1] is not None else -1, r[1] or ""))
    for doc_id, text, *_ in order:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    fs, base = pafs.FileSystem.from_uri(folder)
    names = {f.base_name.split(".", 1)[1] for f in fs.get_file_info(pafs.FileSelector(base))}
    assert names == {"ids", "off", "doc"}


def test_files_of_an_empty_table(spark):
    manifest, folder = token_files.write_token_files(docs(spark, []), WORD_BPE, end_id=1)
    assert token_files.read_digests(manifest, folder).count() == 0
