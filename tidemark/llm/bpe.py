"""Exact byte-level BPE without running merges over the text: longest matches, a pair table and backtracking.

An Aho-Corasick automaton lists, for every place of a piece, the vocabulary entries
that start there. The encoder takes the longest and keeps it if the pair it makes
with the token before is compatible, that is if merging their joined bytes gives just
these two back; else it tries the next shorter one, and where none fits it takes back
the token before and never comes to that place again. As a row of tokens is what merging
gives exactly if all its neighbours are compatible, the result is exact; as every place
is given up at most once, the time is linear in the piece.

Decoding copies byte ranges found in an offset table, for all ids at once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .rows import map_texts
from .unicode_classes import LETTERS, NUMBERS, SPACES

MEMO_PIECES = 500_000
MEMO_PAIRS = 200_000

#: What splits text before merging, as the byte-level tokenizer's own pattern says it.
PIECE = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)


def byte_letters() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in found:
            found[b] = chr(256 + len(found) - len(plain))
    return found


class Vocabulary:
    """Tokens, merge ranks and added tokens of a byte-level BPE file; token strings are bytes read as Latin-1."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        if data["model"]["type"] != "BPE" or data["normalizer"] or data["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is not a byte-level BPE vocabulary")
        latin = {ord(c): chr(b) for b, c in byte_letters().items()}
        self.ids = {t.translate(latin): i for t, i in data["model"]["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"])
        self.ranks = {(a.translate(latin), b.translate(latin)): r for r, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.added_split = (
            re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        )

    def merged(self, text: str) -> list[str]:
        """The definition: join the neighbours of lowest rank, leftmost first, until none has a rank. For short texts."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts


class PairTable(dict):
    """Whether two neighbouring tokens stay as they are; filled on demand, emptied when full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, pair: tuple[str, str]) -> bool:
        if len(self) >= MEMO_PAIRS:
            self.clear()
        fits = self.vocabulary.merged(pair[0] + pair[1]) == [*filter(None, pair)]
        self[pair] = fits
        return fits


class Encoder(dict):
    """piece -> ids as little-endian bytes of ``dtype``; a bounded memo over :meth:`encode_piece`."""

    def __init__(self, path: str):
        super().__init__()
        self.vocabulary = Vocabulary(path)
        self.pairs = PairTable(self.vocabulary)
        self.automaton = ahocorasick.Automaton()
        for token in self.vocabulary.ids:
            self.automaton.add_word(token, token)
        self.automaton.make_automaton()
        top = max(*self.vocabulary.ids.values(), *self.vocabulary.added.values(), 0)
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")

    def __missing__(self, piece: str) -> bytes:
        ids = self.vocabulary.ids
        found = np.array([ids[t] for t in self.encode_piece(piece.encode("utf-8").decode("latin-1"))], self.dtype).tobytes()
        if len(piece) <= 64:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = found
        return found

    def encode_piece(self, text: str) -> list[str]:
        """The tokens of one piece, given as bytes read as Latin-1."""
        if text in self.vocabulary.ids and self.pairs["", text]:
            return [text]
        starts: list[list[str]] = [[] for _ in text]
        for end, token in self.automaton.iter(text):
            starts[end + 1 - len(token)].append(token)  # shortest first
        tokens: list[str] = []
        left = [len(x) for x in starts]  # the matches at each place that weren't given up
        at, end, pairs = 0, len(text), self.pairs
        while at < end:
            before = tokens[-1] if tokens else ""
            while left[at]:
                left[at] -= 1
                token = starts[at][left[at]]
                after = at + len(token)
                if (after == end or left[after]) and pairs["", token] and pairs[before, token]:
                    tokens.append(token)
                    at = after
                    break
            else:
                if not tokens:
                    raise ValueError("the vocabulary lacks a byte of the text")
                at -= len(tokens.pop())
        return tokens

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; strings of added tokens become those tokens."""
        if not text:
            return np.empty(0, self.dtype)
        added = self.vocabulary.added
        if self.vocabulary.added_split is None or not any(t in text for t in added):
            return np.frombuffer(b"".join(map(self.__getitem__, PIECE.findall(text))), self.dtype)
        parts = []
        for part in self.vocabulary.added_split.split(text):
            if part in added:
                parts.append(np.array([added[part]], self.dtype).tobytes())
            else:
                parts.extend(map(self.__getitem__, PIECE.findall(part)))
        return np.frombuffer(b"".join(parts), self.dtype)


class OffsetTable:
    """Byte strings end to end, with the place where each begins."""

    def __init__(self, entries: list[bytes]):
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)
        self.begin = np.zeros(len(entries) + 1, np.int64)
        np.cumsum([len(e) for e in entries], out=self.begin[1:])

    def joined(self, ids: np.ndarray) -> bytes:
        """The entries of ``ids``, end to end."""
        begin = self.begin[ids]
        size = self.begin[ids.astype(np.int64) + 1] - begin
        end = np.cumsum(size)
        if not len(end):
            return b""
        return self.bytes[np.repeat(begin - end + size, size) + np.arange(end[-1])].tobytes()


class Decoder:
    """ids -> text, and ids -> their decimal numbers, by offset tables."""

    def __init__(self, vocabulary: Vocabulary):
        n = 1 + max(*vocabulary.ids.values(), *vocabulary.added.values(), 0)
        entries = [b""] * n
        for token, i in vocabulary.ids.items():
            entries[i] = token.encode("latin-1")
        for token, i in vocabulary.added.items():
            entries[i] = token.encode("utf-8")
        self.tokens = OffsetTable(entries)
        self.decimals = OffsetTable([b"%d," % i for i in range(n)])

    def decode(self, ids: np.ndarray) -> str:
        """Bytes that aren't UTF-8 become U+FFFD."""
        return self.tokens.joined(ids).decode("utf-8", "replace")


@cache
def codec(path: str) -> tuple[Encoder, Decoder]:
    encoder = Encoder(path)
    return encoder, Decoder(encoder.vocabulary)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>): the ids of every whole text; an empty array for a null or empty one.

    Rows are independent: repeated rows and ties give equal ids, an empty table none; other columns aren't read.
    """

    def run(ids, texts):
        encoder, _ = codec(path)
        return [ids, [encoder.encode(t).astype(np.int32) for t in texts]]

    return map_texts(docs, run, "doc_id long, ids array<int>", rows=128)


def encode_rows(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with n_tokens, ids array<int> and round_trips (decoding gives the text back), for every row and column.

    A null text counts as an empty one; columns of ``docs`` that have one of the new names are replaced.
    """
    docs = docs.drop("n_tokens", "ids", "round_trips")

    def coded(encoder: Encoder, decoder: Decoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                found = [encoder.encode(t).astype(np.int32) for t in texts]
                same = [decoder.decode(f) == (t or "") for f, t in zip(found, texts, strict=True)]
                columns = [*batch.columns, pa.array([len(f) for f in found], pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "n_tokens", "ids", "round_trips"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = codec(path)
        try:
            yield from coded(encoder, decoder, batches)
        finally:
            # Workers outlive the task, and other operators' tasks follow in them.
            encoder.clear()
            encoder.pairs.clear()

    new = T.StructType.fromDDL("n_tokens long, ids array<int>, round_trips boolean")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *new.fields]))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null."""

    def run(ids, values):
        _, decoder = codec(path)
        return [ids, [None if v is None else decoder.decode(np.array(v, np.int64)) for v in values]]

    return map_texts(encoded.selectExpr("doc_id", "ids AS text"), run, "doc_id long, text string", rows=128)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded text).

    Nulls and repeated rows are as in :func:`encode_documents`. Nothing is shuffled.
    """

    def run(ids, texts):
        encoder, decoder = codec(path)
        counts, of_ids, of_text = [], [], []
        for text in texts:
            found = encoder.encode(text)
            counts.append(len(found))
            of_ids.append(hashlib.sha256(decoder.decimals.joined(found)[:-1]).hexdigest())
            of_text.append(hashlib.sha256(decoder.decode(found).encode("utf-8")).hexdigest())
        return [ids, counts, of_ids, of_text]

    return map_texts(docs, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", rows=256)
