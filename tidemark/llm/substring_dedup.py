"""Substring deduplication by content-defined chunking.

A gear hash rolls over a text's bytes (each byte shifts the hash by one bit and adds the byte's random number, so 16 bytes
decide its value), and a chunk ends behind white space, or a
character of a script without blanks, where the hash is small enough. Chunks follow the content: an
insertion moves the bytes behind it, not their boundaries. What is looked up by digest is a passage: from each chunk's
start, the fewest whole chunks that make up ``MIN_PASSAGE`` bytes, or all chunks of a text that is shorter. A passage that
occurred before, in order of document and place, is removed; so every distinct chunk of the corpus stays at least once.

Digests travel packed, a binary value for each task and bucket. A map task sends each digest once, with its first place in
the task; the task's other places are decided there, so a passage that fills the corpus reaches its bucket once a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_PASSAGE = 100
MIN_CHUNK, MAX_CHUNK = 12, 128
#: Chances, of 65,536, that a chunk ends behind white space, behind a character of three or four bytes (scripts that
#: mostly have no blanks; chunks of about 27 bytes too), and behind any other character.
AFTER_SPACE, AFTER_WIDE, AFTER_OTHER = 21845, 7282, 512
FLUSH_BYTES = 12_000_000
BUCKET_BYTES = 24_000_000
#: Rows that are held as Python objects at once, at most.
SLICE = 512
SEED = 7

GEAR = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 16, 256, np.uint16)
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

OCCURRENCE = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<i8"), ("crc", "<u4"), ("at", "<i4")])
PLACE = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("at", "<i4")])


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash at each byte, by doubling the window: 1, 2, 4, 8, 16 bytes."""
    h = GEAR[data]
    for width in (1, 2, 4, 8):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint16(width)
        h = wider
    return h


def chunk_ends(data: bytes) -> np.ndarray:
    """Where the chunks of a text's UTF-8 end; the last is the text's end. No character is cut."""
    if not data:
        return np.empty(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    h = gear_hashes(raw)
    whole = np.append((raw[1:] & 0xC0) != 0x80, True)  # a character ends here
    wide = np.zeros(len(raw), bool)
    wide[2:] = raw[:-2] >= 0xE0
    wide[3:] |= raw[:-3] >= 0xF0
    chance = np.where(IS_SPACE[raw], AFTER_SPACE, np.where(wide, AFTER_WIDE, AFTER_OTHER))
    cuts = np.flatnonzero((h < chance) & whole) + 1
    ends, last = [], 0
    for cut in [*cuts.tolist(), len(data)]:
        while cut - last > MAX_CHUNK:
            last += MAX_CHUNK
            while not whole[last - 1]:
                last -= 1
            ends.append(last)
        if cut - last >= MIN_CHUNK:
            ends.append(cut)
            last = cut
    if not ends or ends[-1] != len(data):
        ends.append(len(data))
    return np.array(ends, np.int64)


def passages(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk ends, first chunk, last chunk) of each passage: those that reach MIN_PASSAGE bytes before the text ends, and a
    shorter text as a whole."""
    ends = chunk_ends(data)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    last = np.searchsorted(ends, starts + MIN_PASSAGE)
    first = np.flatnonzero(last < len(ends)) if len(data) >= MIN_PASSAGE else np.zeros(min(1, len(ends)), np.int64)
    last = last[first]
    last[-1:] = len(ends) - 1  # the last one runs to the text's end, so that a copy of the text is covered whole
    return ends, first, last


def digests(data: bytes, ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """128-bit digests of passages, as rows of two numbers."""
    begin = np.where(first > 0, ends[first - 1], 0)
    view, digest = memoryview(data), xxhash.xxh3_128_digest
    return np.frombuffer(
        b"".join([digest(view[a:b]) for a, b in zip(begin.tolist(), ends[last].tolist())]), ">u8"
    ).reshape(-1, 2)


def first_places(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the first occurrence of each digest, those that stand behind an earlier one of their digest)."""
    found = found[np.lexsort((found["at"], found["crc"], found["doc"], found["low"], found["high"]))]
    same = np.zeros(len(found), bool)
    same[1:] = (found["high"][1:] == found["high"][:-1]) & (found["low"][1:] == found["low"][:-1])
    # An occurrence at the very place of the first one comes from a repeated row and isn't a repetition.
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(found))))
    later = same & ~np.all([found[c] == found[c][lead] for c in ("doc", "crc", "at")], axis=0)
    return found[~same], found[later]


def places(of: np.ndarray) -> bytes:
    out = np.empty(len(of), PLACE)
    for c in PLACE.names:
        out[c] = of[c]
    return out.tobytes()


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def bucket_count(docs: DataFrame) -> int:
    """So many buckets that each gets the digests of BUCKET_BYTES of text, and the session's shuffle partitions at least."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))


def repeated_places(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, crc, at): the passages, by the number of their first chunk, that have an earlier occurrence."""
    n = buckets or bucket_count(docs)

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate(parts) if parts else np.empty(0, OCCURRENCE)
        firsts, later = first_places(found)
        bucket = (firsts["high"] % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(n + 1))
        share = np.linspace(0, len(later), n + 1).astype(np.int64)
        for b in range(n):
            mine, decided = firsts[order[bounds[b] : bounds[b + 1]]], later[share[b] : share[b + 1]]
            if len(mine) or len(decided):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b], pa.int32()), pa.array([mine.tobytes()], pa.binary()), pa.array([places(decided)], pa.binary())],
                    names=["bucket", "firsts", "decided"],
                )

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for doc_id, crc, text in (row for b in slices(batches) for row in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            data = text.encode("utf-8")
            ends, first, last = passages(data)
            if not len(first):
                continue
            part = np.empty(len(first), OCCURRENCE)
            part["high"], part["low"] = digests(data, ends, first, last).T
            part["doc"], part["crc"], part["at"] = doc_id, crc, first
            parts.append(part)
            held += len(data)
            if held >= FLUSH_BYTES:
                yield from flush(parts)
                parts, held = [], 0
        yield from flush(parts)

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        _, later = first_places(np.frombuffer(b"".join(pdf["firsts"]), OCCURRENCE))
        out = np.frombuffer(places(later) + b"".join(pdf["decided"]), PLACE)
        return pd.DataFrame({"doc_id": out["doc"], "crc": out["crc"].astype(np.int64), "at": out["at"]})

    rows = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") > 0)).select(
        "doc_id", F.crc32(F.encode("text", "UTF-8")).alias("crc"), "text"
    )
    packed = rows.mapInArrow(collect, "bucket int, firsts binary, decided binary")
    return packed.groupBy("bucket").applyInPandas(decide, "doc_id long, crc long, at int")


def cut_out(text: str, at: list[int]) -> tuple[str, int, int]:
    """(what is left, chunks, chunks removed) when the passages that begin at the chunks ``at`` are removed."""
    data = text.encode("utf-8")
    ends, first, last = passages(data)
    until = dict(zip(first.tolist(), last.tolist()))
    gone = np.zeros(len(ends), bool)
    for i in at:
        gone[i : until[i] + 1] = True
    begin = np.concatenate([[0], ends[:-1]])
    keep = np.flatnonzero(~gone)
    left = b"".join(data[a:b] for a, b in zip(begin[keep].tolist(), ends[keep].tolist()))
    return left.decode("utf-8"), len(ends), int(gone.sum())


def deduplicate(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and the columns removed_chunks and removed_bytes.

    All rows and columns stay; a column of ``docs`` that has one of the two new names is replaced. Of a repeated passage the
    occurrence in the smallest doc_id, there the first, stays. A text below MIN_PASSAGE bytes is one passage: it goes when
    another document has just that text before. A null or empty text and one without a doc_id are left alone and aren't searched. Repeated rows (equal id and text) count as one document and are cut
    alike. An empty table gives none. A text of any length is read whole.
    """
    docs = docs.drop("removed_chunks", "removed_bytes")
    lists = repeated_places(docs, buckets).groupBy("doc_id", "crc").agg(F.collect_set("at").alias("at"))
    keyed = docs.withColumn("__crc", F.crc32(F.encode("text", "UTF-8")))
    lists = lists.select(F.col("doc_id").alias("__doc"), F.col("crc").alias("__of"), F.col("at").alias("__at"))
    matched = keyed.join(lists.hint("shuffle_hash"), (F.col("doc_id") == F.col("__doc")) & (F.col("__crc") == F.col("__of")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text_at, at_at = batch.schema.get_field_index("text"), batch.schema.get_field_index("__at")
            texts, chunks, sizes = batch.column(text_at).to_pylist(), [], []
            for i, at in enumerate(batch.column(at_at).to_pylist()):
                removed = size = 0
                if at:
                    before = texts[i]
                    texts[i], _, removed = cut_out(before, at)
                    size = len(before.encode("utf-8")) - len(texts[i].encode("utf-8"))
                chunks.append(removed)
                sizes.append(size)
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names) if name != "__at"}
            columns["text"] = pa.array(texts, pa.string())
            columns |= {"removed_chunks": pa.array(chunks, pa.int64()), "removed_bytes": pa.array(sizes, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    shape = T.StructType([*docs.schema.fields, T.StructField("removed_chunks", T.LongType()), T.StructField("removed_bytes", T.LongType())])
    return matched.select(*docs.columns, "__at").mapInArrow(run, shape)
