"""Token ids as flat binary files: unsigned integers end to end, 64-bit document offsets beside them, memory-mapped.

Documents are range-partitioned and sorted by id; every partition encodes its own and writes

* ``<file>.ids``: all ids, little-endian, 16 bits wide where the vocabulary allows it, else 32;
* ``<file>.off``: one more 64-bit offset (in ids, from the file's beginning) than documents;
* ``<file>.doc``: the documents' 64-bit ids; null ids come first and are written as 0.

and reports its totals. The prefix sums of the totals are the partitions' bases, kept in the manifest.
``<file>`` names the partition and the task's attempt. The manifest has the one attempt of each partition that Spark commits, so
a repeated, speculative or half-done attempt can't touch the files that count, and no file is ever moved.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import new_path, stage
from .bpe import byte_letters
from .rows import range_partitions
from .unicode_classes import LETTERS, NUMBERS, SPACES

MEMO_RUNS, MEMO_PIECES = 400_000, 400_000

#: Characters on which lower-casing one by one, composition and splitting at white space surely agree with the library.
SURE = re.compile("[\\t-\\r -~\\xa1-\\u012f\\u0131-\\u024f]*")
# The split pattern of the word vocabulary, and the same for ``re``.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECE = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


class PieceMemo(dict):
    """Ids of pieces that the split pattern yields, merged by the library's model."""

    def __init__(self, library, dtype: np.dtype):
        super().__init__()
        self.model, self.dtype = library.model, dtype
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_PIECES:
            self.clear()
        tokens = self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.letters))
        found = self[piece] = np.array([t.id for t in tokens], self.dtype).tobytes()
        return found


class WordEncoder(dict):
    """Ids of whole texts; bounded memos by lower-cased run of non-blanks, and by piece, serve the usual characters.

    The split pattern never joins characters across white space, so runs can be encoded on their own. Texts with other
    characters or with strings of added tokens, and all texts under a vocabulary that splits otherwise, go to the library
    whole.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces = PieceMemo(self.library, self.dtype)
        split = json.loads(self.library.to_str())["pre_tokenizer"] or {}
        first = (split.get("pretokenizers") or [{}])[0]
        self.usual = first.get("pattern") == {"Regex": SPLIT}

    def __missing__(self, run: str) -> bytes:
        if len(self) >= MEMO_RUNS:
            self.clear()
        found = b"".join(map(self.pieces.__getitem__, PIECE.findall(run)))
        if len(run) <= 64:
            self[run] = found
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.usual or SURE.fullmatch(text) is None or any(t in text for t in self.added):
            return self._whole(text)
        return b"".join(map(self.__getitem__, text.lower().split()))


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


MANIFEST = "part int, file string, dtype string, n_docs long, n_null long, n_ids long"
#: Documents whose digests are held at once.
SLICE = 4096


def write_token_files(docs: DataFrame, path: str, end_id: int | None, to: str | None = None) -> tuple[DataFrame, str]:
    """Write ``docs`` to files below ``to`` (a new folder in the shared one by default); (manifest, folder).

    The manifest has a row for each part that holds documents: part, file, dtype, n_docs, n_null (documents
    without an id), n_ids, first_doc and first_id (the numbers of documents and ids in the parts before). A null text is an empty one;
    ``end_id`` follows every document. Rows that tie in doc_id are ordered by their text, so repeated rows are kept
    side by side. An empty table has an empty manifest. Other columns aren't read.
    """
    spark = docs.sparkSession
    folder = to or new_path(spark, "tokens")
    tail = b"" if end_id is None else np.array([end_id])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        dtype = encoder.dtype
        end = b"" if end_id is None else tail.astype(dtype).tobytes()
        task = TaskContext.get()
        part = task.partitionId()
        file = f"{part:06d}-{task.taskAttemptId()}"
        fs, base = pafs.FileSystem.from_uri(folder)
        sizes, keys, nulls, out = [0], [], 0, None
        for batch in batches:
            if out is None and batch.num_rows:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{file}.ids")
            ids = batch.column(0)
            nulls += ids.null_count
            keys.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            for text in batch.column(1):
                coded = encoder.encode(text.as_py()) + end
                out.write(coded)
                sizes.append(len(coded) // dtype.itemsize)
        if out is None:
            return
        out.close()
        offsets = np.cumsum(np.array(sizes, "<i8"), dtype="<i8")
        for name, data in (("off", offsets), ("doc", np.concatenate(keys))):
            with fs.open_output_stream(f"{base}/{file}.{name}") as f:
                f.write(data.tobytes())
        row = [[part], [file], [dtype.str], [len(sizes) - 1], [nulls], [int(offsets[-1])]]
        types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, types, strict=True)], names=["part", "file", "dtype", "n_docs", "n_null", "n_ids"]
        )

    n = range_partitions(docs)
    ordered = (
        docs.select("doc_id", "text", F.crc32(F.encode("text", "UTF-8")).alias("crc"))
        .repartitionByRange(n, "doc_id", "crc")
        .sortWithinPartitions("doc_id", "crc", "text")
        .select("doc_id", "text")
    )
    parts = stage(ordered.mapInArrow(write, MANIFEST), "token-parts")
    # One row per part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = parts.select(
        "*",
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("first_doc"),
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id"),
    )
    return manifest, folder


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """A file of the folder as an array: memory-mapped where the folder is a local path, else read."""
    fs, base = pafs.FileSystem.from_uri(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(f"{base}/{name}", dtype, "r")
    with fs.open_input_file(f"{base}/{name}") as f:
        return np.frombuffer(f.read(), dtype)


def document_ids(folder: str, file: str, dtype: str) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc_id, offset in the part, ids) of every document of a part."""
    offsets, keys = mapped(folder, f"{file}.off", "<i8"), mapped(folder, f"{file}.doc", "<i8")
    ids = mapped(folder, f"{file}.ids", dtype) if offsets[-1] else np.empty(0, dtype)
    for i in range(len(keys)):
        a, b = int(offsets[i]), int(offsets[i + 1])
        yield int(keys[i]), a, ids[a:b]


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 (of 32-bit ids), from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                documents = enumerate(document_ids(folder, row["file"], row["dtype"]))
                for some in batched(documents, SLICE):
                    rows = [
                        (None if i < row["n_null"] else key, row["first_id"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for i, (key, start, ids) in some
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                    )

    n = max(manifest.count(), 1)
    return manifest.repartition(n, "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
