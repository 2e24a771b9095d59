"""Versioned files of working trees, listed from the version-control index without opening a file's content.

``versioned_files`` is a data source: a partition for each working tree, whose index is read front to back in blocks.
``versioned_corpus`` opens only the files whose id an index of chunks hasn't got yet.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import MAX_FILE_BYTES, classify_path, looks_binary, read_text

SCHEMA = "root string, path string, mode string, blob_sha string, stage int"
BLOCK, ROWS = 1 << 20, 4096
#: Files whose contents are held at once while they are read.
SLICE = 32


class _Blocks:
    """A file read front to back; what is taken goes into the digest."""

    def __init__(self, file, digest):
        self.file, self.digest, self.held, self.at, self.taken = file, digest, b"", 0, 0

    def _more(self) -> None:
        block = self.file.read(BLOCK)
        if not block:
            raise ValueError("the index ends early")
        self.held, self.at = self.held[self.at :] + block, 0

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n:
            self._more()
        out = self.held[self.at : self.at + n]
        self.at += n
        self.taken += n
        self.digest.update(out)
        return out

    def until_zero(self) -> bytes:
        while (end := self.held.find(b"\0", self.at)) < 0:
            self._more()
        return self.take(end + 1 - self.at)[:-1]

    def offset(self) -> int:
        """A number of seven bits a byte, highest first, in which each further byte adds one to what came before."""
        byte = self.take(1)[0]
        value = byte & 127
        while byte & 128:
            byte = self.take(1)[0]
            value = ((value + 1) << 7) + (byte & 127)
        return value


def index_entries(file, size: int, object_format: str = "sha1") -> Iterator[tuple[bytes, str, str, int]]:
    """(path, mode, id, stage) of an index file of ``size`` bytes, formats 2 to 4, in its order.

    Of a path in conflict the last stage counts. An index that is cut off or damaged, or has a mandatory extension (one that is
    split over files, or names folders instead of their files), is an error.
    """
    width = hashlib.new(object_format).digest_size
    blocks = _Blocks(file, hashlib.new(object_format))
    magic, version, count = struct.unpack(">4sII", blocks.take(12))
    if magic != b"DIRC" or version not in (2, 3, 4):
        raise ValueError(f"not an index of format 2, 3 or 4: {magic!r} {version}")
    path, last = b"", None
    for _ in range(count):
        begin = blocks.taken
        fixed = blocks.take(40 + width + 2)
        flags = int.from_bytes(fixed[-2:])
        if flags & 0x4000:
            blocks.take(2)
        if version == 4:
            shared = len(path) - blocks.offset()
            path = path[:shared] + blocks.until_zero()
        else:
            path = blocks.until_zero()
            blocks.take(-(blocks.taken - begin) % 8)
        if last and last[0] != path:
            yield last
        last = path, f"{int.from_bytes(fixed[24:28]):06o}", fixed[40 : 40 + width].hex(), flags >> 12 & 3
    if last:
        yield last
    while blocks.taken < size - width:
        kind, length = struct.unpack(">4sI", blocks.take(8))
        if not kind[:1].isupper():
            raise ValueError(f"the index has an extension that can't be left out: {kind!r}")
        while length:
            length -= len(blocks.take(min(length, BLOCK)))
    found = blocks.digest.digest()
    if blocks.take(width) not in (found, bytes(width)):
        raise ValueError("the index doesn't agree with its checksum")


def _index_of(system: fs.FileSystem, root: str) -> str | None:
    """Where the index of a working tree is; None where nothing was ever added or the folder is no working tree."""
    place = f"{root}/.git"
    if system.get_file_info(place).type == fs.FileType.File:  # a linked working tree names its folder in a file
        with system.open_input_stream(place) as f:
            named = f.read().decode().removeprefix("gitdir:").strip()
        place = posixpath.normpath(posixpath.join(root, named))
    return f"{place}/index" if system.get_file_info(f"{place}/index").type == fs.FileType.File else None


class _Tree(InputPartition):
    def __init__(self, root: str, index: str):
        self.root, self.index = root, index


class _Listing(DataSourceReader):
    def __init__(self, path: str, object_format: str):
        self.path, self.object_format = path, object_format

    def partitions(self) -> list[_Tree]:
        system, root = fs.FileSystem.from_uri(self.path.rstrip("/"))
        if system.get_file_info(f"{root}/.git").type != fs.FileType.NotFound:
            roots = [root]
        else:
            roots = sorted(i.path for i in system.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory)
        return [_Tree(r, index) for r in roots if (index := _index_of(system, r))] or [_Tree(root, "")]

    def read(self, partition: _Tree) -> Iterator[pa.RecordBatch]:
        if not partition.index:
            return
        system, _ = fs.FileSystem.from_uri(self.path.rstrip("/"))
        size, rows = system.get_file_info(partition.index).size, []
        with system.open_input_stream(partition.index) as file:
            for path, mode, blob, stage in index_entries(file, size, self.object_format):
                rows.append((partition.root, path.decode("utf-8", "replace"), mode, blob, stage))
                if len(rows) == ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 4 + [pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["root", "path", "mode", "blob_sha", "stage"])


class VersionedFiles(DataSource):
    """``path``: a working tree, or a folder of working trees; option ``objectFormat``: sha1 (the default) or sha256."""

    @classmethod
    def name(cls) -> str:
        return "versioned_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Listing(self.options["path"], self.options.get("objectFormat", "sha1"))


def versioned_files(spark: SparkSession, path: str, object_format: str = "sha1") -> DataFrame:
    """root, path, mode, blob_sha, stage of all versioned files: the index's, whether the files have been changed since or not.

    A path that isn't UTF-8 has U+FFFD in it. A tree without an index has no rows.
    """
    spark.dataSource.register(VersionedFiles)
    return spark.read.format("versioned_files").option("objectFormat", object_format).load(path)


def versioned_corpus(spark: SparkSession, path: str, known: DataFrame | None = None, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """path, kind, lang, blob_sha, size, content of the versioned text files; what a store's ``sync`` takes.

    Files whose (path, blob_sha) is in ``known`` keep their row, with a null content, and are never opened: a sync copies their
    chunks forward. Unknown extensions, lock files, files over ``max_bytes`` or that aren't on disk, and binary ones are left
    out. Of several trees in one folder, paths begin with the tree's name.
    """
    listed = versioned_files(spark, path).withColumn("c", classify_path("path")).where(F.col("c").isNotNull())
    rows = listed.select("root", F.col("path").alias("__in"), "c.kind", "c.lang", "blob_sha")
    _, top = fs.FileSystem.from_uri(path.rstrip("/"))
    inner = F.substring(F.col("root"), len(top) + 2, 1 << 20)
    rows = rows.withColumn("path", F.when(inner == "", F.col("__in")).otherwise(F.concat(inner, F.lit("/"), F.col("__in"))))
    if known is None:
        rows = rows.withColumn("known", F.lit(False))
    else:
        have = known.select("path", "blob_sha").distinct().withColumn("__have", F.lit(True))
        rows = rows.join(have, ["path", "blob_sha"], "left").withColumn("known", F.coalesce("__have", F.lit(False))).drop("__have")
    shape = "path string, kind string, lang string, blob_sha string, known boolean, size long, content binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(path.rstrip("/"))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                places = [f"{r}/{p}" for r, p in zip(part["root"].to_pylist(), part["__in"].to_pylist())]
                infos, contents = system.get_file_info(places), []
                fits = [i.type == fs.FileType.File and i.size <= max_bytes for i in infos]
                for place, fit, have in zip(places, fits, part["known"].to_pylist()):
                    if fit and not have:
                        with system.open_input_stream(place) as f:
                            contents.append(f.read())
                    else:
                        contents.append(None)
                columns = [part[c] for c in ("path", "kind", "lang", "blob_sha", "known")]
                columns += [pa.array([i.size for i in infos], pa.int64()), pa.array(contents, pa.binary())]
                names = ["path", "kind", "lang", "blob_sha", "known", "size", "content"]
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(fits))

    found = rows.repartition("path").mapInArrow(read, shape)
    text = F.when(~F.col("known"), read_text("content")).alias("content")
    return found.where(F.col("known") | ~looks_binary("content")).select("path", "kind", "lang", "blob_sha", "size", text)
