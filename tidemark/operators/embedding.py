"""Embedding by an injected callable, vector spaces, and the wire forms of vectors."""

from __future__ import annotations

import struct
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col

ATTEMPTS, FIRST_DELAY = 3, 1.5


class EmbedError(RuntimeError):
    """The embedder failed for good, or returned something else than was asked for."""


def with_retry(call: Callable[[list[str]], list[list[float]]], texts: list[str], sleep: Callable[[float], None] = time.sleep) -> list[list[float]]:
    """Three attempts, with delays of 1.5, 3 seconds between."""
    for attempt in range(1, ATTEMPTS + 1):
        try:
            return call(texts)
        except Exception as e:
            if attempt == ATTEMPTS:
                raise EmbedError(str(e)) from e
            sleep(FIRST_DELAY * 2 ** (attempt - 1))
    raise AssertionError


def embed(frame: DataFrame, call: Callable[[list[str]], list[list[float]]], dim: int, text: str = "content", batch_size: int = 16) -> DataFrame:
    """``frame`` with ``embedding``: its texts in batches, in order; a vector of another length than ``dim`` raises."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            vectors: list[list[float]] = []
            for at in range(0, len(texts), batch_size):
                part = texts[at : at + batch_size]
                found = with_retry(call, part)
                if len(found) != len(part) or any(len(v) != dim for v in found):
                    raise EmbedError(f"asked for {len(part)} vectors of {dim} numbers")
                vectors += found
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vectors, pa.list_(pa.float32()))], names=[*batch.schema.names, "embedding"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields), "embedding array<float>"])
    return frame.mapInArrow(run, schema)


def only_new(frame: DataFrame, known: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows whose content has no vector yet, so that none is computed twice."""
    return frame.join(known.select(key).distinct(), key, "left_anti")


def half_bytes(vector: list[float]) -> bytes:
    """A vector of 16-bit numbers as it goes over the wire: dimensions, a zero-based flag of 1, then big-endian values."""
    return struct.pack(">HH", len(vector), 1) + np.asarray(vector, ">f2").tobytes()


def six_digits(vector: Column | str) -> Column:
    """The literal of a vector with six significant digits a component."""
    return F.concat(F.lit("["), F.array_join(F.transform(col(vector), lambda x: F.regexp_replace(F.format_string("%.6g", x.cast("double")), "(\\.\\d*?)0+$", "$1")), ","), F.lit("]"))


def resolve_gate(gate: float | str | None, profile_gate: float | None) -> float | None:
    """None is off, ``profile`` the profile's own gate, else a number."""
    return profile_gate if gate == "profile" else None if gate is None else float(gate)


def embedding_verdict(stored: Column, returned: Column, distance: Column, tolerance: float = 1e-3) -> Column:
    """Whether a stored vector came back with its length and within the distance."""
    return F.coalesce((F.size(stored) == F.size(returned)) & ~F.isnan(distance) & (distance <= tolerance), F.lit(False))


def to_half(x: Column) -> Column:
    """A number as binary16 keeps it: rounded to 11 significant bits (half to even), finer than 2**-24 nowhere, infinite from 65520.

    The spacing of binary16 at ``x`` is a power of two, so dividing by it, rounding to a whole number and multiplying are exact.
    """
    x = x.cast("double")
    size = F.abs(x)
    spacing = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.when(size > 0, size))), F.lit(-14)) - 10)
    rounded = F.signum(x) * F.rint(size / spacing) * spacing
    infinite = F.signum(x) * F.lit(float("inf"))
    return F.when(F.isnan(x), x).when(size >= 65520, infinite).when(size > 0, rounded).otherwise(x)


def half_vector(vector: Column | str) -> Column:
    return F.transform(col(vector), to_half)


def parse_vector(text: Column | str) -> Column:
    """The numbers of ``[1,2,3]`` (brackets may be missing); no numbers where the text is null, empty, or one of them isn't a number."""
    inside = F.regexp_replace(F.trim(F.coalesce(col(text), F.lit(""))), r"(?s)^\[(.*)\]$", "$1")
    numbers = F.transform(F.split(inside, ","), lambda x: F.trim(x).try_cast("double"))
    return F.when(F.exists(numbers, lambda x: x.isNull()), F.array().cast("array<double>")).otherwise(numbers)
