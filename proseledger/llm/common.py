"""What several operators share: reading, stored tables, words, byte hashes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import key_bytes, most_rows
from ..sources.shared import store, stored

__all__ = ["ID", "TEXT", "documents", "narrow", "store", "stored", "text_key"]

# Inside the operators the two columns have these names, so that no column of the
# caller's table can clash with an internal one.
ID, TEXT = "_id", "_text"

# The separators of words, as bytes: space and 0x09-0x0D. All words are what lies between.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"

# A task works on this many bytes of text at a time, whatever the batch it is given.
SLICE_BYTES = 4 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text under internal names; a NULL text becomes empty."""
    return df.select(
        F.col(id_col).alias(ID), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(TEXT)
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_proseledger_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # The driver's copy; Spark hands it out to the executors.
    path = os.path.join(tempfile.mkdtemp(prefix="proseledger-code-"), "proseledger_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._proseledger_shipped = True


def map_batches(df: DataFrame, rows: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable where the rows are made."""
    ship(df.sparkSession)
    return df.mapInArrow(rows, schema)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """While this lasts, a query's shuffle files go when it ends, not when the driver happens to collect garbage.

    For work in stored steps, where nothing reads them again.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def settled(df: DataFrame, kept: list[str], computed: list[str]) -> DataFrame:
    """Work the computed columns out here, once.

    A filter on a computed column would be moved below its projection and the
    expressions put in its place, into lambda functions too, where they would
    run again for every element. No filter moves below a generator.
    """
    return df.select(*kept, F.inline_outer(F.array(F.struct(*computed))))


def text_key(text: Column) -> Column:
    """With the id, tells rows apart that share an id but not a text."""
    return F.xxhash64(text, F.octet_length(text))


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together, or one longer text."""
    begin, size = 0, 0
    for at, text in enumerate(texts):
        if at > begin and size + len(text) > limit:
            yield begin, at
            begin, size = at, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a column of strings, NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


# --- 64-bit hashes -----------------------------------------------------------------------

_MASK = (1 << 64) - 1
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACE.encode())] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
ASCII_LOWER = _LOWER.tobytes()


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def salted(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit values."""
    start = np.uint64((seed * 0x9E3779B97F4A7C15) & _MASK)
    with np.errstate(over="ignore"):
        return mix(start + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_BYTE = salted(256, 1)
# A-Z hash as a-z.
_WORD_BYTE = _BYTE[_LOWER]
_BASE = 0x5851F42D4C957F2D
_CHUNK = 1 << 18


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, made as far as they are asked for."""

    def __init__(self, base: int) -> None:
        self.bases = base & _MASK, pow(base, -1, 1 << 64)
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, count: int) -> list[np.ndarray]:
        if len(self.tables[0]) < count:
            for i, base in enumerate(self.bases):
                factors = np.full(count, base, np.uint64)
                factors[0] = 1
                with np.errstate(over="ignore"):
                    self.tables[i] = np.multiply.accumulate(factors)
        return self.tables


_POWERS = Powers(_BASE)


def word_bounds(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a buffer of bytes start and end."""
    inside = np.zeros(len(buffer) + 2, np.int8)
    inside[1:-1] = _IS_WORD[buffer]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word; A-Z count as a-z.

    A word's bytes are the coefficients of a polynomial, taken as a difference
    of prefix sums over a chunk of words, and mixed with its length.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            base = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, base + _CHUNK, "right")))
            part = buffer[base:ends[to - 1]]
            powers, inverses = _POWERS.upto(max(len(part), _CHUNK) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_WORD_BYTE[part] * powers[:len(part)], out=sums[1:])
            first, last = starts[at:to] - base, ends[at:to] - base
            value = (sums[last] - sums[first]) * inverses[first]
            out[at:to] = value ^ ((last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            at = to
    return mix(out)


# Rows of a few numbers each: 32 MB at most.
MAX_BROADCAST_ROWS = 2_000_000


def small_side(df: DataFrame) -> DataFrame:
    """A stored table of narrow rows, to be broadcast if its count allows, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def bounded_side(df: DataFrame, keys: list[str]) -> DataFrame:
    """A stored table of keys and a few numbers, to be broadcast if its counted rows of the widest key allow."""
    rows, widest = df.agg(F.count("*"), F.max(key_bytes(df, keys))).first()
    return F.broadcast(df) if rows <= most_rows(widest or 0) else df
