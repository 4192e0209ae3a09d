"""Helpers of the operators: intermediate tables, positions in a global order, text columns as byte arrays."""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.session import shared_folder

#: Separators of words: space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that a Python function works on at once; one longer text is worked on alone.
PIECE_BYTES = 1 << 20


class Tables:
    """Parquet tables in the shared folder that are removed together when they are not needed any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """All tables, or the one of that name."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, and not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def added(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores in front until the table has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


# -- text columns in Arrow batches ---------------------------------------------------------


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets from 0) of runs of rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, raw_offsets, raw = column.buffers()  # the batch's own memory, not a copy
    offsets = np.frombuffer(raw_offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; bytes of other characters are never in that range."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = inside[first + 1]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last + 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


#: An odd number, so it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    n = 1 << max(16, (n - 1).bit_length())
    return _powers_of(base, n)


@functools.lru_cache(maxsize=4)
def _powers_of(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers in which each bit depends on all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: What each byte stands for in the polynomial of a word.
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))


def rolled(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``span_hashes_at`` needs to hash any span of ``data``."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, len(data) + 1)[: len(data)], out=total[1:])
    return total, _powers(_INVERSE, len(data) + 1)


def span_hashes_at(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; equal spans have equal hashes."""
    total, inverse = sums
    with np.errstate(over="ignore"):
        return mixed((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hashes_at(rolled(data), start, end)


def chained(*hashes: np.ndarray) -> np.ndarray:
    """Hash of a sequence of hashes."""
    with np.errstate(over="ignore"):
        out = np.full(len(hashes[0]), len(hashes), np.uint64)
        for x in hashes:
            out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + x)
    return out


class Numbers:
    """Distinct 64-bit hashes, numbered from 0 as they come: open addressing in arrays, for many hashes at once."""

    def __init__(self):
        self.hashes = np.zeros(1 << 10, np.uint64)  # by number
        self.n = 0
        self._resize(1 << 11)

    def _resize(self, size: int) -> None:
        self.held, self.number = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self._place(self.hashes[: self.n], np.arange(self.n, dtype=np.int32))

    def _place(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        last = len(self.number) - 1
        at = (hashes & np.uint64(last)).astype(np.int64)
        while len(hashes):
            free = self.number[at] < 0
            self.number[at[free]] = numbers[free]  # of two for one place, one stays
            left = self.number[at] != numbers
            self.held[at[~left]] = hashes[~left]
            hashes, numbers, at = hashes[left], numbers[left], (at[left] + 1) & last

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if it has none."""
        last = len(self.number) - 1
        at = (hashes & np.uint64(last)).astype(np.int64)
        out = self.number[at]
        open_ = np.flatnonzero((out >= 0) & (self.held[at] != hashes))
        at = at[open_]
        while len(open_):
            at = (at + 1) & last
            out[open_] = self.number[at]
            more = (out[open_] >= 0) & (self.held[at] != hashes[open_])
            open_, at = open_[more], at[more]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct hashes that have no number."""
        total = self.n + len(hashes)
        if total > len(self.hashes):
            self.hashes = np.concatenate([self.hashes[: self.n], np.zeros(total, np.uint64)])
        self.hashes[self.n : total] = hashes
        before, self.n = self.n, total
        if 2 * total > len(self.number):
            self._resize(1 << (2 * total).bit_length())
        else:
            self._place(hashes, np.arange(before, total, dtype=np.int32))


def lists_of(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array with ``counts`` elements a row."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat, kind))


def blob(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def text_or_empty(name: str):
    return F.coalesce(F.col(name), F.lit(""))
