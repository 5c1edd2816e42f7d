"""Helpers that several training-data operators share: table access, staging, words as arrays of hashes.

The functions that run inside tasks work on whole Arrow batches with numpy. A batch is cut into
slices of a few megabytes of text first, so a task's memory does not depend on how many rows
Spark hands over at once; only a single text larger than the slice is handled by itself.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import hashlib
import inspect
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import write_stage

# Functions of this package travel with their job: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between Spark and a worker while texts are tokenized. Spark's own limit is 64 MB, of which both sides hold two.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
LAST_ID = (1 << 63) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written below ``spark.checkpoint.dir`` and read back: survives a lost executor."""
    return write_stage(df, name)


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that are run inside get Arrow batches of ``BATCH_BYTES``, a larger row by itself; the setting is put back afterwards."""
    had = spark.conf.get(_BATCH_SETTING, None)
    if had == str(BATCH_BYTES):
        yield
        return
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_SETTING) if had is None else spark.conf.set(_BATCH_SETTING, had)


def id_or_last(column: str = "doc_id"):
    """A row without an id counts as having the largest one."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def text_key(column: str = "text"):
    """Tells rows apart that repeat an id with another text; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def held_out(column: str = "doc_id"):
    """True for the quarter of the documents that training must not see; a missing id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def keeps_others(*used: str, fixed: tuple[str, ...] = ()):
    """For operators on a frame: columns they do not use pass through under names that clash with none of their own.

    ``used`` are the operator's parameters that name columns, ``fixed`` the columns it always reads. Used columns reach the
    operator under their usual names. A column of the result takes the place of a given one of its name.
    """

    def wrap(operator):
        said = inspect.signature(operator)
        frame = next(iter(said.parameters))
        usual = {p: said.parameters[p].default for p in used}

        @functools.wraps(operator)
        def call(*args, **options):
            given = said.bind(*args, **options)
            given.apply_defaults()
            df = given.arguments[frame]
            own = {given.arguments[p]: usual[p] for p in used} | {c: c for c in fixed}
            names = {c: own.get(c, f"__other{k}") for k, c in enumerate(df.columns)}
            given.arguments.update(usual)
            given.arguments[frame] = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
            out = operator(*given.args, **given.kwargs)
            back = {n: c for c, n in names.items()}
            new = {n for n in out.columns if n not in back}
            return out.select(*[F.col(f"`{n}`").alias(back.get(n, n)) for n in out.columns if back.get(n) not in new])

        return call

    return wrap


# --- texts in a batch -------------------------------------------------------------------------


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 30
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text and at most ``rows`` rows, never less than a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_offsets(batch.column(column))[1:]
        ends = ends - text_offsets(batch.column(column))[0]
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = min(max(int(np.searchsorted(ends, done + limit, "right")), at + 1), at + rows)
            yield batch.slice(at, to - at)
            at = to
        give_back()


def give_back() -> None:
    """Freed memory back to the system: workers live on between tasks, and allocators would keep their peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def text_offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = column.buffers()[1]
    if raw is None:
        return np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(raw, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; a null has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    ends = text_offsets(column)
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


# --- words as 64-bit hashes -------------------------------------------------------------------

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, np.uint64(base), np.uint64)
        steps[0] = 1
        kept = np.cumprod(steps, dtype=np.uint64)
        if size <= 1 << 23:
            _POWERS[base] = kept
    return kept[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each range of 64-bit values; it depends on the values and the length only."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, n), out=sums[1:], dtype=np.uint64)
    return mix((sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a column of texts: ``hashes`` of all words, ``first[i]:first[i + 1]`` those of row i."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = text_bytes(column)
        n = len(self.data)
        inside = np.zeros(n + 2, bool)
        inside[1 : n + 1] = ~WHITE[self.data]
        edge = np.zeros(n + 2, bool)  # a text's first byte begins a word even if the text before ended inside one
        edge[self.offsets + 1] = True
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge[1:]))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge[1:]))
        codes = _BYTE_CODES
        if lower:
            codes = codes.copy()
            codes[65:91] = codes[97:123]
        self.hashes = range_hashes(codes[self.data], self.starts, self.ends) if n else np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, row) of every run of ``size`` words of one text."""
        per = np.maximum(self.counts - size + 1, 0)
        rows = np.repeat(np.arange(len(per)), per)
        begin = np.concatenate([[0], np.cumsum(per)[:-1]]) if len(per) else np.zeros(0, np.int64)
        return self.first[:-1][rows] + np.arange(len(rows)) - begin[rows], rows


def fingerprint(*parts: bytes) -> tuple[int, int]:
    """128 bits of a digest as two signed longs."""
    d = hashlib.blake2b(b"\0".join(parts), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
