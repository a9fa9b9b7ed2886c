"""Helpers shared by the training-data operators.

Tables that a later pass reads again are written once to the folder named by
``spark.checkpoint.dir`` (:func:`stored`), so a lost executor costs a re-read,
never a replay of earlier passes, and no pass depends on local disks.

Text kernels work on whole Arrow batches as byte buffers: :func:`text_chunks`
yields bounded pieces of a batch, :class:`Words` tokenises a piece and hashes
all its words at once.
"""

from __future__ import annotations

import ctypes
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.session import shared_path

# Bytes of text a kernel works on at a time; one longer text is one piece.
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ASCII_LOWER = bytes(LOWER)
ASCII_SPACE = b" \t\n\x0b\x0c\r"


# Bytes of one Arrow batch that Spark sends to a worker, where the session leaves
# the default: both ends hold several batches of every running task.
BATCH_BYTES = 4 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches end at ``BATCH_BYTES`` unless the session has a size of its own."""
    if spark.conf.get(_BATCH_SETTING).rstrip("bB") == str(_BATCH_DEFAULT):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def run_once(spark: SparkSession):
    """Plans that run inside are run once: their shuffle files are deleted when they
    end, not when the driver's garbage collector finds them."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def stored(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back. ``row_group`` bytes are
    held by a task that writes or reads it; without it as many as the session says."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with run_once(spark):
        (df.write if row_group is None else df.write.option("parquet.block.size", row_group)).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def dropped(table: DataFrame) -> None:
    """Delete the files of a :func:`stored` table that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def nested_row(df: DataFrame) -> DataFrame:
    """All columns of ``df`` in one struct ``row``: helper columns added beside
    it cannot clash with the caller's names."""
    bounded_batches(df.sparkSession)
    return df.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("row"))


def field(name: str):
    """Column ``row.<name>`` whatever characters the name holds."""
    return F.col("row").getField(name)


def ascii_lower(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- Workers -------------------------------------------------------------------

_kept: dict[str, object] = {}
try:  # gives freed memory back to the system; glibc only
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):
    _trim = None


def sole_cache(name: str, clear=lambda: None) -> None:
    """Called by tasks: what the worker process keeps from other operators' tasks
    is cleared, so a reused worker holds the tables of one operator at a time."""
    for other in [k for k in _kept if k != name]:
        _kept.pop(other)()
    if name not in _kept:
        release()
    _kept[name] = clear


def release() -> None:
    """Give the worker's freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def releasing(run):
    """``run`` over a task's batches, then :func:`release`: idle workers hold what
    their process keeps, not the most that a task needed."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return task


# -- Arrow ---------------------------------------------------------------------

def bytes_and_offsets(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary Arrow column and the n+1 offsets of
    its values; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def text_chunks(column, limit: int = CHUNK_BYTES, most: int = 1 << 14):
    """Yield (first row, last row + 1, bytes, offsets) over consecutive rows
    of a text column, about ``limit`` bytes and at most ``most`` rows each;
    whole texts, never cut."""
    data, at = bytes_and_offsets(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = int(np.searchsorted(at, at[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + most, n)
        yield i, j, data[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


# -- Hashing -------------------------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15 | 3)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, P, P^2, ... modulo 2^64; the first ``n`` at least."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            p = np.full(max(n, 1024), _P, np.uint64)
            p[0] = 1
            _powers = np.cumprod(p, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that any bits of them can be used."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(30))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h = h ^ (h >> np.uint64(27))
        h = h * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class Words:
    """The words of consecutive texts: maximal runs of bytes in a class.

    starts, ends: byte positions in the piece; hashes: 64-bit hash of each
    word's bytes; doc: number of the text each word is in; first: index of
    each text's first word, with one more at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray, lower: bool = True):
        data = LOWER[data] if lower else data
        self.data = data
        mask = in_word[data]
        before = np.empty(len(mask), bool)
        if len(mask):
            before[0] = False
            before[1:] = mask[:-1]
            heads = offsets[:-1]
            before[heads[heads < len(mask)]] = False
        starts = np.flatnonzero(mask & ~before)
        packed = data[mask]
        place = np.cumsum(mask, dtype=np.int64)
        at = place[starts] - 1 if len(starts) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(at, len(packed)))
        self.starts, self.lengths = starts, lengths
        if len(starts):
            inside = np.arange(len(packed)) - np.repeat(at, lengths)
            with np.errstate(over="ignore"):
                terms = BYTE[packed] * powers(int(lengths.max()))[inside]
                self.hashes = mix(np.add.reduceat(terms, at))
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.first = np.searchsorted(starts, offsets)
        self.first[-1] = len(starts)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.counts)

    @property
    def ends(self) -> np.ndarray:
        return self.starts + self.lengths


def byte_class(pattern_bytes) -> np.ndarray:
    """Look-up table that is true for the given byte values."""
    out = np.zeros(256, bool)
    out[list(pattern_bytes)] = True
    return out


# Everything but ASCII white space; and ASCII digits, lower-case letters and
# every byte of a non-ASCII character.
NOT_SPACE = ~byte_class(ASCII_SPACE)
ALNUM = byte_class([*range(48, 58), *range(97, 123), *range(128, 256)])


def ngram_hashes(hashes: np.ndarray, first: np.ndarray, n: int, short: bool = True):
    """Hashes of the n-grams over each text's words, and the text of each.

    A text of fewer than ``n`` words, but not none, gives its whole sequence as
    one item when ``short``.
    """
    counts = np.diff(first)
    with np.errstate(over="ignore"):
        p = powers(n + 1)
        docs = np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))
        inner = np.maximum(counts - n + 1, 0)
        base = np.cumsum(inner) - inner
        begin = np.arange(int(inner.sum())) - np.repeat(base, inner) + np.repeat(first[:-1], inner)
        out = np.zeros(len(begin), np.uint64)
        for k in range(n):
            out += hashes[begin + k] * p[k]
        out += np.uint64(n)
        if short:
            few = np.flatnonzero((counts > 0) & (counts < n))
            extra = np.zeros(len(few), np.uint64)
            for k in range(n - 1):
                has = counts[few] > k
                extra[has] += hashes[first[few[has]] + k] * p[k]
            extra += counts[few].astype(np.uint64)
            out, docs = np.append(out, extra), np.append(docs, few)
    return mix(out), docs
