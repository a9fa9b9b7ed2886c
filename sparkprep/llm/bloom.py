"""Twice-seen Bloom filter over 64-bit keys, built by Spark tasks.

Two bit planes of ``2**bits`` bits: "once" has the positions that some key
reached, "twice" those reached at least two times. A key seen twice reached
all its positions twice, so testing the twice plane never misses a repeat; a
key seen once passes only by collision. Each task adds up its keys and sends
its positions by block (sorted 32-bit offsets, or the bits themselves where
those are shorter). The messages on a block are merged for ``FAN_IN`` tasks at a
time, in as many turns as it takes, while they stream in: a merging task holds
one block and reads a bounded number of messages, however many tasks there are.

The plane that is broadcast has ``2**bits / 8`` bytes at any input size (32 MiB
at the default). With more keys than the plane has room for, more unrepeated
keys pass the test and take the exact way: results stay whole.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm.common import releasing, sole_cache

BITS = 28
BLOCK_BITS = 22
PROBES = 2
FAN_IN = 64  # tasks whose messages on a block are merged by one task
FLUSH = 1 << 21  # keys a task gathers before it sends their positions

_MESSAGE = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("dense", pa.bool_()), ("once", pa.binary()), ("twice", pa.binary())])
_PLANE = pa.schema([("block", pa.int32()), ("twice", pa.binary())])


def positions(keys: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """The bit positions of each key, one array per probe."""
    mask = np.uint64((1 << bits) - 1)
    return [(keys >> np.uint64(k * bits)) & mask for k in range(PROBES)]


def _messages(keys: np.ndarray, bits: int, part: int) -> Iterator[pa.RecordBatch]:
    block_bits = min(BLOCK_BITS, bits)
    first, second = positions(keys, bits)
    found = np.sort(np.concatenate([first, second[first != second]]))  # a key reaches a position once
    new = np.append(True, found[1:] != found[:-1]) if len(found) else np.zeros(0, bool)
    once, twice = found[new], np.unique(found[~new])
    cuts = np.arange(0, (1 << (bits - block_bits)) + 1, dtype=np.uint64) << np.uint64(block_bits)
    a, b = np.searchsorted(once, cuts), np.searchsorted(twice, cuts)
    for k in np.flatnonzero(np.diff(a)):
        low = [(x[i[k]:i[k + 1]] & np.uint64((1 << block_bits) - 1)).astype(np.uint32) for x, i in ((once, a), (twice, b))]
        dense = 4 * len(low[0]) > (1 << block_bits) // 8
        out = [_bits(x, block_bits).tobytes() if dense else x.tobytes() for x in low]
        yield pa.RecordBatch.from_pydict({"block": [int(k)], "part": [part], "dense": [bool(dense)], "once": [out[0]], "twice": [out[1]]}, schema=_MESSAGE)


def _bits(at: np.ndarray, block_bits: int) -> np.ndarray:
    flags = np.zeros(1 << block_bits, np.uint8)
    flags[at] = 1
    return np.packbits(flags, bitorder="little")


def _places(packed: bytes, dense: bool) -> np.ndarray:
    if dense:
        return np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little"))
    return np.frombuffer(packed, np.uint32)


def _merge(block_bits: int, last: bool):
    """Messages sorted by (block, part), merged; the last turn gives planes."""
    def out(key, times):
        if last:
            if (times > 1).any():
                plane = zlib.compress(np.packbits(times > 1, bitorder="little").tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"block": [key[0]], "twice": [plane]}, schema=_PLANE)
        else:
            planes = [np.packbits(times >= n, bitorder="little").tobytes() for n in (1, 2)]
            yield pa.RecordBatch.from_pydict({"block": [key[0]], "part": [key[1]], "dense": [True], "once": [planes[0]], "twice": [planes[1]]}, schema=_MESSAGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, times = None, None  # 0, 1 or 2 for each position of one block
        for batch in batches:
            for block, part, dense, once, twice in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (block, part) != key:
                    if key is not None:
                        yield from out(key, times)
                    key, times = (block, part), np.zeros(1 << block_bits, np.uint8)
                at = _places(once, dense)
                times[at] = np.minimum(times[at] + 1, 2)
                times[_places(twice, dense)] = 2
        if key is not None:
            yield from out(key, times)
    return run


def merged_blocks(sent: DataFrame, blocks: int, merge: Callable, message: str, last: str) -> DataFrame:
    """Merge messages (block, part, ...) of all tasks, ``FAN_IN`` parts of a
    block at a time, in as many turns as it takes. ``merge(is_last)`` gets the
    messages of a task sorted by block and part."""
    parts = sent.rdd.getNumPartitions()
    while True:
        parts = max(1, -(-parts // FAN_IN))
        grouped = sent.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        grouped = grouped.repartition(blocks * parts, "block", "part").sortWithinPartitions("block", "part")
        if parts == 1:
            return grouped.mapInArrow(releasing(merge(True)), last)
        sent = grouped.mapInArrow(releasing(merge(False)), message)


def twice_seen(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int = BITS) -> TwiceSeen:
    """Build the filter over the 64-bit keys that ``keys_of`` draws from each
    Arrow batch of ``df``; it is broadcast to the executors."""
    def add(batches):
        held, n, part = [], 0, TaskContext.get().partitionId()
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                n += len(keys)
                if n >= FLUSH:
                    yield from _messages(np.concatenate(held), bits, part)
                    held, n = [], 0
        if n:
            yield from _messages(np.concatenate(held), bits, part)

    block_bits = min(BLOCK_BITS, bits)
    message = "block int, part int, dense boolean, once binary, twice binary"
    merged = merged_blocks(df.mapInArrow(releasing(add), message), 1 << (bits - block_bits), lambda last: _merge(block_bits, last), message, "block int, twice binary")
    # 2**bits / 8 bytes at most, whatever the input.
    planes = [(r["block"], bytes(r["twice"])) for r in merged.collect()]
    return TwiceSeen(df.sparkSession, planes, bits)


_loaded: dict[str, np.ndarray] = {}


class TwiceSeen:
    """Tests arrays of 64-bit keys on executors; plain data apart from a
    broadcast of the compressed plane."""

    def __init__(self, spark: SparkSession, planes: list[tuple[int, bytes]], bits: int):
        self.bits, self._sent, self._plane, self.name = bits, spark.sparkContext.broadcast(planes), None, uuid.uuid4().hex

    def __getstate__(self):
        return self.__dict__ | {"_plane": None}

    def maybe_repeated(self, keys: np.ndarray) -> np.ndarray:
        if self._plane is None:
            self._plane = _loaded.get(self.name)
        if self._plane is None:
            block_bits = min(BLOCK_BITS, self.bits)
            plane = np.zeros((1 << self.bits) // 8, np.uint8)
            size = (1 << block_bits) // 8
            for block, packed in self._sent.value:
                plane[block * size:(block + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)
            _loaded.clear()  # a reused worker keeps the last filter only
            sole_cache("filter", _loaded.clear)
            self._plane = _loaded[self.name] = plane
        out = np.ones(len(keys), bool)
        for at in positions(keys, self.bits):
            out &= (self._plane[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out
