"""Count-min sketch over 64-bit keys with counters that stop at two.

Each task counts its own rows; the tasks' sketches are merged by Spark, chunk by
chunk; what is left is one bit per cell: "counted twice or more".  A key whose
cells all have the bit *may* occur repeatedly, one with a cell without it occurs
at most once, for certain: counts are never underestimated.

The merged bits go to the driver and are broadcast.  Their size follows the
number of keys and has a fixed upper bound (``MOST_BITS`` cells of one bit in each of
``DEPTH`` rows: 32 MB); beyond it more keys pass the filter, and results stay exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import U64, mix

DEPTH = 2
LEAST_BITS, MOST_BITS = 16, 27
_CHUNK = 1 << 16  # cells
SCHEMA = "part int, once binary, twice binary"


def bits_for(keys: int) -> int:
    """log2 of the cells in a row: twice the keys, within the bounds."""
    return min(MOST_BITS, max(LEAST_BITS, int(2 * max(1, keys) - 1).bit_length()))


def cells(keys: np.ndarray, bits: int, row: int) -> np.ndarray:
    low = keys if row == 0 else mix(keys + U64(0x9E3779B97F4A7C15) * U64(row))
    return (low >> U64(64 - bits)).astype(np.int64)


def _marks(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the packed bits of sorted cells, each byte once, and their bits in it."""
    byte = at >> 3
    first = np.flatnonzero(np.append(True, byte[1:] != byte[:-1])[:len(byte)])
    bit = (128 >> (at & 7)).astype(np.uint8)
    return byte[first], np.bitwise_or.reduceat(bit, first) if len(first) else bit


class Counts:
    """A task's own sketch: two bits a cell, counted and counted again."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once, self.twice = ([np.zeros((1 << bits) // 8, np.uint8) for _ in range(DEPTH)] for _ in range(2))

    @property
    def rows(self) -> list[np.ndarray]:
        """The counters, up to two, one a cell."""
        return [np.unpackbits(a) + np.unpackbits(b) for a, b in zip(self.once, self.twice, strict=True)]

    def add(self, keys: np.ndarray) -> None:
        for r, (once, twice) in enumerate(zip(self.once, self.twice, strict=True)):
            at = np.sort(cells(keys, self.bits, r))
            byte, bit = _marks(at)
            twice[byte] |= once[byte] & bit
            once[byte] |= bit
            byte, bit = _marks(at[1:][at[1:] == at[:-1]])  # hit twice by this very batch
            twice[byte] |= bit

    def parts(self) -> Iterator[pa.RecordBatch]:
        """Non-empty chunks, compressed, a few megabytes to a batch."""
        codec = pa.Codec("zstd", compression_level=1)
        size = min(_CHUNK, 1 << self.bits) // 8
        held: list[tuple[int, bytes, bytes]] = []
        for r, both in enumerate(zip(self.once, self.twice, strict=True)):
            for c, chunks in enumerate(zip(*(x.reshape(-1, size) for x in both), strict=True)):
                if chunks[0].any():
                    held.append((r << 20 | c, *(codec.compress(x.tobytes(), asbytes=True) for x in chunks)))
                if len(held) >= 256:
                    yield _batch(held)
                    held = []
        if held:
            yield _batch(held)


def _batch(held: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    part, once, twice = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(once, pa.binary()),
                                       pa.array(twice, pa.binary())], ["part", "once", "twice"])


def merged(parts: DataFrame, bits: int) -> DataFrame:
    """Chunk by chunk: the cells counted twice or more over all tasks."""
    raw = min(_CHUNK, 1 << bits) // 8

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        codec = pa.Codec("zstd")
        once, twice = np.zeros(raw, np.uint8), np.zeros(raw, np.uint8)
        for a, b in zip(group["once"], group["twice"], strict=True):
            new = np.frombuffer(codec.decompress(a, raw, asbytes=True), np.uint8)
            twice |= np.frombuffer(codec.decompress(b, raw, asbytes=True), np.uint8) | (once & new)
            once |= new
        bits_ = codec.compress(twice.tobytes(), asbytes=True)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "twice": [bits_]})

    return parts.groupBy("part").applyInPandas(merge, "part int, twice binary")


class Repeats:
    """Which keys may have been counted twice or more (packed bits, to be broadcast)."""

    def __init__(self, bits: int, parts: list[tuple[int, bytes]]):
        size = min(_CHUNK, 1 << bits)
        codec = pa.Codec("zstd")
        self.bits = bits
        self.rows = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(DEPTH)]
        for part, data in parts:
            at = (part & 0xFFFFF) * size // 8
            self.rows[part >> 20][at:at + size // 8] = np.frombuffer(
                codec.decompress(data, size // 8, asbytes=True), np.uint8)

    def may(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for r, row in enumerate(self.rows):
            at = cells(keys, self.bits, r)
            found &= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
        return found


def repeats(df: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], keys: int) -> Repeats:
    """Sketch of the keys that ``keys_of`` finds in ``df``; ``keys`` is about how many there are."""
    bits = bits_for(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(bits)
        for found in keys_of(batches):
            counts.add(found)
        yield from counts.parts()

    rows = merged(df.mapInArrow(count, SCHEMA), bits).select("part", "twice").collect()
    return Repeats(bits, [(r["part"], bytes(r["twice"])) for r in rows])


def members(df: DataFrame, key: str, keys: int) -> Repeats:
    """A filter that holds every value of column ``key``: each is counted as two."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
            yield np.concatenate([values, values])
    return repeats(df.select(F.col(key).cast("long")), found, keys)
