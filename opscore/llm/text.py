"""Vectorised text helpers: whole texts as byte arrays, words and windows as 64-bit hashes.

The operators get Arrow batches from Spark.  ``slices`` cuts a batch into runs
of rows with about a megabyte of text (a longer text is a slice of its own), so
that the working arrays stay small whatever the batch holds; the operators whose arrays take
many times the text cut ``SLICE`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE2 = 0xC2B2AE3D27D4EB4F
SLICE = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def ids_repeat(docs: DataFrame) -> bool:
    """Do some rows share a doc_id?  Counted over all rows, on the ids alone."""
    return not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection on 64 bits)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def _powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(18, int(n).bit_length())
        steps = [np.full(size, b, U64) for b in (base, pow(base, -1, 1 << 64))]
        for s in steps:
            s[0] = 1
        have = _POWERS[base] = tuple(np.cumprod(s, dtype=U64) for s in steps)
    return have


class Spans:
    """Polynomial hashes of any span of a sequence, in constant time each."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        n = len(values)
        up, self.down = _powers(n + 1, base)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def windows(self, size: int) -> np.ndarray:
        """Hash of the window of ``size`` values from each start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, U64)
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def check_spans(values: np.ndarray) -> Spans:
    """A second, independent hash: with it a window is known by 128 bits."""
    return Spans(mix(values ^ U64(0x5851F42D4C957F2D)), _BASE2)


def slices(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; a null text is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, at, data = texts.buffers()
    off = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def words(data: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of each row's first word (one more at the end)."""
    inside = ~space[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(spans: Spans, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word, from the hashes of the slice's bytes."""
    return mix(spans(starts, ends))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each token, from the rows' first tokens."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many bytes of each row are flagged."""
    return np.array([np.count_nonzero(flags[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)], np.int64)


def covered(starts: np.ndarray, size: int, n: int, spans: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Which of ``n`` tokens lie in a window of ``size`` that begins at one of ``starts`` (distinct), or in one of
    some spans (distinct first tokens, distinct ends)."""
    step = np.zeros(n + size + 1, np.int32)
    step[starts] += 1
    step[starts + size] -= 1
    if spans is not None:
        step[spans[0]] += 1
        step[spans[1]] -= 1
    return np.cumsum(step[:n], dtype=np.int32) > 0


def distinct(keys: np.ndarray) -> np.ndarray:
    """The different keys, sorted (``np.unique`` hashes them first, which takes longer)."""
    ordered = np.sort(keys)
    return ordered[np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it found twice or more, and is it the first of its kind."""
    twice, first = np.zeros(len(keys), bool), np.ones(len(keys), bool)
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(again):
        # a small table finds the few keys that may be among those found again; only they are ordered
        low = U64(0xFFFF)
        hint = np.zeros(1 << 16, bool)
        hint[again & low] = True
        maybe = np.flatnonzero(hint[keys & low])
        order = maybe[np.argsort(keys[maybe], kind="stable")]
        same = keys[order][1:] == keys[order][:-1]
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        first[order[1:][same]] = False
    return twice, first
