"""Anchors: content-defined sample positions that stand for all windows around them.

A window of ``size`` tokens holds ``size - gram + 1`` grams of ``gram`` tokens;
its anchor is the one with the smallest hash, the leftmost of equals.  The
anchor depends on nothing but the window's own content, so two equal windows
have equal anchors at equal offsets: a window cannot occur more often than its
anchor gram does at distinct positions.  Neighbouring windows mostly share their
anchor, so anchors are several times fewer than windows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .text import U64, Spans, check_spans, mix

_AT = U64((1 << 31) - 1)  # a text has less than 2**31 bytes


class Runs(NamedTuple):
    """Runs of neighbouring windows of one row that share an anchor."""

    first: np.ndarray   # first token of the run's first window
    last: np.ndarray    # first token of its last window
    row: np.ndarray
    gram: np.ndarray    # hash of the anchor gram
    spans: Spans
    values: np.ndarray

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First token and run of every window of some runs."""
        count = self.last[which] - self.first[which] + 1
        run = np.repeat(which, count)
        before = np.cumsum(count) - count
        return self.first[run] + np.arange(len(run)) - np.repeat(before, count), run


def runs(values: np.ndarray, bounds: np.ndarray, size: int, gram: int) -> Runs:
    """The runs of a slice; ``bounds`` are the rows' first tokens (one more at the end)."""
    spans = Spans(values)
    grams = mix(spans.windows(gram))
    width = size - gram + 1
    n = len(grams) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, np.zeros(0, U64), spans, values)
    least = (grams & ~_AT) | np.arange(len(grams), dtype=U64)
    have = 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:n], least[width - have:width - have + n])
    cut = np.zeros(n, bool)
    cut[0] = True
    cut[1:] = least[1:] != least[:-1]
    for at in (bounds, bounds - size + 1):
        cut[at[(at >= 0) & (at < n)]] = True
    cuts = np.flatnonzero(cut)
    row = np.searchsorted(bounds, cuts, "right") - 1
    last = np.append(cuts[1:], n) - 1
    whole = np.flatnonzero((row < len(bounds) - 1) & (cuts + size <= bounds[np.minimum(row + 1, len(bounds) - 1)]))
    first = cuts[whole]
    return Runs(first, last[whole], row[whole], grams[(least[first] & _AT).astype(np.int64)], spans, values)


def window_keys(r: Runs, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits that name the content of some spans: a 64-bit hash and an independent 32-bit one."""
    if not len(starts):
        return np.zeros(0, U64), np.zeros(0, np.uint32)
    check = mix(check_spans(r.values)(starts, ends)) >> U64(32)
    return mix(r.spans(starts, ends)), check.astype(np.uint32)
