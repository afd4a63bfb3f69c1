"""Quality classifier: a generalised additive model with pairwise interactions.

Every document becomes a row of shares and lengths measured on its whole text.  Each
feature is cut into bins; the model is one lookup table per feature and one
two-dimensional table for each of a few feature pairs.  Training is cyclic gradient
boosting: round after round, every feature in turn gets a shallow tree over its bins (at
most three leaves), fitted to the current residuals and added to its table with a small
step, so no feature takes the credit of all others at once.  Then the pairs whose joint
bins explain most of what is left are found, and boosted the same way with trees of
one cut on either axis.  A score is the sum of table entries, through the logistic
function: looked up and added for whole batches.

Features are computed by Spark for all documents.  The tables are fitted on a bounded
sample: at most about ``max_rows`` (20,000) labelled rows that are not held out, taken by
the hash of doc_id; only their numbers reach the driver (some 20 of 8 bytes each).

Defined cases: null text is empty and gets the score of all-zero features; a null doc_id is
never trained on and counts as held out; without training rows of both classes every
score is the share of the one class found (0.5 with no rows); several labels of one document
are several rows; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_rules import text_counts
from .scratch import stored
from .text import byte_values, mix, per_row, repeated, rows_of, slices, Spans, word_hashes, words

FEATURES = ["log_words", "word_length", "symbol_share", "marked_share", "dup_line_share", "repeat_share",
            "upper_share", "digit_share", "letter_share", "stop_share", "comma_share", "line_length",
            "distinct_share", "short_share", "long_share", "other_share"]
CUT = 0.3


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES for every text of a slice."""
    n = text_counts(data, off)
    starts, ends, bounds = words(data, off)
    row = rows_of(bounds)
    hashes = word_hashes(Spans(byte_values(data)), starts, ends)
    _, new = repeated(mix(hashes + mix((row + 1).astype(np.uint64))))
    by_row = lambda flags: np.bincount(row[flags], minlength=len(off) - 1)
    length = ends - starts
    share = lambda a, b: a / np.maximum(b, 1)
    n_words, n_chars, n_lines = n["n_words"], n["word_chars"], n["n_lines"]
    return np.column_stack([
        np.log1p(n_words), share(n_chars, n_words), share(n["n_symbols"], n_chars), share(n["n_marked_words"], n_words),
        share(n["n_dup_lines"], n_lines), share(n["n_repeat_words"], n_words), share(n["n_upper"], n["n_letters"]),
        share(n["n_digits"], n_chars), share(n["n_letters"], n_chars), share(per_row(data == 46, off), n_words),
        share(per_row(data == 44, off), n_words), share(n_words, n_lines), share(by_row(new), n_words),
        share(by_row(length <= 3), n_words), share(by_row(length >= 16), n_words), share(per_row(data >= 128, off), n_chars),
    ])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, off in slices(batch.column(1)):
            found = features(data, off)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *(pa.array(found[:, i]) for i in range(len(FEATURES)))],
                ["doc_id", *FEATURES])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the features of every document."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        _measure, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return found.withColumn("held_out", F.coalesce(held, F.lit(True)))


class Gam(NamedTuple):
    base: float
    edges: list[np.ndarray]                 # per feature: where its bins are cut
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        b = self.bins(x)
        total = np.full(len(x), self.base)
        for i, table in enumerate(self.tables):
            total += table[b[:, i]]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of the best tree of at most three leaves over the bins' gradient and hessian sums."""
    def best(lo: int, hi: int) -> tuple[float, int]:
        cg, ch = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        if hi - lo < 2:
            return 0.0, lo
        gain = cg[:-1] ** 2 / (ch[:-1] + 1) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + 1) - cg[-1] ** 2 / (ch[-1] + 1)
        k = int(np.argmax(gain))
        return float(gain[k]), lo + k + 1

    gain, cut = best(0, len(g))
    cuts = [0, len(g)] if gain <= 0 else sorted({0, cut, len(g), *[c for v, c in [max(best(0, cut), best(cut, len(g)))] if v > 0]})
    values = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        values[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return values


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values per cell, and gain, of the best tree with one cut on either axis."""
    cg, ch = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    part = lambda c: (c[1:-1, 1:-1], c[1:-1, -1:] - c[1:-1, 1:-1], c[-1:, 1:-1] - c[1:-1, 1:-1],
                      c[-1, -1] - c[1:-1, -1:] - c[-1:, 1:-1] + c[1:-1, 1:-1])
    if min(g.shape) < 2:
        return np.zeros_like(g), 0.0
    gains = sum(a ** 2 / (b + 1) for a, b in zip(part(cg), part(ch), strict=True)) - cg[-1, -1] ** 2 / (ch[-1, -1] + 1)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = np.empty_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            values[rows, cols] = _leaf(g[rows, cols].sum(), h[rows, cols].sum())
    return values, float(gains[i, j])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 6, n_bins: int = 32,
        rate: float = 0.1) -> Gam:
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        return Gam(float(np.log(share / (1 - share))), [], [], [], [])
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, n_bins + 1)[1:-1])) for i in range(x.shape[1])]
    model = Gam(float(np.log(y.mean() / (1 - y.mean()))), edges, [np.zeros(len(e) + 1) for e in edges], [], [])
    b = model.bins(x)
    total = np.full(len(y), model.base)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            g, h = residual()
            step = rate * _tree(np.bincount(b[:, i], g, len(table)), np.bincount(b[:, i], h, len(table)))
            table += step
            total += step[b[:, i]]

    sizes = [len(t) for t in model.tables]

    def cells(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        g, h = residual()
        at, n = b[:, i] * sizes[j] + b[:, j], sizes[i] * sizes[j]
        shape = (sizes[i], sizes[j])
        return at, np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape)

    ranked = sorted(((_grid_tree(*cells(i, j)[1:])[1], i, j) for i in range(len(sizes)) for j in range(i)), reverse=True)
    for _, i, j in ranked[:n_pairs]:
        model.pairs.append((i, j))
        model.grids.append(np.zeros((sizes[i], sizes[j])))
    for _ in range(pair_rounds):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            at, g, h = cells(i, j)
            step = rate * _grid_tree(g, h)[0]
            grid += step
            total += step.ravel()[at]
    return model


def train(measured: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Gam:
    """The model from a hash sample of the labelled rows that are not held out."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
                           ).filter(F.col("quality").isin(0, 1))
    rows = measured.filter(~F.col("held_out")).join(marked, "doc_id")
    share = min(1.0, max_rows / max(1, rows.count()))
    some = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).select("quality", *FEATURES)
    found = np.array([tuple(r) for r in some.orderBy(*FEATURES, "quality").collect()], float).reshape(-1, len(FEATURES) + 1)
    return fit(found[:, 1:], found[:, 0])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    measured = stored(measure(docs), "quality-features")
    model = docs.sparkSession.sparkContext.broadcast(train(measured, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(i + 2).to_numpy(zero_copy_only=False) for i in range(len(FEATURES))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.value.score(x))],
                                             ["doc_id", "held_out", "score"])

    return measured.select("doc_id", "held_out", *FEATURES).mapInArrow(run, "doc_id long, held_out boolean, score double")


def op4_quality_gam(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return scored(docs, labels).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
