"""Quality rules with risk-controlled thresholds.

Each rule is a share measured on the whole text that speaks against a document
when it is high (symbols, repeated lines, shouting, ...), in units of a fixed
reference value; a document's severity is the largest of them.  The cutoff of
the severity is not guessed: it is tested on the labelled rows.  Within a
stratum (a band of document length) the candidate cutoffs form a fixed sequence,
the loosest first.  For each one the number k of good documents (``quality`` =
1, base rules passed) that it would reject out of n gives an exact binomial
upper bound (Clopper-Pearson) of its false rejection rate.  A cutoff is admitted
only while all looser ones are and its bound stays within ``risk``.  Testing in
a fixed order needs no correction within a stratum; over the strata the error
probability ``delta`` is divided (Bonferroni), so with probability 1 - delta no
stratum loses more than ``risk`` of its good documents.  Of the admitted cutoffs
the one taken rejects most bad documents net of ``good_weight`` times the good
ones, the loosest of equals; a stratum where none gains has no cutoff.

Defined cases: null text counts as empty (no words, base_failed); without
labelled rows, or with too few for any bound, no cutoff is admitted and only the
base rules decide; a share with nothing to divide by is 0; several labels of one
document count as several rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .scratch import drop, stored
from .text import SPACE, Spans, byte_values, covered, ids_repeat, mix, per_row, repeated, rows_of, slices, word_hashes, words

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_letters", "n_digits", "n_marked_words"]
RULES = {  # share: (of, over, reference value)
    "symbol_share": ("n_symbols", "word_chars", 0.1),
    "marked_share": ("n_marked_words", "n_words", 0.3),
    "dup_line_share": ("n_dup_lines", "n_lines", 0.6),
    "repeat_share": ("n_repeat_words", "n_words", 0.5),
    "upper_share": ("n_upper", "n_letters", 0.6),
    "digit_share": ("n_digits", "word_chars", 0.5),
}
#: Candidate cutoffs, loosest first; fixed before any label is seen.
CUTS = [3.0, 2.5, 2.0, 1.75, 1.5, 1.25, 1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]
#: Strata: documents with fewer words than the first number, than the second, ...
BANDS = [250, 1000]

_OWN = "__quality_"  # before the names of columns that stand beside the caller's own

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = _SYMBOL.copy()
_MARK[33] = True
_UPPER, _DIGIT, _LETTER = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = True


def text_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The numbers in COUNTS for every row of a slice."""
    n_rows = len(off) - 1
    starts, ends, bounds = words(data, off)
    row = rows_of(bounds)
    spans = Spans(byte_values(data))
    hashes = word_hashes(spans, starts, ends)
    marked = np.zeros(len(starts), bool)
    marked[np.searchsorted(starts, np.flatnonzero(_MARK[data]), "right") - 1] = True

    # lines: cut at \n and at the rows' ends
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([off[:-1], breaks + 1]))
    line_end = np.sort(np.concatenate([breaks, off[1:]]))
    line_row = np.searchsorted(off[:-1], line_start, "right") - 1
    empties = np.flatnonzero(np.diff(off) == 0)
    if len(empties):  # rows without text have one empty line each, at the place of their neighbour
        line_row = np.repeat(np.arange(n_rows), per_row(data == 10, off) + 1)
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_hash = mix(spans(line_start, line_end) ^ mix((line_row + 1).astype(np.uint64)))
    line_hash, line_row = line_hash[has_word], line_row[has_word]
    _, first_line = repeated(line_hash)

    grams = mix(Spans(hashes).windows(3) + mix((row[:max(0, len(row) - 2)] + 1).astype(np.uint64)))
    whole = np.flatnonzero(row[:len(grams)] == row[2:2 + len(grams)]) if len(grams) else np.zeros(0, np.int64)
    twice, _ = repeated(grams[whole])
    in_repeat = covered(whole[twice], 3, len(hashes))

    by_row = lambda r, w=None: np.bincount(r, w, n_rows).astype(np.int64)
    return {
        "n_words": np.diff(bounds), "word_chars": per_row(~SPACE[data] & ((data & 0xC0) != 0x80), off),
        "n_symbols": per_row(_SYMBOL[data], off), "n_dup_lines": by_row(line_row[~first_line]),
        "n_repeat_words": by_row(row, in_repeat), "n_lines": by_row(line_row),
        "n_upper": per_row(_UPPER[data], off), "n_letters": per_row(_LETTER[data], off),
        "n_digits": per_row(_DIGIT[data], off), "n_marked_words": by_row(row, marked),
    }


def _measure_beside(text: str):
    """The rows with their counts beside them, under names with ``_OWN`` before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(batch.schema.get_field_index(text))):
                found, part = text_counts(data, off), batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(found[c], pa.int64()) for c in COUNTS)],
                                                 [*part.schema.names, *(_OWN + c for c in COUNTS)])
    return run


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi, data, off in slices(texts):
            found = text_counts(data, off)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), *(pa.array(found[c], pa.int64()) for c in COUNTS)], ["doc_id", *COUNTS])


def _band(n_words: Column) -> Column:
    band = F.lit(len(BANDS))
    for i in reversed(range(len(BANDS))):
        band = F.when(n_words < BANDS[i], i).otherwise(band)
    return band


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, the shares, the base verdict and the stratum of each document."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return _rated(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_measure, schema))


def _rated(counted: DataFrame, own: str = "") -> DataFrame:
    """Counts with the shares, the base verdict, the stratum and the severity; all names begin with ``own``."""
    col = lambda name: F.col(own + name)
    shares = {own + r: F.when(col(b) > 0, col(a) / col(b)).otherwise(0.0) for r, (a, b, _) in RULES.items()}
    failed = (col("n_words") < 50) | (100 * col("n_repeat_words") > 50 * col("n_words"))
    return counted.withColumns(shares | {own + "base_failed": failed, own + "band": _band(col("n_words"))}).withColumn(
        own + "severity", F.greatest(*(col(r) / ref for r, (_, _, ref) in RULES.items())))


def _judged(rated: DataFrame, cutoffs: dict[int, float], own: str = "") -> DataFrame:
    """Rated rows with their cutoff and whether they are kept."""
    cutoff = F.lit(None).cast("double")
    for band, cut in cutoffs.items():
        cutoff = F.when(F.col(own + "band") == band, cut).otherwise(cutoff)
    within = F.col(own + "cutoff").isNull() | (F.col(own + "severity") <= F.col(own + "cutoff"))
    return rated.withColumn(own + "cutoff", cutoff).withColumn(own + "kept", ~F.col(own + "base_failed") & within)


def upper_bound(k: int, n: int, error: float) -> float:
    """Exact (Clopper-Pearson) upper bound of a rate of which k of n cases are seen: P(X <= k) = error."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]

    def tail(p: float) -> float:
        terms = [c + i * math.log(p) + (n - i) * math.log1p(-p) for i, c in enumerate(logs)]
        most = max(terms)
        return math.exp(most) * math.fsum(math.exp(t - most) for t in terms)

    lo, hi = k / n, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        if mid in (lo, hi) or mid <= 0 or mid >= 1:
            break
        lo, hi = (mid, hi) if tail(mid) > error else (lo, mid)
    return hi


def choose(tally: dict[int, tuple[int, list[int], list[int]]], risk: float, delta: float,
           good_weight: float) -> dict[int, float]:
    """Cutoff by band from (good rows, good rejected by each cut, bad rejected by each cut)."""
    cutoffs = {}
    for band, (n, good, bad) in tally.items():
        best = 0.0
        for cut, k, caught in zip(CUTS, good, bad, strict=True):
            if upper_bound(k, n, delta / (len(BANDS) + 1)) > risk:
                break
            if caught - good_weight * k > best:
                best, cutoffs[band] = caught - good_weight * k, cut
    return cutoffs


def fit(measured: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05,
        good_weight: float = 5.0) -> dict[int, float]:
    """Cutoffs from all labelled rows, counted by Spark.

    What reaches the driver is one row per band and quality: at most six,
    whatever the input.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter(
        F.col("quality").isin(0, 1))
    counted = measured.filter(~F.col("base_failed")).join(marked, "doc_id").groupBy("band", "quality").agg(
        F.count("*").alias("n"),
        *(F.sum((F.col("severity") > c).cast("long")).alias(f"c{i}") for i, c in enumerate(CUTS))).collect()
    by = {(r["band"], r["quality"]): (r["n"], [r[f"c{i}"] for i in range(len(CUTS))]) for r in counted}
    none = (0, [0] * len(CUTS))
    tally = {band: (*by.get((band, 1), none), by.get((band, 0), none)[1]) for band in range(len(BANDS) + 1)}
    return choose(tally, risk, delta, good_weight)


def verdicts(docs: DataFrame, labels: DataFrame, **how: float) -> DataFrame:
    """One row per document: doc_id, counts, base_failed, kept and the rules that spoke against it."""
    measured = stored(measures(docs), "quality-measures")
    broken = F.array(*(F.when(F.col(r) / ref > F.col("cutoff"), F.lit(r)) for r, (_, _, ref) in RULES.items()))
    return _judged(measured, fit(measured, labels, **how)).withColumn(
        "broken_rules", F.array_join(F.array_sort(F.array_compact(broken)), ","))


def op1_quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest that the query returns."""
    return verdicts(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "severity", "cutoff", "broken_rules")


def keep_good(docs: DataFrame, labels: DataFrame, **how: float) -> DataFrame:
    """Pipeline stage: the documents that are kept, all columns; of rows that share a doc_id all, if one is.

    Where no rows share a doc_id a row's own counts decide: it is measured once more beside its
    columns, and no text is shuffled.
    """
    if not ids_repeat(docs.select(F.col("doc_id").cast("long").alias("doc_id"))):
        measured = stored(measures(docs), "quality-measures")
        cutoffs = fit(measured, labels, **how)
        drop(measured)
        schema = StructType([*docs.schema.fields, *(StructField(_OWN + c, LongType()) for c in COUNTS)])
        counted = docs.mapInArrow(_measure_beside("text"), schema)
        return _judged(_rated(counted, _OWN), cutoffs, _OWN).filter(F.col(_OWN + "kept")).select(*docs.columns)
    good = verdicts(docs, labels, **how).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(good, F.col("doc_id").cast("long").eqNullSafe(F.col("__kept")), "left_semi")
