"""Ranked lexical search: best-first document intervals, bounded by range-maximum queries.

Terms are runs of letters (any non-ASCII sign too) and digits, A-Z lower-cased.  The items' terms are
the vocabulary; one pass over the texts writes each document's vocabulary terms with their counts,
a second sums up the corpus statistics.  Then each task builds, for runs of its documents (a shard: at most
``SHARD`` postings and one document), posting lists in document order with the impact of every posting, which
is exact as all statistics are known, and over each list a sparse table of the place of the greatest impact in
2, 4, 8, ... postings: two reads give the maximum of any range.

For an item the whole shard is the first interval.  Its bound is the sum of its terms' maxima.
The intervals with the highest bounds are taken (``WAVE`` at once, so that arrays do the work);
each is split at its maximum-impact document, which is scored exactly, and the two sides get bounds of
their own.  An interval goes when its bound is below the item's tenth best score, or equal to it with
no smaller doc_id inside; the tenth best score is kept from shard to shard.  What a task returns is
at most ten rows an item; the ten best of all are picked in salted parts first.

Exact: nothing is sampled or capped.  64-bit hashes name terms.  Items are taken in rounds of ``ITEMS`` (and
``ITEM_BYTES`` of text, or one item), so what is broadcast is bounded.

Defined cases: a null or empty text has no term; an item without terms of any document has no rows; equal
scores go by doc_id, a null doc_id last; rows that share an id are documents, or items, of their own; empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored
from .text import LOWER, U64, Spans, byte_values, rows_of, slices, word_hashes, words

BEST = 10
ITEMS = 1024
ITEM_BYTES = 1 << 20
SHARD = 1 << 20
WAVE = 32
#: Interval positions held at once: a longer item meets a shard's documents in several ranges.
MOST_PLACES = 1 << 22
SALT = 64
_NO_ID = (1 << 63) - 1  # a null doc_id goes last
GAP = np.zeros(256, bool)
GAP[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
GAP[0x41:0x5B] = False


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the terms, index of each row's first term) by slices of rows."""
    for lo, _, data, off in slices(texts):
        data = LOWER[data]
        starts, ends, bounds = words(data, off, GAP)
        yield lo, word_hashes(Spans(byte_values(data)), starts, ends), bounds


@dataclass
class Items:
    """A round of items: their ids, terms (as places in the sorted vocabulary) and the terms' repeats."""
    ids: list[int | None]
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    times: list[np.ndarray]


def items_of(rows: list[tuple[int | None, str | None]]) -> Items:
    own: list[np.ndarray] = []
    for _, hashes, bounds in term_hashes(pa.array([t for _, t in rows], pa.string())):
        own += [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    vocabulary = np.unique(np.concatenate([*own, np.zeros(0, U64)]))
    found = [np.unique(np.searchsorted(vocabulary, h), return_counts=True) for h in own]
    return Items([i for i, _ in rows], vocabulary, [t for t, _ in found], [n for _, n in found])


def rounds(items: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in bounded lists; the driver holds one list, and one partition on the way."""
    held: list[tuple[int | None, str | None]] = []
    size = 0
    for r in items.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t")).toLocalIterator():
        if held and (len(held) == ITEMS or size + len(r["t"] or "") > ITEM_BYTES):
            yield held
            held, size = [], 0
        held.append((r["i"], r["t"]))
        size += len(r["t"] or "")
    if held:
        yield held


def counted(docs: DataFrame, vocabulary: object) -> DataFrame:
    """doc_id, n (all terms with repeats), and the vocabulary's terms with their counts, of documents with a term (stored)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            for lo, hashes, bounds in term_hashes(batch.column(1)):
                n = np.diff(bounds)
                at = np.searchsorted(known, hashes)
                at[at == len(known)] = 0
                hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
                pairs, tf = np.unique((rows_of(bounds) * len(known) + at)[hit], return_counts=True)
                row, term = np.divmod(pairs, max(1, len(known)))
                some = np.flatnonzero(n > 0)
                heads = pa.array(np.searchsorted(row, np.append(some, len(n))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(n)).take(pa.array(some)), pa.array(n[some].astype(np.int64)),
                     pa.ListArray.from_arrays(heads, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(heads, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(plain.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>"), "term-counts")


def frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["term", "df"])

    df = np.zeros(size, np.int64)
    for r in counts.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Shard:
    """Posting lists of some documents, in order of doc_id, with impacts and sparse tables of their maxima."""

    def __init__(self, ids: np.ndarray, spread: np.ndarray, heads: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.docs = ids[order], len(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        keys = terms.astype(np.int64) * self.docs + place[rows_of(heads)]
        by = np.argsort(keys)
        self.keys = keys[by]
        tf = tfs[by].astype(np.int64)
        self.doc = self.keys % max(1, self.docs)
        self.impact = weights[terms[by]] * (1_000_000_000 * tf // (1000 * tf + 8 * spread[order][self.doc]))
        longest = int(np.diff(np.searchsorted(self.keys, np.arange(len(weights) + 1) * self.docs)).max(initial=0))
        # level k: where the greatest of the 2**k impacts from each place on is, the leftmost of equal ones
        levels = [np.arange(len(self.keys), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            half = 1 << (len(levels) - 1)
            a, b = levels[-1][:-half], levels[-1][half:]
            levels.append(np.where(self.impact[a] >= self.impact[b], a, b))
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in levels])])
        self.table = np.concatenate(levels)
        self.log = np.zeros(longest + 2, np.int64)
        for k in range(1, len(levels)):
            self.log[1 << k:] = k

    def greatest(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(impact, place) of the maximum of each range of postings; 0 for an empty one."""
        size = right - left
        k = self.log[size]
        last = len(self.keys) - 1
        some = size > 0
        a = self.table[np.where(some, self.at[k] + left, 0)]
        b = self.table[np.where(some, self.at[k] + right - (1 << k), 0)]
        best = np.where(self.impact[a] >= self.impact[b], a, b)
        return np.where(some, self.impact[best], 0), np.minimum(best, last)

    def search(self, terms: np.ndarray, times: np.ndarray, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The ``BEST`` pairs (-score, doc_id) of ``best`` and this shard, in order."""
        base = terms * self.docs
        there = np.searchsorted(self.keys, base + self.docs) > np.searchsorted(self.keys, base)
        base, times = base[there], times[there]
        if len(base):
            step = max(64, MOST_PLACES // len(base))
            for lo in range(0, self.docs, step):
                best = self._range(base, times, lo, min(self.docs, lo + step), best)
        return best

    def _bounds(self, lo: np.ndarray, hi: np.ndarray, left: np.ndarray, right: np.ndarray, times: np.ndarray,
                best: list[tuple[int, int]]) -> tuple[np.ndarray, ...]:
        """The intervals that may hold one of the best documents, with bound and document to split at."""
        most, where = self.greatest(left, right)
        most = most * times
        bound = most.sum(1)
        keep = bound > 0
        if len(best) == BEST:
            least, last = -best[-1][0], best[-1][1]
            keep &= (bound > least) | ((bound == least) & (self.ids[np.minimum(lo, self.docs - 1)] < last))
        keep = np.flatnonzero(keep)
        split = self.doc[where[keep, most[keep].argmax(1)]]
        return lo[keep], hi[keep], left[keep], right[keep], bound[keep], split

    def _range(self, base: np.ndarray, times: np.ndarray, lo: int, hi: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        ends = np.searchsorted(self.keys, np.stack([base + lo, base + hi]))
        open_ = self._bounds(np.array([lo]), np.array([hi]), ends[:1], ends[1:], times, best)
        while len(open_[0]):
            lo_, hi_, left, right, bound, split = open_
            n = max(WAVE, len(bound) // 4)
            take = np.argpartition(-bound, n - 1)[:n] if len(bound) > n else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[take] = False
            at = split[take]
            want = base + at[:, None]
            place = np.searchsorted(self.keys, want)
            here = np.minimum(place, len(self.keys) - 1)
            found = (self.keys[here] == want) & (place < len(self.keys))
            score = (np.where(found, self.impact[here], 0) * times).sum(1)
            new = np.flatnonzero(score >= -best[-1][0]) if len(best) == BEST else np.arange(len(at))
            best = sorted([*best, *zip((-score[new]).tolist(), self.ids[at[new]].tolist(), strict=True)])[:BEST]
            sides = self._bounds(np.concatenate([lo_[take], at + 1]), np.concatenate([at, hi_[take]]),
                                 np.concatenate([left[take], place + found]), np.concatenate([place, right[take]]), times, best)
            if len(best) == BEST:
                least, last = -best[-1][0], best[-1][1]
                rest &= (bound > least) | ((bound == least) & (self.ids[lo_] < last))
            open_ = tuple(np.concatenate([x[rest], y]) for x, y in zip(open_, sides, strict=True))
        return best


def _spread(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of each document: its length against the mean, three quarters of it."""
    if 75 * documents * int(n.max(initial=0)) >= 1 << 63:
        return np.array([25 + 75 * int(x) * documents // terms for x in n], np.int64)
    return 25 + 75 * documents * n // max(1, terms)


def searched(counts: DataFrame, items: object, weights: np.ndarray, documents: int, terms: int, shard: int) -> DataFrame:
    """Each task's best documents of each item: item, item_id, doc_id, score, task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = items.value
        best: list[list[tuple[int, int]]] = [[] for _ in own.ids]

        def flush(held: list[tuple[np.ndarray, ...]]) -> None:
            ids, n, sizes, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            made = Shard(ids, _spread(n, documents, terms), np.concatenate([[0], np.cumsum(sizes)]), term, tf, weights)
            for i, (t, times) in enumerate(zip(own.terms, own.times, strict=True)):
                best[i] = made.search(t, times, best[i])

        held, size = [], 0
        for batch in batches:
            lists = batch.column(2)
            heads = lists.offsets.to_numpy().astype(np.int64)
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            n = batch.column(1).to_numpy(zero_copy_only=False)
            term, tf = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
            heads = heads - heads[0]
            lo = 0
            while lo < len(ids):
                hi = max(lo + 1, int(np.searchsorted(heads, heads[lo] + shard - size, "right")) - 1)
                held.append((ids[lo:hi], n[lo:hi], np.diff(heads[lo:hi + 1]), term[heads[lo]:heads[hi]], tf[heads[lo]:heads[hi]]))
                size += int(heads[hi] - heads[lo])
                lo = hi
                if size >= shard or lo < len(ids):
                    flush(held)
                    held, size = [], 0
        if held:
            flush(held)
        rows = [(i, own.ids[i], doc if doc != _NO_ID else None, -score) for i, b in enumerate(best) for score, doc in b]
        task = TaskContext.get().partitionId()
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
             pa.array(cols[3], pa.int64()), pa.array([task] * len(rows), pa.int32())], ["item", "item_id", "doc_id", "score", "task"])

    return counts.mapInArrow(run, "item int, item_id long, doc_id long, score long, task int")


def search(docs: DataFrame, items: DataFrame, shard: int = SHARD) -> DataFrame:
    """item_id, rank, doc_id, score: the ``BEST`` documents of each item with a score above 0."""
    spark = docs.sparkSession
    found = None
    for rows in rounds(items):
        own = items_of(rows)
        shared, known = spark.sparkContext.broadcast(own), spark.sparkContext.broadcast(own.vocabulary)
        counts = counted(docs, known)
        total = counts.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        documents, terms = total["n"], total["l"] or 0
        df = frequencies(counts, len(own.vocabulary))
        weights = np.array([weight(documents, int(x)) for x in df], np.int64)
        parts = searched(counts, shared, weights, documents, terms, shard).withColumn("salt", F.pmod("task", F.lit(SALT)))
        for keys in (["item", "salt"], ["item"]):
            order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
            parts = parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= BEST)
        parts = stored(parts.select("item_id", "rank", "doc_id", "score"), "ranked-search")
        found = parts if found is None else found.unionAll(parts)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def op13_impact_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items)


#: The same by brute force: every document that holds a term of an item is scored.
ORACLE_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
items AS (
  SELECT row_number() OVER () AS i, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM benchmark),
total AS (SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM docs WHERE len(terms) > 0),
postings AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * max(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, total GROUP BY term),
asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(terms) AS term FROM items) GROUP BY ALL),
spread AS (SELECT d, doc_id, 25 + (75 * len(terms) * n) // l AS m FROM docs, total WHERE len(terms) > 0),
scores AS (
  SELECT i, d, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN spread USING (d) GROUP BY ALL),
ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 10
"""
