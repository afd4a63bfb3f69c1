"""Hard-negative mining with rotated one-bit codes and certain score intervals.

Vectors become whole numbers (``floor(256 x)``) and are turned by one random orthogonal matrix.  A turned
vector v is stored as one-bit codes: s_1 holds the signs of v, its alignment a_1 = <v, s_1> / D with them gives
what is left, v - a_1 s_1, which gets signs of its own, and so on for ``CODES`` codes; the last
remainder is known by its length e.  v = a_1 s_1 + ... + r, |r| = e.

An anchor q is held as ``PLANES`` bit planes of its turned components.  <q, s_k> follows from the popcounts
of the planes and the code (``q`` differs from its planes by a vector of known length d).  By Cauchy-Schwarz

    |<q, v> - sum of a_k <planes, s_k>|  <=  d * |v - r| + |q| * e

whatever the vectors are: the interval is certain, not likely.  A first interval uses one code; pairs that it does
not decide get the others.  Pairs whose interval cannot matter are dropped, all others
are scored with integers, so the results are exact and only the speed depends on the codes.

Positives: a pass over all rows keeps, in each task, an anchor's ``POSITIVES`` best rows of its label; the
worst of them bounds what a later interval must reach.  The tasks' rows meet in a ranking by anchor.  Negatives: a
second pass does the same for each anchor and positive, within the window that the positive's score opens.
Anchors are taken in rounds of ``ANCHORS``, which are broadcast (bounded; a stated query set against all
rows, in blocks); their ids come from a range of hashes, so no round needs a sort of all anchors.

Defined cases: rows with a null label or vector, or a null, NaN or infinite component (also one that is not finite
after scaling) take no part; a shorter vector ends in zeros; a null vec_id is no anchor, keeps its label and comes first among
equal scores; rows that share a vec_id are rows of their own (each an anchor, and a positive of the
other); a score beyond 64 bits counts as the nearest 64-bit number; anchors without positives, or positives without negatives, have no row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

POSITIVES, NEGATIVES = 5, 3
ANCHORS = 16_384
CODES = 4
PLANES = 7
SEED = 20240607
SALT = 64
#: Rows and anchors whose intervals are computed at once.
BLOCK = 1024
#: Below this share of open pairs only those are looked at.
SPARSE = 0.2
_NO_ID = -(1 << 63)


def rotation(size: int) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1).view(np.uint64)


@dataclass
class Codes:
    """One-bit codes of turned vectors: words (code, row, word), alignments (code, row) and what each code leaves."""
    words: np.ndarray
    align: np.ndarray
    length: np.ndarray
    left: np.ndarray

    @staticmethod
    def of(turned: np.ndarray, codes: int = CODES) -> "Codes":
        size = max(1, turned.shape[1])
        rest, words, align, left = turned.copy(), [], [], []
        for _ in range(codes):
            bits = rest >= 0
            signs = np.where(bits, 1.0, -1.0)
            a = np.abs(rest).sum(1) / size
            rest = rest - a[:, None] * signs
            words.append(_packed(bits))
            align.append(a)
            left.append(np.sqrt((rest * rest).sum(1)))
        return Codes(np.array(words), np.array(align), np.sqrt((turned * turned).sum(1)), np.array(left))


@dataclass
class Planes:
    """Anchors as bit planes: component = low + step * sum of 2**p * bit p, up to a remainder of known length."""
    words: np.ndarray
    low: np.ndarray
    step: np.ndarray
    ones: np.ndarray
    length: np.ndarray
    error: np.ndarray

    @staticmethod
    def of(turned: np.ndarray, planes: int = PLANES) -> "Planes":
        low, high = (f(axis=1, initial=0) for f in (turned.min, turned.max))
        step = np.maximum((high - low) / ((1 << planes) - 1), 1e-300)
        level = np.clip(np.rint((turned - low[:, None]) / step[:, None]), 0, (1 << planes) - 1).astype(np.int64)
        error = turned - low[:, None] - step[:, None] * level
        words = np.array([_packed((level >> p & 1).astype(bool)) for p in range(planes)])
        return Planes(words, low, step, level.sum(1), np.sqrt((turned * turned).sum(1)), np.sqrt((error * error).sum(1)))


def _counts(a: np.ndarray, b: np.ndarray, paired: bool) -> np.ndarray:
    """Popcounts of a & b, of all rows with all or of pairs of rows."""
    total = 0
    for x, y in zip(a.T, b.T, strict=True):
        total = total + np.bitwise_count((x if paired else x[:, None]) & y).astype(np.int32)
    return total


def _sign_sums(planes: Planes, anchors: slice | np.ndarray, code: np.ndarray, size: int, paired: bool) -> np.ndarray:
    """<planes, signs> of each anchor with each code, or of pairs of them, from popcounts."""
    set_ = np.bitwise_count(code).sum(1, dtype=np.int32)
    both = sum(_counts(words[anchors], code, paired) << p for p, words in enumerate(planes.words))
    low, step, ones = (x[anchors] if paired else x[anchors][:, None] for x in (planes.low, planes.step, planes.ones))
    # a set bit of the code counts +1, an unset one -1
    return low * (2 * set_ - size) + step * (2 * both - ones)


class Rows:
    """A block of rows: whole-number vectors, labels, ids, row numbers and codes."""

    def __init__(self, vectors: np.ndarray, label: np.ndarray, ids: np.ndarray, row: np.ndarray, turn: np.ndarray):
        self.vectors, self.label, self.ids, self.row = vectors, label, ids, row
        with np.errstate(over="ignore", invalid="ignore"):
            self.codes = Codes.of(vectors @ turn)

    def candidates(self, planes: Planes, anchors: slice, least: np.ndarray, most: np.ndarray, wanted: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) pairs that are wanted and whose score may lie from ``least`` to ``most`` of the anchor.

        Code by code: for all pairs of the block while many are open, then for the open ones alone.
        """
        c, size = self.codes, self.vectors.shape[1]
        open_, guess, k = wanted, np.zeros(wanted.shape), 0
        with np.errstate(over="ignore", invalid="ignore"):
            while k < len(c.words) and open_.mean() > SPARSE:
                guess += c.align[k] * _sign_sums(planes, anchors, c.words[k], size, False)
                open_ = open_ & ~self._out(planes, anchors, k, slice(None), guess, least, most, False)
                k += 1
            anchor, row = np.nonzero(open_)
            guess = guess[anchor, row]
            anchor = anchor + anchors.start
            for k in range(k, len(c.words)):
                guess = guess + c.align[k, row] * _sign_sums(planes, anchor, c.words[k, row], size, True)
                keep = ~self._out(planes, anchor, k, row, guess, least, most, True)
                anchor, row, guess = anchor[keep], row[keep], guess[keep]
        return anchor, row

    def _out(self, planes: Planes, anchors: slice | np.ndarray, k: int, rows: slice | np.ndarray, guess: np.ndarray,
             least: np.ndarray, most: np.ndarray, paired: bool) -> np.ndarray:
        """Is the interval certainly outside?  (An unknown one, NaN, is not.)"""
        c = self.codes
        own = (lambda x: x[anchors]) if paired else (lambda x: x[anchors][:, None])
        known, left = c.length[rows] + c.left[k, rows], c.left[k, rows]  # known: at least the length of what the codes say
        # the last terms are more than what rounding can do
        wide = own(planes.error) * known + own(planes.length) * left + 1e-9 * own(planes.length) * known + 1e-6
        return (guess + wide < own(least)) | (guess - wide > own(most))


TOP = (1 << 63) - 1


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of pairs of whole-number vectors, exact whatever their size, but for the 64 bits of a result."""
    with np.errstate(over="ignore"):
        x, y = np.abs(a).max(initial=0), np.abs(b).max(initial=0)
        if max(x, y) < 1 << 53 and x * y * max(1, a.shape[1]) < 1 << 62:
            return np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
    exact = (sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True))
    return np.array([max(-TOP - 1, min(TOP, s)) for s in exact], np.int64)


class Best:
    """The first ``most`` rows of each key: highest score, then smallest id."""

    def __init__(self, keys: int, most: int):
        self.most = most
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # key, score, id, row
        self.worst = np.full(keys, -np.inf)  # what a further row has to reach

    def add(self, found: list[tuple[np.ndarray, ...]]) -> None:
        key, score, ids, row = (np.concatenate(x) for x in zip(self.held, *found, strict=True))
        by = np.lexsort((row, ids, ~score, key))
        ordered = key[by]
        nth = np.arange(len(by)) - np.searchsorted(ordered, ordered)
        keep = by[nth < self.most]
        self.held = [x[keep] for x in (key, score, ids, row)]
        full = by[nth == self.most - 1]
        self.worst[key[full]] = np.where(score[full] == -TOP - 1, -np.inf, score[full].astype(float) * (1 - 2.0 ** -50 * np.sign(score[full])))

    def batch(self, name: str) -> pa.RecordBatch:
        key, score, ids, row = self.held
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int32()), pa.array(row, pa.int64()), pa.array(ids, pa.int64(), mask=ids == _NO_ID),
             pa.array(score, pa.int64()), pa.array(np.full(len(key), TaskContext.get().partitionId()), pa.int32())],
            [name, "row", "vec_id", "score", "task"])


@dataclass
class Round:
    """Anchors of a round: whole-number vectors, labels, ids, row numbers."""
    vectors: np.ndarray
    label: np.ndarray
    ids: np.ndarray
    row: np.ndarray
    turn: np.ndarray

    def planes(self) -> Planes:
        with np.errstate(over="ignore", invalid="ignore"):
            return Planes.of(self.vectors @ self.turn)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(row, vec_id, label, vector) of the rows that take part (stored), and the length of the longest vector."""
    label, vec = F.col("label").cast("long"), F.col("vec_id").cast("long")
    some = vectors.select(vec.alias("vec_id"), F.when(vec % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                          F.col("embedding").cast("array<double>").alias("vector")).filter(
        F.col("label").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (256.0 * F.abs(x) < float("inf"))))
    some = stored(some.select(F.monotonically_increasing_id().alias("row"), "*"), "usable-vectors")
    return some, some.agg(F.max(F.size("vector"))).first()[0] or 0


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    """Lists as rows of whole numbers of one length, ended by zeros."""
    heads = column.offsets.to_numpy().astype(np.int64)
    n = np.diff(heads)
    values = np.floor(256.0 * column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(n), size))
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(values)) - np.repeat(heads[:-1] - heads[0], n)] = values
    return out


def _read(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, ...]:
    get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    return (_matrix(batch.column("vector"), size), get("label"), batch.column("vec_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False),
            get("row"))


def _blocks(batches: Iterator[pa.RecordBatch], size: int, turn: np.ndarray) -> Iterator[Rows]:
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            yield Rows(*_read(batch.slice(lo, BLOCK), size), turn)


def _slices(n: int) -> Iterator[slice]:
    for lo in range(0, n, BLOCK):
        yield slice(lo, min(n, lo + BLOCK))


def positives(rows: DataFrame, shared: object, size: int) -> DataFrame:
    """The best rows of each anchor's label: anchor (its place in the round), row, vec_id, score, rank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Round = shared.value
        planes, n = own.planes(), len(own.ids)
        best, top = Best(n, POSITIVES), np.full(n, np.inf)
        for block in _blocks(batches, size, own.turn):
            found = []
            for part in _slices(n):
                wanted = (own.label[part][:, None] == block.label) & (own.row[part][:, None] != block.row)
                anchor, row = block.candidates(planes, part, best.worst, top, wanted)
                found.append((anchor, scores(own.vectors[anchor], block.vectors[row]), block.ids[row], block.row[row]))
            best.add(found)
        yield best.batch("anchor")

    return _first(rows.mapInArrow(run, "anchor int, row long, vec_id long, score long, task int"), "anchor", POSITIVES)


def _first(found: DataFrame, key: str, most: int) -> DataFrame:
    """The first rows of each key over all tasks: in salted parts, then of all (rank from 1)."""
    found = found.withColumn("salt", F.pmod("task", F.lit(SALT)))
    for by in ([key, "salt"], [key]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_first(), "row")
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return found.drop("salt", "task")


def negatives(rows: DataFrame, shared: object, opened: object, size: int) -> DataFrame:
    """The best rows of other labels in the window of each positive: pair (its place), row, vec_id, score, rank.

    ``opened``: for each positive its anchor (in order), and the least and the largest score of a negative.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Round = shared.value
        of, least, most = opened.value
        planes, n = own.planes(), len(own.ids)
        first = np.searchsorted(of, np.arange(n + 1))
        best = Best(len(of), NEGATIVES)
        # as floats, on the safe side
        low, high = least - np.abs(least) * 2.0 ** -50, most + np.abs(most) * 2.0 ** -50
        low[least == -TOP - 1], high[most == TOP] = -np.inf, np.inf
        for block in _blocks(batches, size, own.turn):
            # what any positive of an anchor may still use
            floor, top = np.full(n, np.inf), np.full(n, -np.inf)
            np.minimum.at(floor, of, np.maximum(low, best.worst))
            np.maximum.at(top, of, high)
            found = []
            for part in _slices(n):
                wanted = (own.label[part][:, None] != block.label) & (floor[part] <= top[part])[:, None]
                anchor, row = block.candidates(planes, part, floor, top, wanted)
                score = scores(own.vectors[anchor], block.vectors[row])
                times = first[anchor + 1] - first[anchor]
                at = np.repeat(np.arange(len(anchor)), times)
                pair = np.repeat(first[anchor], times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                fits = np.flatnonzero((score[at] >= least[pair]) & (score[at] <= most[pair]))
                at, pair = at[fits], pair[fits]
                found.append((pair, score[at], block.ids[row[at]], block.row[row[at]]))
            best.add(found)
        yield best.batch("pair")

    return _first(rows.mapInArrow(run, "pair int, row long, vec_id long, score long, task int"), "pair", NEGATIVES)


def window(score: int) -> tuple[int, int]:
    """Least and largest score of a negative: 50 * positive <= 100 * negative <= 95 * positive."""
    return -(-50 * score // 100), 95 * score // 100


def mine(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    context = spark.sparkContext
    rows, size = usable(vectors)
    anchors = rows.filter(F.col("vec_id") % 50 == 0)
    count = anchors.count()
    turn = rotation(size)
    parts = -(-2 * count // ANCHORS) if count > ANCHORS else 1  # by hash: about half of the bound each
    found = None
    for k in range(parts):
        some = anchors.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == k).toArrow().combine_chunks()
        if not some.num_rows:
            continue
        matrix, label, ids, row = _read(some.to_batches()[0], size)
        shared = context.broadcast(Round(matrix, label, ids, row, turn))
        ranked = positives(rows, shared, size).toArrow().sort_by([("anchor", "ascending"), ("rank", "ascending")])
        of, score = (ranked[c].to_numpy() for c in ("anchor", "score"))
        least, most = np.array([window(s) for s in score.tolist()], np.int64).reshape(-1, 2).T
        opened = context.broadcast((of, least, most))
        near = stored(negatives(rows, shared, opened, size), "hard-negatives")
        pairs = spark.createDataFrame(pa.table({"pair": pa.array(np.arange(len(of)), pa.int32()), "anchor_id": ids[of],
                                                "positive_id": ranked["vec_id"], "positive_score": score}))
        out = near.join(pairs, "pair").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                                              "positive_score", F.col("score").alias("negative_score"))
        found = out if found is None else found.unionAll(out)
    if found is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return found


def op12_hard_negatives(vectors: DataFrame) -> DataFrame:
    return mine(vectors)


#: The same by brute force: every row is scored for every anchor (vectors of one length).
ORACLE_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS FIRST, b) AS nth FROM scored WHERE same),
near AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id NULLS FIRST, n.b) AS rank
  FROM positives p JOIN scored n ON n.a = p.a
  WHERE p.nth <= 5 AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM near WHERE rank <= 3
"""
