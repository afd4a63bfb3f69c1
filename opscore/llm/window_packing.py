"""Packing of token sequences into full windows by non-negative least squares.

Documents become token ids, a closing id follows.  Whole windows of a long document are
sequences of their own; what remains, 1 to ``window`` - 1 tokens, is packed:

* Histogram: how many rests have each length, at most ``window`` numbers however many rows.
* Combinations: all ways to fill a window exactly with two or three lengths that occur.
* Repeat counts: non-negative least squares of the combinations against the histogram
  (accelerated projected gradients; a column has two or three entries, so no matrix is built); then
  again over the ``WAYS`` most used combinations of each length.
* Rounding: the counts are rounded and taken, the largest first, as far as rests are there.
* Residuals, greedily: the longest rest opens a window, the longest that fit follow; where
  none fits, the shortest longer one is cut and its remainder goes back to the stock.  What few rests
  share no more recipes are laid end to end.  Only the last window of all can stay open: its
  tokens become sequences of power-of-two length.

The plan is made on the driver from the histogram alone and says: of the rests of length l, those
with ranks a to b go to slot s of windows w, w + 1, ...  Its size follows from the window alone;
it is broadcast.  A rest's rank needs no sort: each task numbers its own rests by length while it
tokenises, and the tasks' counts are summed up.  The numbers are written with the rows, so they
hold whatever is computed again later.  Equal lengths are interchangeable, so a group of
copies is dealt over tasks and windows like any other rows.

Defined cases: a null or empty text is its closing id alone; rows that share a doc_id (or have
none) are documents of their own; special strings in a text are ordinary text; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

WINDOW = 2048
END_ID = 1
#: Of each length, so many of its best combinations are kept after the first fit.
WAYS = 8
STEPS = (100, 1000)
LONG_WORD = 500
# Fixed value: where byte-level tokenizers cut a text before they merge.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Beside these characters (ASCII and Latin, Greek and Cyrillic letters) libraries may class some differently.
_ODD = re.compile(r"[^\t\n\r\x20-\x7E\u00C0-\u017F\u0391-\u03A1\u03A3-\u03C9\u0410-\u044F]|[ \t\r\n]{500}")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# ---------------------------------------------------------------- tokens
def _byte_names() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves,
    the others, in order, from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranked(content: str) -> object | None:
    """The same vocabulary for the faster of the two installed libraries, where both are sure to agree: plain
    byte-level tokens cut by ``_CUT``, each merge with the next id."""
    spec = json.loads(content)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    names = _byte_names()
    vocab = {t: i for t, i in model.get("vocab", {}).items() if all(c in names for c in t)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    singles = sum(len(t) == 1 for t in vocab)
    if (spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True)
            or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges") or singles != 256
            or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges))):
        return None
    import tiktoken
    ranks = {bytes(names[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("given", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})


class Ids:
    """Token ids of texts, from the content of a ``tokenizers`` file.

    ``tiktoken`` computes the same ids faster.  It gets texts of common letters and
    signs without very long words or gaps; ``tokenizers`` gets all others, and everything
    where the file is of another kind.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.ranked = _ranked(content)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, self.kind)
        if self.ranked is None or _ODD.search(text) or max(map(len, text.split()), default=0) > LONG_WORD:
            return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
        return np.array(self.ranked.encode_ordinary(text), self.kind)


_LOADED: dict[tuple[int, int], Ids] = {}


def _loaded(key: tuple[int, int], content: object) -> Ids:
    """One tokenizer for each worker, whatever tasks it runs; ``key`` names the broadcast content."""
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _LOADED.clear()
        _LOADED[key] = Ids(content.value)
    return _LOADED[key]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(docs: DataFrame, content: str, window: int, end_id: int) -> DataFrame:
    """A row for each document: its length, the checksums of its whole windows and of its rest, the rest's
    ids, and the rest's number among those of its task and length (stored)."""
    shared = docs.sparkSession.sparkContext.broadcast(content)
    key = zlib.crc32(content.encode()), len(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _loaded(key, shared)
        part = TaskContext.get().partitionId()
        seen, wholes = np.zeros(window, np.int64), np.zeros(window, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                some = batch.slice(lo, 256)
                rows = {k: [] for k in ("total", "rest", "local", "wlocal", "crcs", "rest_crc", "ids")}
                for text in some.column(1):
                    ids = ids_of(text.as_py())
                    ids = np.append(ids, np.array([end_id], ids.dtype))
                    whole, rest = divmod(len(ids), window)
                    tail = ids[whole * window:]
                    rows["total"].append(len(ids))
                    rows["rest"].append(rest)
                    rows["local"].append(int(seen[rest]))
                    rows["wlocal"].append(int(wholes[rest]))
                    rows["crcs"].append([_crc(ids[k * window:(k + 1) * window]) for k in range(whole)])
                    rows["rest_crc"].append(_crc(tail))
                    rows["ids"].append(tail.tobytes())
                    seen[rest] += 1
                    wholes[rest] += whole
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([part] * len(rows["total"]), pa.int32()), pa.array(rows["total"], pa.int64()),
                     pa.array(rows["rest"], pa.int32()), pa.array(rows["local"], pa.int64()), pa.array(rows["wlocal"], pa.int64()),
                     pa.array(rows["crcs"], pa.list_(pa.int64())), pa.array(rows["rest_crc"], pa.int64()),
                     pa.array(rows["ids"], pa.binary())],
                    ["doc_id", "part", "total", "rest", "local", "wlocal", "crcs", "rest_crc", "ids"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(plain.mapInArrow(run, "doc_id long, part int, total long, rest int, local long, wlocal long, "
                                        "crcs array<long>, rest_crc long, ids binary"), "token-rests")


# ---------------------------------------------------------------- plan
def combinations(counts: np.ndarray) -> np.ndarray:
    """Ways to fill a window with two or three lengths that occur: rows of lengths, 0 for none.

    ``counts[l]``: rests of length l; the window is ``len(counts)``.
    """
    window = len(counts)
    there = counts > 0
    there[0] = False
    a = np.arange(1, window // 2 + 1)
    a = a[there[a] & there[window - a]]
    found = [np.stack([a, window - a, np.zeros_like(a)], 1)]
    for a in np.flatnonzero(there[:window // 3 + 1]):
        b = np.arange(a, (window - a) // 2 + 1)
        b = b[there[b] & there[window - a - b]]
        found.append(np.stack([np.full_like(b, a), b, window - a - b], 1))
    return np.concatenate(found)


def repeat_counts(ways: np.ndarray, counts: np.ndarray, steps: int) -> np.ndarray:
    """How often to take each way: least squares of the lengths used against ``counts``, none below zero."""
    want = counts.astype(float)
    want[0] = 0

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(w, weights=x, minlength=len(want)) for w in ways.T)
        total[0] = 0
        return total

    def slope(error: np.ndarray) -> np.ndarray:
        return sum(error[w] for w in ways.T)  # error[0] is 0

    x = np.zeros(len(ways))
    if not len(ways):
        return x
    v = np.ones(len(ways))  # the largest curvature, by power iteration from a positive start
    top = 1.0
    for _ in range(20):
        v = slope(used(v))
        top = float(np.linalg.norm(v))
        v /= top
    y, pace = x, 1.0
    for _ in range(steps):
        new = np.maximum(0, y - slope(used(y) - want) / (1.02 * top))
        faster = (1 + (1 + 4 * pace * pace) ** 0.5) / 2
        y = new + (pace - 1) / faster * (new - x)
        x, pace = new, faster
    return x


@dataclass
class Slot:
    """Rests of length ``rest`` with ranks from ``rank`` on, ``n`` of them: their tokens from ``start`` on go to
    ``offset`` of the sequences from ``sequence`` on, one each.  On the tape they are laid end to end from
    ``offset`` on, and ``sequence`` is the tape's first."""
    rest: int
    rank: int
    n: int
    start: int
    length: int
    sequence: int
    offset: int
    tape: bool = False


class _Stock:
    """What is left of each length: runs of rests, or of cut rests' remainders."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.left[0] = 0
        self.runs = [deque([(length, 0, int(n), 0)]) if n and length else deque() for length, n in enumerate(counts)]
        self.slots: list[Slot] = []
        self.sequences = 0

    def take(self, length: int, n: int, first: int, sequence: int, offset: int) -> None:
        """``n`` pieces of this length, ``first`` tokens of each; the remainders go back to the stock."""
        self.left[length] -= n
        while n:
            rest, rank, have, start = self.runs[length].popleft()
            some = min(n, have)
            if have > some:
                self.runs[length].appendleft((rest, rank + some, have - some, start))
            self.slots.append(Slot(rest, rank, some, start, first, sequence, offset))
            if length > first:
                self.runs[length - first].append((rest, rank, some, start + first))
                self.left[length - first] += some
            sequence += some
            n -= some

    def fill(self, lengths: list[int], n: int, cut_from: int = 0) -> None:
        """``n`` sequences of pieces of these lengths; the last is cut from pieces of ``cut_from``, if given."""
        offset = 0
        for k, length in enumerate(lengths):
            source = cut_from if cut_from and k == len(lengths) - 1 else length
            self.take(source, n, length, self.sequences, offset)
            offset += length
        self.sequences += n


    def lay(self, window: int) -> None:
        """What is left, the longest first, end to end over whole windows, cut where a window ends."""
        whole = int((self.left * np.arange(window)).sum()) // window * window
        at = 0
        for length in np.flatnonzero(self.left)[::-1].tolist():
            while at < whole and self.runs[length]:
                rest, rank, have, start = self.runs[length].popleft()
                some = min(have, -(-(whole - at) // length))
                if have > some:
                    self.runs[length].appendleft((rest, rank + some, have - some, start))
                over = at + some * length - whole  # the last one may go beyond the tape
                if over > 0:
                    some -= 1
                    cut = whole - at - some * length
                    self.slots.append(Slot(rest, rank + some, 1, start, cut, self.sequences, at + some * length, True))
                    self.runs[over].append((rest, rank + some, 1, start + cut))
                    self.left[over] += 1
                    self.left[length] -= 1
                    at = whole
                if some:
                    self.slots.append(Slot(rest, rank, some, start, length, self.sequences,
                                           at - some * length - cut if over > 0 else at, True))
                self.left[length] -= some
                at = whole if over > 0 else at + some * length
        self.sequences += whole // window


def _residuals(stock: _Stock, window: int) -> None:
    """Longest first, the longest that fits next, cut where nothing fits.

    Ever fewer rests share a recipe in the end: after ``window`` recipes what is left is laid end to end.
    """
    sizes = np.arange(window)
    for _ in range(window):
        if int((stock.left * sizes).sum()) < window:
            break
        free = stock.left.copy()
        lengths: list[int] = []
        room, cut = window, 0
        while room:
            fits = np.flatnonzero(free[:room + 1])
            if len(fits):
                lengths.append(int(fits[-1]))
            else:
                cut = int(np.flatnonzero(free)[0])  # all that is left is longer than the room
                lengths.append(room)
            free[cut or lengths[-1]] -= 1
            room -= lengths[-1]
        uses = np.bincount([*lengths[:-1], cut or lengths[-1]], minlength=window)
        stock.fill(lengths, int((stock.left[uses > 0] // uses[uses > 0]).min()), cut)
    stock.lay(window)
    left = int((stock.left * sizes).sum())
    while left:  # less than a window: sequences of power-of-two length need no padding
        room = 1 << (left.bit_length() - 1)
        left -= room
        at = 0
        while at < room:
            longest = int(np.flatnonzero(stock.left)[-1])
            first = min(longest, room - at)
            stock.take(longest, 1, first, stock.sequences, at)
            at += first
        stock.sequences += 1


def best_ways(ways: np.ndarray, x: np.ndarray, most: int = WAYS) -> np.ndarray:
    """The ways that are among the ``most`` most used of one of their lengths: a fit over all of them is spread thin."""
    keep = np.zeros(len(ways), bool)
    for lengths in ways.T:
        order = np.lexsort((-x, lengths))
        own = lengths[order]
        keep[order[(np.arange(len(own)) - np.searchsorted(own, own) < most) & (own > 0)]] = True
    return ways[keep]


def plan(counts: np.ndarray) -> tuple[list[Slot], int]:
    """Slots for all rests (``counts[l]`` of length l), and the number of sequences."""
    window = len(counts)
    stock = _Stock(counts)
    ways = combinations(counts)
    ways = best_ways(ways, repeat_counts(ways, counts, STEPS[0]))
    x = repeat_counts(ways, counts, STEPS[1])
    for k in np.argsort(-x, kind="stable"):
        lengths = [int(length) for length in ways[k] if length]
        uses = np.bincount(lengths, minlength=window)
        times = min(int(x[k] + 0.5), int((stock.left[uses > 0] // uses[uses > 0]).min()))
        if times:
            stock.fill(lengths, times)
    _residuals(stock, window)
    return stock.slots, stock.sequences


class Lookup:
    """The slots of a rest, by its length and rank: runs of ranks that have the same slots."""

    def __init__(self, slots: list[Slot], wholes: np.ndarray, sequences: int):
        by: dict[int, list[Slot]] = {}
        for s in slots:
            by.setdefault(s.rest, []).append(s)
        keys, heads, members = [], [0], []
        for rest in sorted(by):
            own = by[rest]
            cuts = sorted({x for s in own for x in (s.rank, s.rank + s.n)})
            place = {c: i for i, c in enumerate(cuts)}
            cells: list[list[Slot]] = [[] for _ in cuts]
            for s in own:
                for i in range(place[s.rank], place[s.rank + s.n]):
                    cells[i].append(s)
            for cut, cell in zip(cuts, cells, strict=True):
                keys.append(rest << 44 | cut)
                members += sorted(cell, key=lambda s: s.start)
                heads.append(len(members))
        self.keys, self.heads = np.array(keys, np.int64), np.array(heads, np.int64)
        self.fields = np.array([(s.rank, s.start, s.length, s.sequence, s.offset, s.tape) for s in members],
                               np.int64).reshape(-1, 6)
        self.window = len(wholes)
        # the sequences of whole windows come after the plan's
        self.wholes = sequences + np.concatenate([[0], np.cumsum(wholes)[:-1]])

    def __call__(self, rest: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """(index of the row, start in its rest, length, sequence, offset) of every piece."""
        some = np.flatnonzero(rest > 0)
        cell = np.searchsorted(self.keys, rest[some].astype(np.int64) << 44 | rank[some], "right") - 1
        n = self.heads[cell + 1] - self.heads[cell]
        row = np.repeat(some, n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        first, start, length, sequence, offset, tape = self.fields[np.repeat(self.heads[cell], n) + within].T
        nth = rank[row] - first
        place = offset + nth * length
        sequence = sequence + np.where(tape > 0, place // self.window, nth)
        offset = np.where(tape > 0, place % self.window, offset)
        here = np.minimum(length, self.window - offset)
        over = np.flatnonzero(length > here)  # goes on in the tape's next window
        return (np.concatenate([row, row[over]]), np.concatenate([start, (start + here)[over]]),
                np.concatenate([here, (length - here)[over]]), np.concatenate([sequence, sequence[over] + 1]),
                np.concatenate([offset, np.zeros(len(over), np.int64)]))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: where it lies in its document and in its sequence.

    ``tokenizer``: path of a byte-level tokenizer file, read by the driver.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    rows = tokenised(docs, content, window, end_id)
    spark = docs.sparkSession
    counts, wholes = np.zeros(window, np.int64), np.zeros(window, np.int64)
    for r in rows.groupBy("rest").agg(F.count("*").alias("n"), F.sum(F.size("crcs")).alias("w")).collect():
        counts[r["rest"]], wholes[r["rest"]] = r["n"], r["w"]
    slots, sequences = plan(counts)
    lookup = spark.sparkContext.broadcast(Lookup(slots, wholes, sequences))
    kind = Ids(content).kind

    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy("rest", "part").agg(F.count("*").alias("n"), F.sum(F.size("crcs")).alias("w")).select(
        "rest", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("wfirst"))
    # only lengths of which some are cut need their ids again
    cut = sorted({s.rest for s in slots if s.length < s.rest or s.tape})
    ids = F.when(F.col("rest").isin(cut), F.col("ids")) if cut else F.lit(None).cast("binary")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_ = lookup.value
        for batch in batches:
            num = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("rest", "rank", "total", "whole", "rest_crc")}
            rest, total = num["rest"].astype(np.int64), num["total"]
            row, start, length, sequence, offset = plan_(rest, num["rank"])
            crc = num["rest_crc"][row].copy()
            for k in np.flatnonzero(length < rest[row]):
                own = np.frombuffer(batch.column("ids")[int(row[k])].as_py(), kind)
                crc[k] = _crc(own[start[k]:start[k] + length[k]])
            crcs = batch.column("crcs")
            n = np.diff(crcs.offsets.to_numpy())
            wrow = np.repeat(np.arange(batch.num_rows), n)
            within = np.arange(len(wrow)) - np.repeat(np.cumsum(n) - n, n)
            cols = [(total - rest)[row] + start, length, crc, total[row], sequence, offset]
            wcols = [within * window, np.full(len(wrow), window), crcs.flatten().to_numpy(zero_copy_only=False), total[wrow],
                     plan_.wholes[rest[wrow]] + num["whole"][wrow] + within, np.zeros(len(wrow), np.int64)]
            every = np.concatenate([row, wrow])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(every)),
                 *(pa.array(np.concatenate([a, b]).astype(np.int64)) for a, b in zip(cols, wcols, strict=True))],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    placed = rows.withColumn("ids", ids).join(first, ["rest", "part"]).select(
        "doc_id", "rest", "total", (F.col("local") + F.col("first")).alias("rank"),
        (F.col("wlocal") + F.col("wfirst")).alias("whole"), "crcs", "rest_crc", "ids")
    return placed.mapInArrow(emit, PIECES)


def op11_window_packing(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return pack(docs, tokenizer)
