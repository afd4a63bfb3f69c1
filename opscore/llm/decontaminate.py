"""Benchmark decontamination by latent semantic retrieval, checked by common subsequences.

Texts are cut into blocks of ``BLOCK`` words (lower-cased, punctuation apart); a passage is two
neighbouring blocks.  Passages are TF-IDF vectors over the words of the benchmark: words
that no item has add nothing to any inner product.  Document frequencies count every
block of the corpus; words in more than ``MOST_COMMON`` of all blocks have no weight in
retrieval, as they would make all passages of a language alike.

The texts are cut into words once: a written table holds each word's place in the vocabulary of the items, and
the passes below read that.

* Latent space: a randomised SVD.  A random matrix is multiplied by A'A (A: blocks by words)
  a few times, orthonormalised in between.  A'A is how often two words stand in one block, by their weights: the
  tasks count the pairs of their own blocks, Spark adds them up, and each product reads these sums only.  It is fitted on
  the blocks of every document, with the items added (a caller may
  bound it to about ``max_docs`` documents, taken by the hash of doc_id).
* Candidates: every passage of every document is projected and compared with every item
  (long ones in chunks) by cosine; all pairs with at least ``MIN_COSINE`` go on.
* Bound: the space has fewer directions than words, and the words around a copy weigh on its
  cosine, so retrieval alone loses leaks.  Beside it the weight of the item's words that stand
  in a passage's surroundings is counted exactly, for every item and passage, whatever the
  item's length and its words' frequencies; an item's commonest words, up to ``SPARE`` of its weight, count as
  there without a look.  All pairs go on that have the ``LCS_WITH_ANSWER``
  without which the check fails: no leak that the check would accept at any passage is lost.
* Check: the heaviest common subsequence of the item and the surroundings of the passage, words
  weighing their idf, as a share of the item's weight.  Paraphrases keep much of it, other
  passages of the language do not.  The answer is the item's last sentence (at most its last
  ``ANSWER`` words); it counts as found if its words stand in the surroundings in order.
  A document is contaminated by an item with a share of ``LCS_ALONE``, or
  ``LCS_WITH_ANSWER`` and the answer.

The benchmark is the query set and is sent to all tasks, in rounds of at most ``ROUND`` items; what
reaches the driver is bounded by the words of one round.

Defined cases: null texts and texts without a word have no passage and are clean; items
without a word match nothing; an empty benchmark leaves all documents clean; equal items are
reported each; rows that share a doc_id are searched each; extra columns are carried along
by ``keep_clean`` and ignored by the search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .text import LOWER, Spans, byte_values, rows_of, slices, word_hashes, words

BLOCK = 32
RANK, EXTRA, STEPS = 288, 16, 2
MIN_COSINE = 0.35
MOST_COMMON = 0.01
LCS_ALONE, LCS_WITH_ANSWER = 0.75, 0.6
ANSWER = 12
SPARE = 0.15
ROUND = 256
_CHUNK = 32  # vocabulary rows in a part of A'A: every task sends its parts, and many tasks add them up
_GROUP = 32  # items that are counted at once
_PAIRS = 1 << 21  # pairs of words that a task holds before it adds them up
_WORDS = 1 << 17  # words in a slice of a coded table: those of about a megabyte of text

_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[65:91] = _BREAK[97:123] = False
_BREAK[128:] = False


class Items(NamedTuple):
    """One round of benchmark items over their sorted vocabulary of word hashes."""

    ids: list[int]
    words: list[np.ndarray]      # vocabulary index of each word of each item
    answers: list[np.ndarray]
    vocabulary: np.ndarray
    chunk_item: np.ndarray       # item of each chunk that is looked for
    chunk_words: list[np.ndarray]


class Space(NamedTuple):
    idf: np.ndarray
    rare: np.ndarray             # words that have weight in retrieval
    basis: np.ndarray            # weighted: word, dimension
    chunks: np.ndarray           # unit vectors of the item chunks


def _hashes(text: str) -> np.ndarray:
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = words(data, np.array([0, len(data)]), _BREAK)
    return word_hashes(Spans(byte_values(data)), starts, ends)


def items_of(rows: list[tuple[int, str]]) -> Items:
    rows = [(i, t) for i, t in rows if t and len(_hashes(t))]
    hashed = [_hashes(t) for _, t in rows]
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed]))
    found = [np.searchsorted(vocabulary, h) for h in hashed]
    answers = []
    for (_, text), w in zip(rows, found, strict=True):
        sentences = [s for s in re.split(r"[.!?\n]+", text) if len(_hashes(s))]
        answers.append(w[-min(ANSWER, len(_hashes(sentences[-1]))):])
    chunk_item, chunk_words = [], []
    for i, w in enumerate(found):
        for at in range(0, max(1, len(w) - BLOCK), 2 * BLOCK) if len(w) > 2 * BLOCK else [0]:
            chunk_item.append(i)
            chunk_words.append(w[at:at + 2 * BLOCK])
    return Items([i for i, _ in rows], found, answers, vocabulary, np.array(chunk_item, np.int64), chunk_words)


def _indexed(texts: pa.Array, items: Items) -> Iterator[tuple]:
    """By slices: rows, each word's vocabulary index (-1: none), first words."""
    for lo, hi, data, off in slices(texts):
        data = LOWER[data]
        starts, ends, bounds = words(data, off, _BREAK)
        h = word_hashes(Spans(byte_values(data)), starts, ends)
        at = np.minimum(np.searchsorted(items.vocabulary, h), len(items.vocabulary) - 1)
        yield lo, hi, np.where(items.vocabulary[at] == h, at, -1), bounds


def _code(size: int) -> np.dtype:
    """How a coded table holds the places in a vocabulary of ``size`` words."""
    return np.dtype("<i2" if size < 1 << 15 else "<i4")


def _decoded(codes: pa.Array, items: Items) -> Iterator[tuple]:
    """The same from a coded table."""
    kind = _code(len(items.vocabulary))
    codes = codes.cast(pa.large_binary())
    if not len(codes):
        return
    _, at, data = codes.buffers()
    off = np.frombuffer(at, np.int64)[codes.offset:codes.offset + len(codes) + 1] // kind.itemsize
    data = np.frombuffer(data, kind, off[-1]) if off[-1] else np.zeros(0, kind)
    lo = 0
    while lo < len(codes):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + _WORDS, "right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]].astype(np.int64), off[lo:hi + 1] - off[lo]
        lo = hi


def _blocks(texts: pa.Array, items: Items) -> Iterator[tuple]:
    """By slices of texts, or of codes: rows, each word's vocabulary index (-1: none) and block, blocks per row, first words."""
    for lo, hi, index, bounds in (_decoded if pa.types.is_binary(texts.type) else _indexed)(texts, items):
        n = np.diff(bounds)
        blocks = -(-n // BLOCK)
        first = np.cumsum(blocks) - blocks
        row = rows_of(bounds)
        block = first[row] + (np.arange(len(index)) - bounds[row]) // BLOCK
        yield lo, hi, index, block, blocks, bounds


def coded(docs: DataFrame, items: object) -> DataFrame:
    """doc_id, codes of every row (stored): its words as places in the vocabulary, so that its text is cut once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _code(len(items.value.vocabulary))
        for batch in batches:
            for lo, hi, index, bounds in _indexed(batch.column(1), items.value):
                codes = pa.Array.from_buffers(pa.binary(), hi - lo, [
                    None, pa.py_buffer((bounds * kind.itemsize).astype(np.int32)), pa.py_buffer(index.astype(kind))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), codes], ["doc_id", "codes"])

    return scratch.stored(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, codes binary"), "item-words")


def _words_of(docs: DataFrame) -> DataFrame:
    return docs.select("codes" if "codes" in docs.columns else "text")


def document_frequencies(docs: DataFrame, items: object, size: int) -> np.ndarray:
    """In how many blocks each vocabulary word is; the last entry: how many blocks there are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for _, _, index, block, blocks, _ in _blocks(batch.column(0), items.value):
                known = index >= 0
                pairs = np.unique(block[known] * size + index[known])
                total[:-1] += np.bincount(pairs % size, minlength=size)
                total[-1] += blocks.sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["word", "n"])

    rows = _words_of(docs).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(size + 1)
    for r in rows:
        total[r["word"]] = r["n"]
    return total


def _project(index: np.ndarray, block: np.ndarray, n: int, matrix: np.ndarray) -> np.ndarray:
    """Sum of the matrix rows of the words of each block."""
    known = np.flatnonzero(index >= 0)
    out = np.zeros((n, matrix.shape[1]), matrix.dtype)
    if len(known):
        at, word = block[known], index[known]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        count = np.diff(np.append(first, len(at)))
        order = np.argsort(-count, kind="stable")
        for lo in range(0, len(order), 512):  # the first words of some blocks, then their second ones, and so on
            some = order[lo:lo + 512]
            begin, more = first[some], count[some]
            total = matrix[word[begin]]
            for k in range(1, int(more[0])):
                m = int(np.searchsorted(-more, -k))
                total[:m] += matrix[word[begin[:m] + k]]
            out[at[begin]] = total
    return out


def _passages(z: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors of passages, row, first block in its row): each block with the next one, the last one alone if single."""
    row = np.repeat(np.arange(len(blocks)), blocks)
    place = np.arange(len(z)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    two = np.zeros_like(z)
    two[:-1] = z[1:]
    two[place == blocks[row] - 1] = 0
    some = np.flatnonzero((place < blocks[row] - 1) | (blocks[row] == 1))
    return z[some] + two[some], row[some], place[some]


def _pairs(index: np.ndarray, block: np.ndarray, size: int) -> np.ndarray:
    """Pairs of the words of each block, in both orders as one (a * size + b, a <= b): none with itself."""
    known = np.flatnonzero(index >= 0)
    word, at = index[known], block[known]
    out = [np.zeros(0, np.int64)]
    for k in range(1, BLOCK):
        same = np.flatnonzero(at[:-k] == at[k:])
        if not len(same):
            break
        a, b = word[same], word[same + k]
        out.append(np.minimum(a, b) * size + np.maximum(a, b))
    return np.concatenate(out)


def _cells(pairs: list[np.ndarray], single: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """part, cells, counts: what some pairs and single words add to each part of A'A."""
    keys, n = np.unique(np.concatenate(pairs), return_counts=True)
    word = np.flatnonzero(single)
    a, b = keys // size, keys % size  # twice on the diagonal for two places of one word, as it should
    row, column = np.concatenate([a, b, word]), np.concatenate([b, a, word])
    n = np.concatenate([n, n, single[word]])
    cell, of = np.unique(row * size + column, return_inverse=True)
    n = np.bincount(of, n, len(cell)).astype(np.int64)
    edges = np.searchsorted(cell, np.arange(0, size + _CHUNK, _CHUNK) * size)
    for part, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if hi > lo:
            yield _part(part, (cell[lo:hi] - part * _CHUNK * size), n[lo:hi])


def _part(part: int, cells: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([cells.astype(np.int32).tobytes()], pa.binary()),
         pa.array([n.astype(np.int64).tobytes()], pa.binary())], ["part", "cells", "counts"])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for part, cells, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
        yield part, np.frombuffer(cells.as_buffer(), np.int32), np.frombuffer(n.as_buffer(), np.int64)


def together(docs: DataFrame, items: object, rare: np.ndarray) -> DataFrame:
    """part, cells, counts (stored): A'A without weights, how often two rare words stand in one block.

    A task adds up ``_PAIRS`` pairs at a time, and one part when the parts' sums meet, in order.
    """
    size = len(rare)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, single = [], 0, np.zeros(size, np.int64)
        for batch in batches:
            for _, _, index, block, _, _ in _blocks(batch.column(0), items.value):
                index = _weighty(index, rare)
                held.append(_pairs(index, block, size))
                n += len(held[-1])
                single += np.bincount(index[index >= 0], minlength=size)
                if n >= _PAIRS:
                    yield from _cells(held, single, size)
                    held, n, single = [], 0, np.zeros(size, np.int64)
        if held:
            yield from _cells(held, single, size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(_CHUNK * size, np.int64)
        for batch in batches:
            for part, cells, n in _parts(batch):
                if now is not None and part != now:
                    some = np.flatnonzero(total)
                    yield _part(now, some, total[some])
                    total[:] = 0
                now = part
                total[cells] += n  # each cell once
        if now is not None:
            some = np.flatnonzero(total)
            yield _part(now, some, total[some])

    schema = "part long, cells binary, counts binary"
    found = _words_of(docs).mapInArrow(count, schema).repartition("part").sortWithinPartitions("part")
    return scratch.stored(found.mapInArrow(add, schema), "word-pairs")


def latent_space(docs: DataFrame, items: object, total: np.ndarray, max_docs: int | None = None, seed: int = 11) -> Space:
    spark = docs.sparkSession
    own: Items = items.value
    size = len(own.vocabulary)
    idf = np.log((total[-1] + 1) / (total[:-1] + 0.5)).clip(0.05).astype(np.float32)
    rare = total[:-1] <= max(1.0, MOST_COMMON * total[-1])
    weight = idf * rare
    rank = min(RANK + EXTRA, size)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, rank)))[0].astype(np.float32)
    fitted = docs
    if max_docs is not None:
        share = min(1.0, max_docs / max(1, docs.count()))
        fitted = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    pairs = together(fitted, items, rare)

    def product(matrix: object):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weighted = matrix.value * weight[:, None].astype(float)
            for batch in batches:
                for part, cells, n in _parts(batch):
                    first = part * _CHUNK
                    counts = np.zeros((_CHUNK, size))
                    counts.reshape(-1)[cells] = n
                    rows = (counts @ weighted)[:size - first] * weight[first:first + _CHUNK, None]
                    yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([rows.tobytes()], pa.binary())], ["first", "rows"])
        return run

    for _ in range(STEPS):
        sent = spark.sparkContext.broadcast(basis)
        total_product = np.zeros((size, rank))
        for r in pairs.mapInArrow(product(sent), "first long, rows binary").collect():
            rows = np.frombuffer(bytes(r["rows"])).reshape(-1, rank)
            total_product[r["first"]:r["first"] + len(rows)] += rows
        for w in own.chunk_words:
            np.add.at(total_product, w, weight[w, None] * (basis[w] * weight[w, None]).sum(0))
        basis = np.linalg.qr(total_product)[0].astype(np.float32)
    scratch.drop(pairs)
    weighted = basis[:, :RANK] * weight[:, None]
    return Space(idf, rare, weighted, _unit(np.array([weighted[w].sum(0) for w in own.chunk_words], np.float32)))


def _weighty(index: np.ndarray, rare: np.ndarray) -> np.ndarray:
    return np.where((index >= 0) & rare[index], index, -1)


class Postings(NamedTuple):
    """A group of items by their words: those of word w lie at first[w]:first[w + 1]."""

    base: int                    # the group's first item
    first: np.ndarray
    item: np.ndarray             # counted from ``base``
    weight: np.ndarray           # idf by how often the item has the word
    least: np.ndarray            # of each item: the weight of these words without which the check fails
    before: np.ndarray           # of each item: blocks that the surroundings of a passage reach back


def postings(items: Items, idf: np.ndarray) -> list[Postings]:
    out = []
    for base in range(0, len(items.words), _GROUP):
        own = items.words[base:base + _GROUP]
        words, weights, least = [], [], []
        for w in own:
            word, n = np.unique(w, return_counts=True)
            weight = idf[word].astype(np.float64) * n
            order = np.argsort(idf[word], kind="stable")  # the commonest first
            spared = np.cumsum(weight[order])
            looked = order[spared > SPARE * spared[-1]]
            words.append(word[looked])
            weights.append(weight[looked])
            least.append(spared[-1] * LCS_WITH_ANSWER * (1 - 1e-5) - (spared[-1] - weight[looked].sum()))
        word, weight = np.concatenate(words), np.concatenate(weights)
        item = np.repeat(np.arange(len(own)), [len(w) for w in words])
        order = np.argsort(word, kind="stable")
        out.append(Postings(base, np.searchsorted(word[order], np.arange(len(idf) + 1)), item[order], weight[order],
                            np.array(least), np.array([-(-len(w) // BLOCK) for w in own])))
    return out


def _counted(groups: list[Postings], index: np.ndarray, block: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(item, first blocks of the passages whose surroundings have enough of its weight).

    The surroundings are taken in whole blocks.  A word of a block counts in all windows that begin at
    most a window's length before it, but after the block that had the word last.
    """
    n = int(blocks.sum())
    own = np.flatnonzero(index >= 0)
    held = np.unique(index[own] * n + block[own])
    word, at = held // n, held % n
    row_first = np.repeat(np.cumsum(blocks) - blocks, blocks)
    after = row_first[at]
    again = np.flatnonzero(word[1:] == word[:-1]) + 1
    after[again] = np.maximum(after[again], at[again - 1] + 1)
    for g in groups:
        m = len(g.least)
        several = g.first[word + 1] - g.first[word]
        pair = np.repeat(np.arange(len(held)), several)
        post = np.arange(len(pair)) + np.repeat(g.first[word] - (np.cumsum(several) - several), several)
        item, weight, last = g.item[post], g.weight[post], at[pair]
        begin = np.maximum(after[pair], last - 2 * g.before[item] - 1)
        shared = np.bincount(begin * m + item, weight, minlength=(n + 1) * m)
        shared -= np.bincount((last + 1) * m + item, weight, minlength=(n + 1) * m)
        enough = np.cumsum(shared.reshape(n + 1, m), axis=0)[:n] >= g.least
        for i in np.flatnonzero(enough.any(axis=0)):
            # windows reach back from the passage's first block, but not beyond the row
            yield g.base + int(i), np.flatnonzero(enough[np.maximum(np.arange(n) - g.before[i], row_first), i])


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def common_weight(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of two word sequences."""
    best = np.zeros(len(b) + 1, np.float32)
    for w in a:
        best[1:] = np.maximum(best[1:], best[:-1] + weight[w] * (b == w))
        np.maximum.accumulate(best, out=best)
    return float(best[-1])


def verdict(item: int, items: Items, space: Space, around: np.ndarray, flags: np.ndarray) -> tuple[float, bool]:
    """(share of the item's weight in the common subsequence, is the answer there in order).

    ``flags``: a False for each word and one more, left as found.  The words that both have bound the share.
    """
    own = items.words[item]
    weight = space.idf[own]
    whole = float(weight.sum())
    flags[around] = True  # words outside the vocabulary (-1) fall on the last place
    shared = float(weight[flags[own]].sum())
    flags[around] = False
    if shared < LCS_WITH_ANSWER * whole:
        return 0.0, False
    near = around[np.isin(around, own)]
    answer = items.answers[item]
    ones = np.ones(len(space.idf), np.float32)
    found = common_weight(answer, near, ones) >= len(answer)
    return common_weight(own, near, space.idf) / whole, found


def found_in(texts: pa.Array, items: Items, space: Space) -> Iterator[tuple[int, int, float, float, bool]]:
    """(row, item, cosine, share, answer) of every contaminated row (a text, or its codes) and item."""
    flags = np.zeros(len(items.vocabulary) + 1, bool)
    known = postings(items, space.idf)
    chunks_of = [np.flatnonzero(items.chunk_item == i) for i in range(len(items.ids))]
    for lo, _, index, block, blocks, bounds in _blocks(texts, items):
        n = int(blocks.sum())
        z, row, place = _passages(_project(_weighty(index, space.rare), block, n, space.basis), blocks)
        if not len(z):
            continue
        cosine = _unit(z) @ space.chunks.T
        found: dict[tuple[int, int, int], float] = {}
        for p, c in zip(*np.nonzero(cosine >= MIN_COSINE), strict=True):
            key = (int(items.chunk_item[c]), int(row[p]), int(place[p]))
            found[key] = max(found.get(key, 0.0), float(cosine[p, c]))
        # the last block of a row has no passage of its own: it is in the one before
        first = np.cumsum(blocks) - blocks
        of = np.repeat(np.arange(len(blocks)), blocks)
        passage = np.cumsum(np.maximum(blocks - 1, blocks > 0)) - np.maximum(blocks - 1, blocks > 0)
        for item, some in _counted(known, index, block, blocks):
            r = of[some]
            at = np.minimum(some - first[r], np.maximum(blocks[r] - 2, 0))
            near = cosine[np.ix_(passage[r] + at, chunks_of[item])].max(axis=1)
            for key in zip([item] * len(some), r.tolist(), at.tolist(), near.tolist(), strict=True):
                found.setdefault(key[:3], key[3])
        best: dict[tuple[int, int], tuple[float, float, bool]] = {}
        for (item, r, at), near in found.items():
            margin = len(items.words[item])
            a, b = bounds[r], bounds[r + 1]
            begin = a + at * BLOCK
            around = index[max(a, begin - margin):min(b, begin + 2 * BLOCK + margin)]
            share, answer = verdict(item, items, space, around, flags)
            if share >= LCS_ALONE or (share >= LCS_WITH_ANSWER and answer):
                now = (share, near, answer)
                best[r, item] = max(best.get((r, item), now), now)
        for (r, item), (share, cos, answer) in sorted(best.items()):
            yield lo + r, item, cos, share, answer


def _rounds(docs: DataFrame, benchmark: DataFrame, max_docs: int | None) -> Iterator[tuple[object, object, DataFrame]]:
    """Broadcast items and latent space, and the coded documents, round by round."""
    sc = docs.sparkSession.sparkContext
    n = benchmark.count()
    rounds = max(1, -(-n // ROUND))
    for k in range(rounds):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == k) if rounds > 1 else benchmark
        rows = part.select(F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id", "text").collect()
        items = sc.broadcast(items_of([(r[0], r[1]) for r in rows]))
        size = len(items.value.vocabulary)
        if size:
            codes = coded(docs, items)
            total = document_frequencies(codes, items, size)
            yield items, sc.broadcast(latent_space(codes, items, total, max_docs)), codes


def contaminated(docs: DataFrame, benchmark: DataFrame, max_docs: int | None = None) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_found: a row for each document and item it contains."""
    schema = "doc_id long, item_id long, cosine double, lcs_share double, answer_found boolean"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(items: object, space: object):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(batch.column(0)[r].as_py(), items.value.ids[i], cos, share, answer)
                        for r, i, cos, share, answer in found_in(batch.column(1), items.value, space.value)]
                if rows:
                    ids, item, cos, share, answer = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(item, pa.int64()), pa.array(cos), pa.array(share),
                         pa.array(answer)], ["doc_id", "item_id", "cosine", "lcs_share", "answer_found"])
        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for items, space, codes in _rounds(docs, benchmark, max_docs):
        out = out.unionAll(codes.mapInArrow(search(items, space), schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, max_docs: int | None = None) -> DataFrame:
    """Pipeline stage: the documents that contain no benchmark item, all columns."""
    def clean(items: object, space: object, at: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, *_ in found_in(batch.column(at), items.value, space.value)]] = False
                yield batch.filter(pa.array(keep))
        return run

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs
    for items, space, codes in _rounds(plain, benchmark, max_docs):
        scratch.drop(codes)
        out = out.mapInArrow(clean(items, space, docs.columns.index("text")), docs.schema)
    return out


def op2_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark)
