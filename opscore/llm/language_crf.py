"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a language; neighbouring words are tied by learned transitions,
so a word that several languages share takes the language of its surroundings, and a
text that switches languages is labelled piece by piece.  Features of a word: its
character n-grams with the word's edges (those at an edge are the affixes) and the
word itself (the learned lexicon), hashed into one weight table.  Labels of single
words come from the forward-backward algorithm; a text's language is the one with the
largest sum of word probabilities, and the score that sum's share.

Training maximises the likelihood of the words' languages in sequences that join pieces of
several documents, so transitions are learned from switches and from runs.  It uses a
bounded sample: at most about ``max_pieces`` (6,000) pieces of 64 words, cut by Spark from
some ``max_docs`` (4,000) training documents taken by the hash of doc_id, equal numbers of each
language (all of a rare one).  All texts are scored whole.  The chain over a batch of texts is evaluated in blocks whose
transfer matrices are multiplied first, so that a long text is not a long loop.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing is labelled; a null doc_id is never learned from and counts as not held
out; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, SPACE, U64, Spans, byte_values, mix, rows_of, slices, word_hashes, words

PIECE = 64
GRAMS = (1, 2, 3, 4)
BITS = 16
BLOCK = 128

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


class Crf(NamedTuple):
    langs: list[str]
    weights: np.ndarray   # feature, language
    start: np.ndarray
    moves: np.ndarray     # from, to


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature of each n-gram or word, word it belongs to), words in order."""
    size = ends - starts + 2
    begin = np.cumsum(size) - size
    text = np.full(int(size.sum()), 32, np.uint8)
    inner = np.arange(len(text)) - np.repeat(begin, size)
    word = np.repeat(np.arange(len(size)), size)
    body = (inner > 0) & (inner < size[word] - 1)
    text[body] = data[(starts[word] + inner - 1)[body]]
    spans = Spans(byte_values(text))
    low = U64((1 << BITS) - 1)
    found, of = [], []
    for n in GRAMS:
        grams = spans.windows(n)
        whole = np.flatnonzero(inner[:len(grams)] + n <= size[word[:len(grams)]])
        found.append((mix(grams[whole] + U64(n)) & low).astype(np.int64))
        of.append(word[whole])
    found.append((mix(spans(begin, begin + size) + U64(99)) & low).astype(np.int64))
    of.append(np.arange(len(size)))
    return np.concatenate(found), np.concatenate(of)


def emissions(weights: np.ndarray, feature: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    return np.column_stack([np.bincount(word, weights[feature, k], n) for k in range(weights.shape[1])])


def forward_backward(e: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of each language for each word; ``first``: words that begin a chain."""
    return _chain(e, first, start, moves)[0]


def expected_pairs(e: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities of the words' languages, expected number of each pair of languages of neighbours in a chain)."""
    found, forward, backward = _chain(e, first, start, moves)
    inner = np.flatnonzero(~first)
    pair = forward[inner - 1][:, :, None] * np.exp(moves) * backward[inner][:, None, :]
    return found, (pair / pair.sum((1, 2), keepdims=True)).sum(0)


def _chain(e: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each word: its probabilities, what comes from the words up to it, and from it and the words after
    (each up to a factor)."""
    n, k = e.shape
    if not n:
        return (np.zeros((0, k)),) * 3
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    local = np.exp(e - e.max(1, keepdims=True))
    local = np.concatenate([local, np.ones((pad, k))]).reshape(blocks, BLOCK, k).swapaxes(0, 1)
    begins = np.concatenate([first, np.ones(pad, bool)]).reshape(blocks, BLOCK).T
    t, s = np.exp(moves), np.exp(start)
    # transfer matrix of each block
    product = np.broadcast_to(np.eye(k), (blocks, k, k))
    for c in range(BLOCK):
        total = product.sum(2, keepdims=True)
        product = np.where(begins[c][:, None, None], total * s, product @ t) * local[c][:, None, :]
        product = product / product.sum((1, 2), keepdims=True)
    into, back = np.empty((blocks, k)), np.empty((blocks, k))
    a = np.full(k, 1 / k)
    for i in range(blocks):
        into[i] = a
        a = a @ product[i]
        a /= a.sum()
    b = np.ones(k)
    for i in reversed(range(blocks)):
        back[i] = b
        b = product[i] @ b
        b /= b.sum()
    forward = np.empty((BLOCK, blocks, k))
    a = into
    for c in range(BLOCK):
        a = np.where(begins[c][:, None], s, a @ t) * local[c]
        a = a / a.sum(1, keepdims=True)
        forward[c] = a
    found, after = np.empty_like(forward), np.empty_like(forward)
    b = back
    for c in reversed(range(BLOCK)):
        found[c] = forward[c] * b
        b = b * local[c]
        after[c] = b
        b = np.where(begins[c][:, None], (b * s).sum(1, keepdims=True), b @ t.T)
        b = b / b.sum(1, keepdims=True)
    found = found / found.sum(2, keepdims=True)
    return tuple(x.swapaxes(0, 1).reshape(-1, k)[:n] for x in (found, forward, after))


def fit(pieces: list[str], langs: list[str], epochs: int = 3, rate: float = 0.3, batch: int = 96, seed: int = 7) -> Crf:
    """Weights and transitions by adaptive gradient steps on sequences of joined pieces."""
    names = sorted(set(langs))
    k = len(names)
    label = np.array([names.index(x) for x in langs])
    model = Crf(names, np.zeros((1 << BITS, k)), np.zeros(k), np.zeros((k, k)))
    seen = [np.full(x.shape, 1e-2) for x in model[1:]]
    rng = np.random.default_rng(seed)
    encoded = [p.encode() for p in pieces]
    for _ in range(epochs):
        order = rng.permutation(len(encoded))
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            data = np.frombuffer(b"\n".join(encoded[i] for i in some), np.uint8)
            sizes = np.array([len(encoded[i]) + 1 for i in some])
            off = np.concatenate([[0], np.cumsum(sizes)])
            off[-1] -= 1
            starts, ends, bounds = words(LOWER[data], off)
            if not len(starts):
                continue
            row = rows_of(bounds)
            truth = label[some][row]
            first = np.zeros(len(starts), bool)
            # two to four pieces make a chain: some neighbours differ in language
            first[np.unique(np.minimum(bounds[:-1][rng.random(len(some)) < 0.4], len(starts) - 1))] = True
            first[0] = True
            feature, word = word_features(LOWER[data], starts, ends)
            e = emissions(model.weights, feature, word, len(starts))
            found, pairs = expected_pairs(e, first, model.start, model.moves)
            off_by = -found
            off_by[np.arange(len(truth)), truth] += 1
            dw = np.column_stack([np.bincount(feature, off_by[word, c], 1 << BITS) for c in range(k)]) / len(starts) * 8
            ds = off_by[first].sum(0) / len(starts) * 8
            # transitions: observed minus expected pairs
            inner = np.flatnonzero(~first)
            dm = -pairs
            np.add.at(dm, (truth[inner - 1], truth[inner]), 1)
            dm = dm / len(starts) * 8
            for x, g, acc in zip(model[1:], (dw, ds, dm), seen, strict=True):
                acc += g * g
                x += rate * g / np.sqrt(acc)
    return model


def labelled(batch_text: pa.Array, model: Crf) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By slices: first row, the words' language probabilities, their rows, and which words have a letter."""
    for lo, _, data, off in slices(batch_text):
        low = LOWER[data]
        starts, ends, bounds = words(low, off)
        row = rows_of(bounds)
        spelling, at, of = np.unique(word_hashes(Spans(byte_values(low)), starts, ends), return_index=True, return_inverse=True)
        feature, word = word_features(low, starts[at], ends[at])
        e = emissions(model.weights, feature, word, len(spelling))[of]
        first = np.zeros(len(starts), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        letters = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int32)])
        yield lo, forward_backward(e, first, model.start, model.moves), row, letters[ends] > letters[starts]


def _predict(model: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crf: Crf = model.value
            texts = batch.column(2)
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            if crf.langs:
                for lo, found, row, letter in labelled(texts, crf):
                    n = int(row[-1]) + 1 if len(row) else 0
                    sums = np.column_stack([np.bincount(row[letter], found[letter, c], n) for c in range(len(crf.langs))])
                    for i in np.flatnonzero(sums.sum(1) > 0):
                        own = sums[i]
                        best = int(np.argmax(own))
                        lang[lo + i], score[lo + i] = crf.langs[best], min(1.0, own[best] / own.sum())
            for i in np.flatnonzero(score):  # bytes above 127 may be no letters at all
                text = texts[int(i)].as_py()
                if not (text.isascii() or any(c.isalpha() for c in text)):
                    lang[i], score[i] = "und", 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    return run


def shares(counts: dict[str, int], most: int) -> dict[str, float]:
    """Which share of each language's rows to take: equal numbers, and all rows of languages with fewer."""
    found: dict[str, float] = {}
    left = most
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        found[lang] = min(1.0, left / (len(counts) - k) / n)
        left -= min(n, left / (len(counts) - k))
    return found


def _sample(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """About ``most`` rows by the hash of ``key``, as many of each language as there are (few languages)."""
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return rows
    pairs = [F.lit(x) for lang, share in shares(counts, most).items() for x in (lang, int(share * (1 << 40)))]
    return rows.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 40)) < F.create_map(*pairs)[F.col("lang")])


def train(docs: DataFrame, max_docs: int = 4_000, max_pieces: int = 6_000) -> Crf:
    """The model from a hash sample of ``docs`` (doc_id, text, lang), all of which may be learned from."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    cut = _sample(known, max_docs, "doc_id").select(
        "doc_id", "lang", F.split(F.trim("text"), r"[\x20\x09-\x0D]+").alias("w")).select(
        "doc_id", "lang", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.floor((F.size("w") - 1) / PIECE).cast("int")),
            lambda i: F.array_join(F.slice("w", i * PIECE + 1, F.lit(PIECE)), " "))).alias("piece", "words"))
    rows = _sample(cut, max_pieces, "doc_id", "piece").orderBy("doc_id", "piece").select("words", "lang").collect()
    if not rows:
        return Crf([], np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    return fit([r["words"] for r in rows], [r["lang"] for r in rows])


def op10_language_crf(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out"),
                       F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = docs.sparkSession.sparkContext.broadcast(
        train(docs.filter(F.col("doc_id").isNotNull() & ~F.col("held_out")).select("doc_id", "text", "lang")))
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
