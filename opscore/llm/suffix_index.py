"""Suffix-array dedup of byte strings with a logarithmic index family.

A byte goes if a string of ``SIZE`` bytes that covers it also starts earlier (in a
smaller doc_id, or earlier in the same document).

The index is a family of sorted suffix tables.  A batch of documents gives a new table:
its suffixes, sampled at content-defined anchors (``anchors``: every string of ``SIZE``
bytes has one of its ``GRAM``-byte grams as anchor, at an offset that its content fixes),
ordered by the fingerprint of their first ``GRAM`` bytes, each with its first document and
its number of copies.  The table is then merge-scanned against every existing level: both
sides are bucketed and sorted by the same key, so Spark joins them as sorted runs without
a shuffle, and what they share are the places of long matches.  Then it becomes level 0;
whenever two levels have taken in equally many batches, they are merged into the next one
(again two sorted runs, no shuffle), so n batches leave at most log2(n) + 1 tables
and a suffix is rewritten at most log2(n) times.

The places found are resolved exactly, on the input:
 a. the maximal strings around an anchor (all its windows together) are grouped by
    content, with their first document; an anchor with one such string is done;
 b. the different strings of one anchor meet in a task, with their bytes, and their
    windows are compared: a bit mask per string says which start earlier elsewhere;
 c. for anchors with more than ``MOST_STRINGS`` different strings (a common line in
    ever new surroundings) the windows themselves are grouped by 96-bit keys instead, so
    no task gets an unbounded group: those that a count-min sketch finds repeated, each
    once per task (more, if it has very many), with its smallest document;
 d. every document meets the strings and windows of which it is the first, and drops the
    bytes that any other repeated window covers; where doc_ids repeat (or several are
    null), each different text of an id meets only those that it holds itself.

A table of all suffixes (8 bytes and more for each byte of text) would exceed the disk
that such a job should use; the sampled one holds about one in 25 and loses no match.

Which anchors repeat, and which have different contexts, is sent to the tasks as filters
of at most 32 MB each (``sketch``); a false positive costs work, not correctness.

Defined cases: null text is empty; texts shorter than ``SIZE`` bytes keep all; rows that
share a doc_id are each judged alone against all other doc_ids; a null doc_id comes before
all others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch, sketch
from .anchors import Runs, runs, window_keys
from .text import Spans, byte_values, covered, ids_repeat, mix, repeated, slices

SIZE, GRAM = 100, 50
MOST_STRINGS = 500
BATCHES = 4
SLICE = 1 << 16  # bytes: arrays of eight times that fit a core's own cache
_HELD = 1 << 18  # windows that a task combines at once
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 2000  # documents in an Arrow batch; a task holds a few batches in Spark's and in Python's memory
_NO_ID = -(1 << 63)  # stands for a null doc_id
_RUN = np.uint64(0x94D049BB133111EB)  # keeps hashes of single windows apart from those of strings


def _runs(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, Runs, np.ndarray, np.ndarray]]:
    for lo, hi, data, off in slices(batch.column(column), SLICE):
        yield lo, hi, runs(byte_values(data), off, SIZE, GRAM), data, off


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sampled suffixes of a batch, combined within each slice."""
    for batch in batches:
        ids = _ids(batch)
        for lo, _, r, *_ in _runs(batch, 1):
            order = np.argsort(r.gram)
            key, doc_id = r.gram[order], ids[lo + r.row[order]]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
            yield _batch([key[first].view(np.int64), np.diff(np.append(first, len(key))),
                          np.minimum.reduceat(doc_id, first) if len(first) else doc_id], ["key", "copies", "doc_id"])


class SuffixIndex:
    """Levels of sorted suffix tables; ``add`` takes a batch and returns the suffixes it shares."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, str] = {}  # batches that went into a level: its table
        self._made = f"opscore_suffixes_{uuid.uuid4().hex}"
        self._n = 0

    def _write(self, df: DataFrame) -> str:
        self._n += 1
        name = f"{self._made}_{self._n}"
        df.select("key", "copies", "doc_id").write.bucketBy(self.buckets, "key").sortBy("key").option(
            "path", f"{scratch.folder(self.spark)}/{name}").format("parquet").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        scratch.delete(self.spark, f"{scratch.folder(self.spark)}/{name}")

    def add(self, docs: DataFrame) -> DataFrame:
        """Index ``docs`` (doc_id, text); the keys of suffixes that are now found twice or more, new to this batch."""
        found = docs.select("doc_id", "text").mapInArrow(_suffixes, "key long, copies long, doc_id long")
        # dealt by bucket before they are counted: a task then holds the keys of one bucket, not those of its texts
        found = found.repartition(self.buckets, "key")
        name = self._write(found.groupBy("key").agg(F.sum("copies").alias("copies"), F.min("doc_id").alias("doc_id")))
        new = self.spark.table(name)
        shared = new.filter("copies > 1").select("key")
        for level in self.levels.values():
            shared = shared.unionAll(new.join(self.spark.table(level).select("key"), "key").select("key"))
        shared = scratch.stored(shared.coalesce(self.buckets), "suffix-matches")
        size = 1
        while size in self.levels:
            old = self.levels.pop(size)
            a, b = self.spark.table(old).alias("a"), self.spark.table(name).alias("b")
            both = self._write(a.join(b, "key", "full").select(
                "key", (F.coalesce("a.copies", F.lit(0)) + F.coalesce("b.copies", F.lit(0))).alias("copies"),
                F.least("a.doc_id", "b.doc_id").alias("doc_id")))
            self._drop(old)
            self._drop(name)
            name, size = both, 2 * size
        self.levels[size] = name
        return shared

    def clear(self) -> None:
        for name in self.levels.values():
            self._drop(name)
        self.levels = {}


def index_all(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Add ``docs`` in ``batches`` by doc_id; the keys of all suffixes found twice or more."""
    index = SuffixIndex(docs.sparkSession)
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares)).first()[0] or [0] * len(shares)
    edges = [None, *cuts, None]
    shared = None
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = docs
        part = part if low is None else part.filter(F.col("doc_id") > low)
        part = part if high is None else part.filter(F.col("doc_id") <= high)
        found = index.add(part)
        shared = found if shared is None else shared.unionAll(found)
    index.clear()
    return shared


def _span(r: Runs, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return r.first[which], r.last[which] + SIZE


def _in_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix(keys + mix((row + 1).astype(np.uint64)))


def _batch(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _strings(docs: DataFrame, may: object) -> DataFrame:
    """Distinct strings around repeated anchors (a: anchor, h and c: content) with their first document."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            for lo, _, r, *_ in _runs(batch, 1):
                which = np.flatnonzero(may.value.may(r.gram))
                h, c = window_keys(r, *_span(r, which))
                _, new = repeated(_in_row(h, r.row[which]))
                one = which[new]
                yield _batch([r.gram[one].view(np.int64), h[new].view(np.int64), c[new].view(np.int32),
                              ids[lo + r.row[one]]], ["a", "h", "c", "doc_id"])

    return docs.mapInArrow(emit, "a long, h long, c int, doc_id long").groupBy("a", "h", "c").agg(
        F.min("doc_id").alias("doc_id"))


def _first_key(h: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    return mix(h ^ mix(doc_id.view(np.uint64)))


def _first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, doc_id = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        yield _batch([_first_key(h.view(np.uint64), doc_id).view(np.int64)], ["k"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of strings that come in order of anchor, document and place; an anchor's are kept together."""
    held = None
    for batch in _with_end(batches):
        parts = [b for b in (held, batch) if b is not None and len(b)]
        held = None
        if not parts:
            continue
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        anchors = rows.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        end = len(anchors)
        if batch is not None:  # the last anchor may go on in the next batch
            end = int(np.flatnonzero(anchors[1:] != anchors[:-1])[-1]) + 1 if (anchors[1:] != anchors[:-1]).any() else 0
            held = rows.slice(end)
        if end:
            yield _masks(rows.slice(0, end))


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _masks(rows: pa.RecordBatch) -> pa.RecordBatch:
    """A window starts earlier if a smaller document has it, or an earlier place of its own row."""
    anchors, h, doc_id, text_of = (rows.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 3))
    # equal rows bring equal strings; one of each is enough
    same = np.stack([anchors, doc_id, text_of, h])
    order = np.lexsort(same)
    one = np.sort(order[np.append(True, (same[:, order][:, 1:] != same[:, order][:, :-1]).any(0))])
    rows = rows.take(pa.array(one))
    anchors, h, doc_id, text_of = (x[one] for x in (anchors, h, doc_id, text_of))
    texts = rows.column(5).cast(pa.large_binary())
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    count = np.diff(off) - SIZE + 1
    string = np.repeat(np.arange(len(count)), count)
    before = np.cumsum(count) - count
    k = np.arange(len(string)) - before[string]
    start = off[string] + k
    keys = mix(Spans(byte_values(data))(start, start + SIZE) + mix(anchors.view(np.uint64))[string])
    _, first, kind = np.unique(keys, return_index=True, return_inverse=True)
    _, new = repeated(mix(keys + mix(text_of.view(np.uint64) ^ doc_id.view(np.uint64))[string]))
    gone = (doc_id[string][first][kind] != doc_id[string]) | ~new
    mask = np.bitwise_or.reduceat(gone.astype(np.int64) << k, before)
    return pa.RecordBatch.from_arrays([rows.column(2), rows.column(1), rows.column(3), pa.array(mask.astype(np.int64))],
                                      ["doc_id", "h", "text_of", "mask"])


def _in_text(h: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Name of a string within one text."""
    return mix(h + mix(text_of ^ _RUN))


def _own_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, text_of = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for i in (1, 2))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(_in_text(h, text_of).view(np.int64)),
                                          batch.column(3)], ["doc_id", "tag", "h", "mask"])


def _compared(docs: DataFrame, strings: DataFrame, mixed: DataFrame, hot: object) -> DataFrame:
    """doc_id, tag, h, mask of the strings of anchors in ``mixed``: windows of that string that start earlier."""
    spark = docs.sparkSession
    some = strings.join(mixed, "a", "left_semi").select("h", "doc_id").mapInArrow(_first_keys, "k long")
    some = scratch.stored(some, "suffix-firsts")
    first = spark.sparkContext.broadcast(sketch.members(some, "k", some.count()))
    scratch.drop(some)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            for lo, _, r, data, off in _runs(batch, 1):
                text_of = mix(r.spans(off[:-1], off[1:]))
                h = mix(r.spans(*_span(r, slice(None))))
                doc_id = ids[lo + r.row]
                which = np.flatnonzero(first.value.may(_first_key(h, doc_id)) & ~hot.value.may(r.gram))
                _, new = repeated(_in_row(h[which], r.row[which]))
                which = which[new]
                text = [data[a:b].tobytes() for a, b in zip(*_span(r, which), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.gram[which].view(np.int64)), pa.array(h[which].view(np.int64)), pa.array(doc_id[which]),
                     pa.array(text_of[r.row[which]].view(np.int64)), pa.array(r.first[which] - off[r.row[which]]),
                     pa.array(text, pa.binary())], ["a", "h", "doc_id", "text_of", "at", "text"])

    found = docs.mapInArrow(emit, "a long, h long, doc_id long, text_of long, at long, text binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    masks = found.repartition(parts, "a").sortWithinPartitions("a", "doc_id", "text_of", "at").mapInArrow(
        _compare, "doc_id long, h long, text_of long, mask long")
    # what the filter let through in error is no first occurrence
    masks = masks.join(strings.select("doc_id", "h"), ["doc_id", "h"], "left_semi")
    return masks.select("doc_id", "h", "text_of", "mask").mapInArrow(
        _own_masks, "doc_id long, tag long, h long, mask long")


def _crowded(may: object, hot: object):
    """Keys of the windows of anchors with very many contexts."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for _, _, r, *_ in _runs(batch, 1):
                start, _ = r.windows(np.flatnonzero(may.value.may(r.gram) & hot.value.may(r.gram)))
                yield mix(r.spans(start, start + SIZE))
    return keys


def _firsts(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each window once, with its smallest document."""
    h, c, doc_id = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((doc_id, c, h))
    new = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])
    order = order[np.append(True, new)[:len(order)]]
    return h[order], c[order], doc_id[order]


def _windows(docs: DataFrame, may: object, hot: object, again: object) -> DataFrame:
    """Those of them that may be repeated, with their first document; a task combines its own, ``_HELD`` at a time."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids = _ids(batch)
            for lo, _, r, *_ in _runs(batch, 1):
                start, run = r.windows(np.flatnonzero(may.value.may(r.gram) & hot.value.may(r.gram)))
                some = again.value.may(mix(r.spans(start, start + SIZE)))
                start, doc_id = start[some], ids[lo + r.row[run[some]]]
                if not len(start):
                    continue
                held.append((*window_keys(r, start, start + SIZE), doc_id))
                n += len(start)
                if n >= _HELD:
                    held = [_firsts(held)]
                    n = len(held[0][0])
                    if n >= _HELD // 2:
                        yield _named(held[0])
                        held, n = [], 0
        if held:
            yield _named(_firsts(held))

    return docs.mapInArrow(emit, "h long, c int, doc_id long").groupBy("h", "c").agg(F.min("doc_id").alias("doc_id"))


def _named(found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    h, c, doc_id = found
    return _batch([h.view(np.int64), c.view(np.int32), doc_id], ["h", "c", "doc_id"])


def _tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document with the name of its text."""
    for batch in batches:
        tags = [mix(r.spans(off[:-1], off[1:])).view(np.int64) for *_, r, _, off in _runs(batch, 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0, np.int64), *tags]))],
                                         ["doc_id", "text", "tag"])


def _of_each_text(docs: DataFrame, firsts: DataFrame, may: object, hot: object, again: object) -> DataFrame:
    """doc_id, tag, h of what each text holds of the strings and windows of which its doc_id is the first.

    One list for an id that many rows share would hold the strings of them all and meet each row.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = _ids(batch), batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, _, r, *_ in _runs(batch, 1):
                maybe = may.value.may(r.gram)
                apart = maybe & hot.value.may(r.gram)
                which = np.flatnonzero(maybe)
                start, run = r.windows(np.flatnonzero(apart))
                keys = mix(r.spans(start, start + SIZE))
                some = again.value.may(keys)
                keys = np.concatenate([mix(r.spans(*_span(r, which))), keys[some] ^ _RUN])
                row = np.concatenate([r.row[which], r.row[run[some]]])
                _, new = repeated(_in_row(keys, row))
                row = lo + row[new]
                yield _batch([ids[row], tags[row], keys[new].view(np.int64)], ["doc_id", "tag", "h"])

    held = docs.mapInArrow(emit, "doc_id long, tag long, h long").distinct()
    return held.join(firsts, ["doc_id", "h"], "left_semi").select("doc_id", "tag", "h")


def _own(h: np.ndarray, mask: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of what a slice's documents are the first of, and their masks."""
    keys = _in_row(h, row)
    order = np.argsort(keys)
    keys, mask = keys[order], mask[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.bitwise_or.reduceat(mask, first) if len(first) else mask


def _gone(r: Runs, own: tuple[np.ndarray, np.ndarray], may: object, hot: object, again: object, off: np.ndarray) -> np.ndarray:
    """Which bytes of a slice go."""
    maybe = may.value.may(r.gram)
    apart = maybe & hot.value.may(r.gram)
    have, masks = own

    def look_up(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(have, keys)
        found = (at < len(have)) & (have[np.minimum(at, len(have) - 1)] == keys) if len(have) else np.zeros(len(keys), bool)
        return found, at

    whole = np.flatnonzero(maybe & ~apart)
    h, row = mix(r.spans(*_span(r, whole))), r.row[whole]
    keys = _in_row(h, row)
    own_first, _ = look_up(keys)
    _, new = repeated(keys)
    mask = np.where(own_first & new, 0, -1)
    compared, at = look_up(_in_row(_in_text(h, mix(r.spans(off[:-1], off[1:]))[row]), row))
    mask[compared] |= masks[at[compared]]
    every = whole[mask == -1]
    some = np.flatnonzero((mask != 0) & (mask != -1))
    parts, run = r.windows(whole[some])
    bits = np.repeat(mask[some], r.last[whole[some]] - r.first[whole[some]] + 1)
    parts = parts[(bits >> (parts - r.first[run])) & 1 > 0]
    start, run = r.windows(np.flatnonzero(apart))
    keys = mix(r.spans(start, start + SIZE))
    some = again.value.may(keys)
    start = start[some]
    keys = _in_row(keys[some] ^ _RUN, r.row[run[some]])
    first, _ = look_up(keys)
    _, new = repeated(keys)
    # a string that goes whole is one stretch, not a window at a time
    return covered(np.concatenate([parts, start[~(first & new)]]), SIZE, int(off[-1]), _span(r, every))


def _digest(may: object, hot: object, again: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(2)
            lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
            of = np.concatenate([[0], np.cumsum(lengths)])
            held = lists.flatten()
            h, mask = (held.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            for lo, hi, r, data, off in _runs(batch, 1):
                own = _own(h[of[lo]:of[hi]].view(np.uint64), mask[of[lo]:of[hi]],
                           np.repeat(np.arange(hi - lo), lengths[lo:hi]))
                gone = _gone(r, own, may, hot, again, off)
                removed, spans, sums = [], [], []
                for a, b in zip(off[:-1], off[1:], strict=True):
                    out, left = gone[a:b], data[a:b]
                    removed.append(int(np.count_nonzero(out)))
                    spans.append(int(out[:1].sum() + np.count_nonzero(out[1:] & ~out[:-1])))
                    sums.append(hashlib.sha256((left[~out] if removed[-1] else left).tobytes()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(np.diff(off)), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.int64()), pa.array(sums)],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


@contextlib.contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ``MOST_ROWS`` rows for the jobs run meanwhile; the caller's own setting comes back."""
    before = spark.conf.get(_ROWS)
    if not 0 < int(before) <= MOST_ROWS:
        spark.conf.set(_ROWS, str(MOST_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ROWS, before)


def op3_suffix_dedup(docs: DataFrame, batches: int = BATCHES, most_strings: int = MOST_STRINGS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes kept, for every document (stored)."""
    with _small_batches(docs.sparkSession):
        return scratch.stored(_deduped(docs, batches, most_strings), "suffix-digests")


def _deduped(docs: DataFrame, batches: int, most_strings: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    shared = index_all(docs, batches)
    may = spark.sparkContext.broadcast(sketch.members(shared, "key", shared.count()))
    strings = scratch.stored(_strings(docs, may), "suffix-strings")
    contexts = scratch.stored(strings.groupBy("a").count().filter("count > 1"), "suffix-contexts")
    many = contexts.filter(F.col("count") > most_strings).select("a")
    hot = spark.sparkContext.broadcast(sketch.members(many, "a", many.count()))
    masks = scratch.stored(_compared(docs, strings, contexts.filter(F.col("count") <= most_strings), hot), "suffix-masks")
    crowd = contexts.filter(F.col("count") > most_strings).agg(F.sum("count")).first()[0] or 0
    again = spark.sparkContext.broadcast(sketch.repeats(docs, _crowded(may, hot), crowd * GRAM))
    single = scratch.stored(_windows(docs, may, hot, again).select("doc_id", F.col("h").bitwiseXOR(
        F.lit(int(_RUN.astype(np.int64)))).alias("h")), "suffix-windows")
    own = strings.select("doc_id", "h").unionAll(single)
    by, whole = ["doc_id"], docs
    if ids_repeat(docs):
        by, whole = ["doc_id", "tag"], docs.mapInArrow(_tagged, "doc_id long, text string, tag long")
        own = _of_each_text(whole, own, may, hot, again)
    firsts = own.select(*by, "h", F.lit(0).cast("long").alias("mask")).unionAll(masks.select(*by, "h", "mask")).groupBy(
        *by).agg(F.collect_list(F.struct("h", "mask")).alias("firsts"))
    return whole.join(firsts, by, "left").select("doc_id", "text", "firsts").mapInArrow(
        _digest(may, hot, again), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumn(
        "doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


#: The same by brute force: every window as hexadecimal digits, two to a byte.
ORACLE_SQL = f"""
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
bytes AS (SELECT doc_id, i, substr(x, 2 * i - 1, 2) AS byte
          FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 + 1)) AS i FROM docs)),
starts AS (SELECT doc_id, i, substr(x, 2 * i - 1, {2 * SIZE}) AS w
           FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 - {SIZE - 2})) AS i FROM docs)),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1 AS again FROM starts),
marked AS (
  SELECT b.doc_id, i, byte,
         coalesce(max(again) OVER (PARTITION BY b.doc_id ORDER BY i ROWS {SIZE - 1} PRECEDING), false) AS gone
  FROM bytes b LEFT JOIN windows USING (doc_id, i)),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM marked),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
         string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS x
  FROM runs GROUP BY doc_id)
SELECT doc_id, len(docs.x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.x, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
