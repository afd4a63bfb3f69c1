"""Substring dedup of word windows with a count-min prefilter.

A window is ``size`` consecutive words.  A word goes if a window that covers it
also starts earlier (in a smaller doc_id, or earlier in the same document).

1. Sketch: every task counts the anchor grams of its windows (see ``anchors``) in a
   count-min sketch; the merged sketch overestimates how often a window occurs, since a
   window is no more frequent than its anchor gram and cells only add up.
2. Exact pass: only the windows estimated repeated are sent, once per document, as 96-bit
   keys, and grouped with map-side combining to their first document.  No window that
   repeats is lost; those let through in error are found single here.
3. Every document meets the list of windows of which it is the first and drops the words
   covered by any other window estimated repeated.

Grouping is by window with a partial ``min``, so a passage in a third of all documents
is one row per task.  What meets in one task per document is bounded by its own windows;
where doc_ids repeat (or several are null), the list of firsts is kept for each different
text of an id, so it holds no other row's windows.

Defined cases: null text is empty; texts of fewer than ``size`` words keep all;
rows that share a doc_id are each judged alone against all other doc_ids; a null doc_id
comes before all others; an empty table gives no rows; extra columns are carried along by
``dedup`` and ignored by the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import sketch
from .anchors import Runs, runs, window_keys
from .text import SLICE, Spans, byte_values, covered, ids_repeat, mix, repeated, slices, word_hashes, words

SIZE, GRAM = 20, 10
_NO_ID = -(1 << 63)  # stands for a null doc_id


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, Runs, np.ndarray, np.ndarray, np.ndarray]]:
    for lo, hi, data, off in slices(batch.column(column), SLICE):
        starts, ends, bounds = words(data, off)
        yield lo, hi, runs(word_hashes(Spans(byte_values(data)), starts, ends), bounds, SIZE, GRAM), starts, ends, bounds


def _anchor_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for _, _, r, *_ in _slices(batch, 0):
            yield r.gram


def _in_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    return mix(keys + mix((row + 1).astype(np.uint64)))


def _firsts(docs: DataFrame, may: object, by: list[str]) -> DataFrame:
    """doc_id and the windows, among those estimated repeated, that no smaller doc_id has.

    Where ids repeat, ``by`` names the text too: each text of an id gets its own windows among
    those of which the id is the first.  One list for the id would hold the windows of all
    its rows and meet each of them.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
            for lo, _, r, *_ in _slices(batch, 0):
                start, run = r.windows(np.flatnonzero(may.value.may(r.gram)))
                h, c = window_keys(r, start, start + SIZE)
                row = r.row[run]
                _, new = repeated(_in_row(h, row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[new].view(np.int64)), pa.array(c[new].view(np.int32)),
                     *(pa.array(o[lo + row[new]]) for o in owner)], ["h", "c", *by])

    seen = docs.select("text", *by).mapInArrow(emit, ", ".join(["h long", "c int", *(f"{k} long" for k in by)]))
    firsts = seen.groupBy("h", "c").agg(F.min("doc_id").alias("doc_id"))
    if len(by) > 1:
        # equal rows bring equal windows: a partial distinct leaves one of each
        firsts = seen.distinct().join(firsts, ["h", "c", "doc_id"], "left_semi")
    return firsts.groupBy(*by).agg(F.collect_list("h").alias("__firsts"))


def _with_firsts(docs: DataFrame) -> tuple[DataFrame, object]:
    """The documents with their ``__firsts``, and the broadcast sketch."""
    spark = docs.sparkSession
    docs = docs.withColumns({"doc_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
                             "text": F.col("text").cast("string")})
    octets = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    by = ["doc_id"]
    if ids_repeat(docs):
        by, docs = ["doc_id", "__tag"], docs.withColumn("__tag", F.xxhash64("text"))
    may = spark.sparkContext.broadcast(
        sketch.repeats(docs.select("text"), _anchor_grams, octets // (3 * (SIZE - GRAM + 2))))
    return docs.join(_firsts(docs, may, by), by, "left").drop("__tag"), may


def _removed(batch: pa.RecordBatch, may: object) -> Iterator[tuple]:
    """Per slice: rows, the bytes of each word, and which words go."""
    text, lists = batch.schema.get_field_index("text"), batch.column(batch.schema.get_field_index("__firsts"))
    lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    of = np.concatenate([[0], np.cumsum(lengths)])
    held = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    for lo, hi, r, starts, ends, bounds in _slices(batch, text):
        start, run = r.windows(np.flatnonzero(may.value.may(r.gram)))
        keys = _in_row(mix(r.spans(start, start + SIZE)), r.row[run])
        own = _in_row(held[of[lo]:of[hi]], np.repeat(np.arange(hi - lo), lengths[lo:hi]))
        _, new = repeated(keys)
        gone = ~(new & np.isin(keys, own))
        yield lo, hi, starts, ends, bounds, covered(start[gone], SIZE, len(starts))


def _digest(may: object):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi, _, _, bounds, gone in _removed(batch, may):
                sums = []
                for i, text in enumerate(texts.slice(lo, hi - lo).to_pylist()):
                    kept, out = (text or "").encode().split(), gone[bounds[i]:bounds[i + 1]]
                    if out.any():
                        kept = [kept[k] for k in np.flatnonzero(~out)]
                    sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                left = np.concatenate([[0], np.cumsum(gone)])[bounds]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array(np.diff(left)), pa.array(sums)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def op9_substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words kept, for every document."""
    found, may = _with_firsts(docs.select("doc_id", "text"))
    return found.mapInArrow(_digest(may), "doc_id long, n_words long, n_removed long, kept_sha256 string").withColumn(
        "doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))


def dedup(docs: DataFrame) -> DataFrame:
    """The documents without their repeated words, all columns; those left without a word go.

    Kept words keep the white space that follows them.  ``n_chars``, where there is one,
    becomes the new text's.
    """
    found, may = _with_firsts(docs)
    fields = [f for f in found.schema if f.name != "__firsts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            old = batch.column(at).to_pylist()
            for lo, hi, starts, ends, bounds, gone in _removed(batch, may):
                texts, keep, first_byte = [], [], 0
                for i in range(lo, hi):
                    data = (old[i] or "").encode()
                    a, b = bounds[i - lo], bounds[i - lo + 1]
                    out = gone[a:b]
                    if out.any():
                        from_, to = starts[a:b] - first_byte, np.append(starts[a + 1:b] - first_byte, len(data))
                        data = b"".join(data[from_[k]:to[k]] for k in np.flatnonzero(~out))
                    keep.append(not len(out) or not out.all())
                    texts.append(data.decode() if old[i] is not None else None)
                    first_byte += len((old[i] or "").encode())
                part = batch.slice(lo, hi - lo)
                columns = [pa.array(texts, pa.string()) if f.name == "text" else part.column(part.schema.get_field_index(f.name))
                           for f in fields]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields]).filter(pa.array(keep))

    kept = found.mapInArrow(run, StructType(fields)).withColumn(
        "doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


#: The same by brute force: every window as text.
ORACLE_SQL = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
spoken AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
starts AS (SELECT doc_id, concat_ws(' ', {", ".join(f"lead(word, {k}) OVER o" for k in range(SIZE))}) AS words, i,
                  lead(i, {SIZE - 1}) OVER o AS whole FROM spoken WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1 AS again
  FROM starts WHERE whole IS NOT NULL),
marked AS (
  SELECT s.doc_id, i, word,
         coalesce(max(again) OVER (PARTITION BY s.doc_id ORDER BY i ROWS {SIZE - 1} PRECEDING), false) AS gone
  FROM spoken s LEFT JOIN windows USING (doc_id, i)),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS words
  FROM marked GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
