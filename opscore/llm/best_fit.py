"""Best-fit packing of documents into fixed-length training sequences, with conflicts.

A bin holds ``CAPACITY`` words.  Two pieces conflict, and never share a bin, if they come
from one source or from one duplicate cluster: texts that are equal but for case and white
space, and in ``op8_best_fit`` also the components of near copies of ``jaccard_join`` (five
words, 0.75).  A longer document is cut into whole bins of its own and a rest.

Pieces are dealt by hash into shards of about ``SHARD`` pieces, so neither a hot source nor a
group of copies gathers in one task, and the work per shard is bounded at any
size.  Within a shard the pieces go in order of size, the largest first.  Open bins are
ordered by the room they have left, and carry bitmaps of the sources, clusters and
components they hold.  A piece looks up the successor of its size among the bins' room and goes on from
there until a bin without a conflict is found: the tightest compatible one.  Without one
it opens a new bin.  Sources and clusters with a single piece in the shard need no bit.

Defined cases: null texts and texts without a word have no piece; a null source or cluster
conflicts with nothing; ties go by doc_id, then by row; rows that share a doc_id are packed each; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .jaccard_join import _NO_ID as NO_ID
from .jaccard_join import links
from .scratch import drop, stored
from .text import U64, Spans, byte_values, mix, slices, word_hashes, words

CAPACITY = 2048
SHARD = 4096
PIECES = "doc_id long, piece int, first_word long, n_words long, shard long, bin long"


def _bits(values: np.ndarray) -> tuple[np.ndarray, int]:
    """(bit of each piece or -1, 64-bit words needed): values found twice or more get a bit."""
    codes, names = pd.factorize(values)  # nulls: -1
    counts = np.bincount(codes[codes >= 0], minlength=len(names))
    place = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1)
    bit = np.where(codes >= 0, place[codes], -1) if len(names) else np.full(len(codes), -1)
    return bit, int(place.max(initial=-1)) // 64 + 1


def best_fit(sizes: np.ndarray, marks: list[np.ndarray], capacity: int, stride: int = 256) -> np.ndarray:
    """Bin of each piece, taken in the given order; pieces with an equal mark (of one kind) never share one."""
    bits = [_bits(m) for m in marks]
    offsets = np.cumsum([0] + [64 * n for _, n in bits])
    width = max(1, int(offsets[-1]) // 64)
    held = np.zeros((len(sizes) + 1, width), np.uint64)  # bitmaps by bin
    room, order = np.zeros(len(sizes) + 1, np.int64), np.zeros(len(sizes) + 1, np.int64)  # open bins by room left
    open_ = made = 0
    out = np.zeros(len(sizes), np.int64)
    for i, size in enumerate(sizes):
        own = [(int(o + b[i]) // 64, np.uint64(1) << np.uint64(int(o + b[i]) % 64))
               for (b, _), o in zip(bits, offsets, strict=False) if b[i] >= 0]
        at = int(np.searchsorted(room[:open_], size))
        found = -1
        while at < open_ and found < 0:
            near = order[at:min(open_, at + stride)]
            free = np.ones(len(near), bool)
            for word, bit in own:
                free &= (held[near, word] & bit) == 0
            first = int(np.argmax(free))
            if free[first]:
                found = at + first
            at += stride
        if found < 0:
            bin_, left = made, capacity - size
            made += 1
        else:
            bin_, left = int(order[found]), int(room[found]) - size
            room[found:open_ - 1], order[found:open_ - 1] = room[found + 1:open_].copy(), order[found + 1:open_].copy()
            open_ -= 1
        for word, bit in own:
            held[bin_, word] |= bit
        out[i] = bin_
        if left > 0:
            to = int(np.searchsorted(room[:open_], left))
            room[to + 1:open_ + 1], order[to + 1:open_ + 1] = room[to:open_].copy(), order[to:open_].copy()
            room[to], order[to] = left, bin_
            open_ += 1
    return out


def measured(docs: DataFrame, cluster: Column | None = None) -> DataFrame:
    """A row for each document with words (stored): row, doc_id, source, total (words) and cluster.

    The texts are read once.  Without a ``cluster`` it is a hash of the lower-cased words: texts equal
    but for case and white space have one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in slices(batch.column(3)):
                starts, ends, bounds = words(data, off)
                same = Spans(word_hashes(Spans(byte_values(data)), starts, ends))(bounds[:-1], bounds[1:])
                total = np.diff(bounds)
                some = pa.array(np.flatnonzero(total))
                part = batch.slice(lo, hi - lo).take(some)
                own = pa.array(mix(same + total.astype(U64)).view(np.int64)).take(some) if cluster is None else part.column(2)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(total).take(some), own],
                                                 ["doc_id", "source", "total", "cluster"])

    given = F.lit(None).cast("long") if cluster is None else F.xxhash64(cluster)
    given = given if cluster is None else F.when(cluster.isNotNull(), given)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        given.alias("cluster"), F.lower(F.col("text").cast("string")).alias("text"))
    rows = plain.mapInArrow(run, "doc_id long, source string, total long, cluster long")
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "word-counts")


def pack(docs: DataFrame, capacity: int = CAPACITY, cluster: Column | None = None, near: DataFrame | None = None) -> DataFrame:
    """A row for each piece: doc_id, piece, first_word, n_words, bin_id and how full that bin is.

    Documents of ``capacity`` words and more: whole bins come first, the rest is the last piece.
    ``near``: id and component of documents that have near copies; one component conflicts too.
    """
    rows = measured(docs, cluster)
    shards = max(1, -(-rows.count() // SHARD))
    if near is None:
        rows = rows.withColumn("component", F.lit(None).cast("string"))
    else:
        rows = rows.join(near.select("id", F.col("component").cast("string").alias("component")),
                         F.coalesce("doc_id", F.lit(NO_ID)) == F.col("id"), "left").drop("id")
    pieces = rows.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(capacity).cast("long"))
                                               ).alias("piece", "first_word")).withColumn(
        "n_words", F.least(F.lit(capacity), F.col("total") - F.col("first_word")))
    full = pieces.filter(F.col("n_words") == capacity).select(
        "doc_id", "piece", "first_word", "n_words", F.concat_ws(
            "-", F.lit("whole"), "row", "piece").alias("bin_id"), F.lit(capacity).cast("long").alias("bin_words"))
    rest = pieces.filter(F.col("n_words") < capacity)
    # the row number deals equal rows over the shards too
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "n_words", "row"), F.lit(shards)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_words", "doc_id", "cluster", "source", "row"], ascending=[False, True, True, True, True],
                                  kind="stable", na_position="first").reset_index(drop=True)
        group["bin"] = best_fit(group["n_words"].to_numpy(), [group["source"].to_numpy(object), group["cluster"].to_numpy(),
                                                                  group["component"].to_numpy()], capacity)
        group["bin_words"] = group.groupby("bin")["n_words"].transform("sum")
        return group[["doc_id", "piece", "first_word", "n_words", "shard", "bin", "bin_words"]]

    packed = rest.groupBy("shard").applyInPandas(run, PIECES + ", bin_words long").select(
        "doc_id", "piece", "first_word", "n_words", F.concat_ws("-", "shard", "bin").alias("bin_id"), "bin_words")
    return full.unionAll(packed)


def op8_best_fit(docs: DataFrame) -> DataFrame:
    measured_sets, every, parts = links(docs)
    drop(measured_sets)
    drop(every)
    # a component's smallest document is in no row of its own
    near = parts.unionAll(parts.select(F.col("component").alias("id"), "component").distinct())
    return pack(docs, near=near)
