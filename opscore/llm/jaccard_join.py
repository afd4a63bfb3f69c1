"""Near-duplicate join on word shingles (Jaccard), with answers derived from similar sets.

A document is the set of its distinct 5-word shingles (64-bit hashes of the words,
A-Z lower-cased).  Two documents link when 100 * intersection >= 75 * union.

* Equal sets are one class at once: a grouped 128-bit fingerprint.
* Order: a shingle is placed by (class, hash).  Class 0 is certainly found once (a
  count-min sketch over the half of all shingles with small hashes says so), class 1 may
  be found again, class 2 has a long index list, or a large hash.  Any global order is
  valid for the prefix filter; this one keeps frequent shingles out of the prefixes.
* Prefix filter: sets of n shingles that link share one of their first
  n - ceil(0.75 n) + 1 shingles.  Only prefix shingles that may repeat get index lists.
* Answers of the hubs: each list's smallest document is its hub, and every member is
  compared with its hub exactly: as many pairs as list entries, however long a list.
* Derived answers: what the other members of a list have in common follows from their
  answers at the hub.  Members of one component need no comparison at all, as a link
  between them adds nothing.  For others, with i = common shingles with the hub, the
  overlap of x and y is at most min(ix, iy) + min(nx - ix, ny - iy): the part within the hub
  and the part outside.  Only where that, the sizes and the positions in
  the list (1 + the fewer shingles that follow) allow a link is the pair verified.
* Parity signatures: a set's shingles are thrown into ``BITS`` cells, one bit each for an odd
  count.  Cells in which two sets differ are no more than the shingles in which they do, so
  pairs with too many are out before any set is read.

Exact: nothing is sampled or capped.  Frequent shingles only move within the order.

Defined cases: null text and texts without words have an empty set, which links with
nothing (n_shingles 0); fewer than five words are one shingle; rows that share a doc_id are
one document that has the links of each of them; a null doc_id is an id of its own, smaller
than all others; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sketch
from .components import components
from .scratch import drop, stored
from .text import LOWER, U64, Spans, byte_values, distinct, mix, slices, word_hashes, words

SHINGLE = 5
LONG_LIST = 64
BITS = 1024
SALT = 32
SLICE = 1 << 17  # bytes: arrays of eight times that stay in a core's caches
_HALF = U64(1 << 63)
_NO_ID = -(1 << 63)  # stands for a null doc_id


def row_sets(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, the sorted distinct shingles of each row) by slices."""
    for lo, _, data, off in slices(texts, SLICE):
        data = LOWER[data]
        starts, ends, bounds = words(data, off)
        spans = Spans(word_hashes(Spans(byte_values(data)), starts, ends))
        grams = mix(spans.windows(SHINGLE))
        sets = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                sets.append(distinct(grams[a:b - SHINGLE + 1]))
            else:
                whole = spans(np.array([a]), np.array([b])) + U64(b - a)
                sets.append(mix(whole) if b > a else np.zeros(0, U64))
        yield lo, sets


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U64 else x.astype(np.int64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = _ids(batch)
        for lo, sets in row_sets(batch.column(1)):
            n = np.array([len(s) for s in sets], np.int64)
            every, some = np.concatenate([np.zeros(0, U64), *sets]), np.flatnonzero(n)
            first = (np.cumsum(n) - n)[some]
            f1, f2 = np.zeros(len(sets), U64), np.zeros(len(sets), U64)
            if len(some):
                f1[some] = np.add.reduceat(every, first)
                f2[some] = np.bitwise_xor.reduceat(mix(every + U64(1)), first)
            cell = np.repeat(np.arange(len(sets)) * BITS, n) + (mix(every) & U64(BITS - 1)).astype(np.int64)
            odd = (np.bincount(cell, minlength=len(sets) * BITS) & 1).astype(np.uint8)
            marks = np.packbits(odd.reshape(-1, BITS), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [_long(ids[lo:lo + len(sets)]), _long(n), _long(f1), _long(f2),
                 *(pa.array(np.ascontiguousarray(marks[:, k])) for k in range(len(MARKS)))], ["doc_id", "n", "f1", "f2", *MARKS])


MARKS = [f"m{k}" for k in range(BITS // 64)]


def _differ(x: str, y: str) -> Column:
    """In how many cells two signatures differ: at most the shingles that only one of the sets has."""
    return sum((F.bit_count(F.col(f"{x}{m}").bitwiseXOR(F.col(f"{y}{m}"))) for m in MARKS[1:]),
               F.bit_count(F.col(f"{x}{MARKS[0]}").bitwiseXOR(F.col(f"{y}{MARKS[0]}"))))


def _need(na: Column, nb: Column) -> Column:
    """Smallest overlap with which two sets link."""
    return F.ceil(3 * (na + nb) / 7)


def _plausible(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose sizes and signatures allow a link."""
    for side in ("a", "b"):
        own = marks.select(F.col("doc_id").alias(side), F.col("n").alias(f"{side}_n"),
                           *(F.col(m).alias(f"{side}_{m}") for m in MARKS))
        pairs = pairs.join(own, side)
    need = _need(F.col("a_n"), F.col("b_n"))
    return pairs.filter((F.least("a_n", "b_n") >= need) & (_differ("a_", "b_") <= F.col("a_n") + F.col("b_n") - 2 * need)
                        ).select("a", "b").distinct()


def _low_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for _, sets in row_sets(batch.column(0)):
            if sets:
                every = np.concatenate(sets)
                yield every[every < _HALF]


def prefix_length(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def _prefixes(docs: DataFrame, may: object, long_: object | None) -> DataFrame:
    """Index entries: the shingles of each prefix that may repeat, with place and set size."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            for lo, sets in row_sets(batch.column(1)):
                if not sets:
                    continue
                every = np.concatenate(sets)
                kind = may.value.may(every).astype(np.int8)
                kind[every >= _HALF] = 2
                if long_ is not None:
                    kind[long_.value.may(every)] = 2
                token, place, size, doc, at = [], [], [], [], 0
                for i, s in enumerate(sets):
                    own = kind[at:at + len(s)]
                    at += len(s)
                    order = np.argsort(own, kind="stable")[:prefix_length(len(s))] if len(s) else []
                    keep = np.flatnonzero(own[order] > 0) if len(s) else np.zeros(0, np.int64)
                    if len(keep):
                        token.append(s[order[keep]])
                        place.append(keep)
                        size.append(np.full(len(keep), len(s)))
                        doc.append(np.full(len(keep), ids[lo + i]))
                if token:
                    yield pa.RecordBatch.from_arrays(
                        [_long(np.concatenate(token)), pa.array(np.concatenate(place).astype(np.int32)),
                         pa.array(np.concatenate(size).astype(np.int32)), _long(np.concatenate(doc))],
                        ["token", "place", "n", "doc_id"])

    return docs.mapInArrow(emit, "token long, place int, n int, doc_id long")


def _sets(docs: DataFrame, wanted: object) -> DataFrame:
    """The sets of the documents whose id ``wanted`` may hold."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            some = np.flatnonzero(wanted.value.may(ids.view(U64)))
            part = batch.take(pa.array(some))
            for lo, sets in row_sets(part.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [_long(ids[some[lo:lo + len(sets)]]),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return docs.mapInArrow(emit, "doc_id long, shingles array<long>")


def _common(pairs: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (a, b) with the exact overlap i and the set sizes na, nb; the table of sets that they read."""
    spark = docs.sparkSession
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = spark.sparkContext.broadcast(sketch.members(ids, "id", ids.count()))
    sets = stored(_sets(docs, wanted).join(ids, F.col("doc_id") == F.col("id"), "left_semi"), "shingle-sets")
    left = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
    return left.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b").select(
        "a", "b", F.size(F.array_intersect("sa", "sb")).alias("i"), F.size("sa").alias("na"), F.size("sb").alias("nb")), sets


_LINKS = "100 * i >= 75 * (na + nb - i)"


def links(docs: DataFrame, long_list: int = LONG_LIST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(measured documents, links that join all components, components).

    The measured documents have doc_id, n and fingerprint; every link between different sets is
    either in the second table or implied by its components.  What else was written on the way is deleted.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    measured = stored(docs.mapInArrow(_fingerprints, "doc_id long, n long, f1 long, f2 long, "
                                      + ", ".join(f"{m} long" for m in MARKS)), "shingle-counts")
    classes = measured.filter("n > 0").groupBy("n", "f1", "f2").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    # copies meet their first in SALT parts: one text may be a third of all rows
    several = classes.filter("rows > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int"))
    copies = stored(salted.join(several, ["n", "f1", "f2", "salt"]).filter("doc_id != first").select(
        F.col("doc_id").alias("a"), F.col("first").alias("b")), "copies")
    firsts = classes.select(F.col("first").alias("doc_id")).distinct()

    total = measured.agg(F.sum("n")).first()[0] or 0
    may = spark.sparkContext.broadcast(sketch.repeats(docs.select("text"), _low_shingles, total // 2))
    counts = _prefixes(docs, may, None).groupBy("token").count()
    lengthy = stored(counts.filter(F.col("count") > long_list).select("token"), "long-lists")
    long_ = spark.sparkContext.broadcast(sketch.members(lengthy, "token", lengthy.count()))
    drop(lengthy)
    entries = stored(_prefixes(docs, may, long_).join(firsts, "doc_id", "left_semi"), "entries")

    hubs = entries.groupBy("token").agg(F.min("doc_id").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    met = entries.join(hubs, "token")
    marks = measured.select("doc_id", "n", *MARKS)
    pairs = stored(_plausible(met.filter("doc_id != hub").select(
        F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct(), marks), "hub-pairs")
    common, sets = _common(pairs, docs)
    answers = stored(common, "hub-answers")
    drop(pairs)
    drop(sets)
    found = answers.filter(_LINKS).select("a", "b")
    parts = components(found)

    # what is left: members of one list that are in different components
    member = met.filter("members > 2 AND doc_id != hub").join(
        answers.select(F.col("a").alias("doc_id"), F.col("b").alias("hub"), "i"), ["doc_id", "hub"], "left").join(
        parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    mixed = member.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi")
    member = member.join(mixed, "token", "left_semi").select("token", "doc_id", "hub", "place", "n", "i", "component")
    member = stored(member.join(marks.drop("n"), "doc_id"), "list-members")
    x, y = member.alias("x"), member.alias("y")
    need = _need(F.col("x.n"), F.col("y.n"))
    # unknown where a document cannot link with its hub
    within = F.least("x.i", "y.i") + F.least(F.expr("x.n - x.i"), F.expr("y.n - y.i")) >= need
    may_link = ((F.col("x.token") == F.col("y.token")) & (F.col("x.doc_id") < F.col("y.doc_id"))
                & (F.col("x.component") != F.col("y.component"))
                & (4 * F.least("x.n", "y.n") >= 3 * F.greatest("x.n", "y.n"))
                & (1 + F.least(F.expr("x.n - x.place - 1"), F.expr("y.n - y.place - 1")) >= need)
                & (F.col("x.i").isNull() | F.col("y.i").isNull() | within)
                & (_differ("x.", "y.") <= F.col("x.n") + F.col("y.n") - 2 * need))
    rest = stored(x.join(y, may_link).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct(),
                  "list-pairs")
    for table in (member, answers, entries):
        drop(table)
    common, sets = _common(rest, docs)
    more = common.filter(_LINKS).select("a", "b")
    every = stored(copies.unionAll(parts.select(F.col("id").alias("a"), F.col("component").alias("b"))).unionAll(more),
                   "all-links")
    for table in (rest, sets, copies, parts):
        drop(table)
    return measured, every, components(every)


def op7_jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    measured, every, parts = links(docs)
    drop(every)
    joined = measured.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    real = lambda c: F.when(c != _NO_ID, c)
    return joined.select(real(F.col("doc_id")).alias("doc_id"), F.col("n").alias("n_shingles"),
                         real(F.coalesce("component", "doc_id")).alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each group of linked documents the one with the smallest doc_id stays, all columns.

    A null doc_id is linked like any other; its rows stay, as the smallest of their group.
    """
    measured, every, parts = links(docs)
    drop(measured)
    drop(every)
    later = parts.select(F.col("id").alias("__later"))
    return docs.join(later, F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)) == F.col("__later"), "left_anti")


#: The same by brute force: every pair that shares a shingle, then what is reachable.
ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach(id, other) AS (
  SELECT a, b FROM links
  UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(lowest, doc_id)) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT id AS doc_id, min(other) AS lowest FROM reach GROUP BY id) USING (doc_id)
"""
