"""License scan as an exact set-similarity join (DataFrame functions only).

Text blocks and license templates are sets of words.  Blocks are the lines and, as notices are
wrapped, overlapping windows of consecutive words across lines: ``WIDE`` times as long as the
longest template, one at each such length, so any run of twice that length is whole in one.  A block carries a
template's label if it holds at least ``THRESHOLD`` of the template's words; with n words
that is an overlap of at least need = ceil(THRESHOLD * n).  The join finds every such
pair, without comparing each block with each template:

* frequency order: the template words are counted over all documents of the corpus and put
  into one global order, the rarest first;
* prefix filter: of a template only its n - need + 1 rarest words are indexed, as a block
  with enough of its words must have one of those; of a block's words the same holds;
* length filter: a block with fewer template words than ``need`` is out, and so is a document,
  before it is cut into blocks;
* positional filter: a pair met at place i of the template and place j of the block can
  share no more than 1 + min(words after i, words after j).

What remains is verified by counting the common words.  The index has a row for each
template word, so it is bounded by the templates and is broadcast.

Beside it the base phrases are found exactly, at consecutive words.

Defined cases: null text is empty; a block without template words matches nothing; a
template word that the corpus lacks is the rarest; rows that share a doc_id (null
included) share the labels found in any of them; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
THRESHOLD = 0.9
WIDE = 3
#: Notices in common use, label first.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "released under the bsd license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0"),
    ("cc0-1.0", "to the extent possible under law waived all copyright and related or neighboring rights"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose is hereby granted"),
]


def need(n: int, threshold: float = THRESHOLD) -> int:
    return math.ceil(threshold * n - 1e-9)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _literal(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words))


def _holds(words: Column, wanted: list[str], least: int | None = None) -> Column:
    own = sorted(set(wanted))
    return F.size(F.array_intersect(words, _literal(own))) >= (len(own) if least is None else least)


def _any(conditions: list[Column]) -> Column:
    found = conditions[0]
    for c in conditions[1:]:
        found = found | c
    return found


def read(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One pass over the texts: n_words, base places and labels, the template words of the document
    (``hits``) and, if it has enough of them for some template, those of each block (``lines``).
    """
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    spoken = sorted({w for p in PHRASES for w in p.split()})
    text = F.col("text")
    found = docs.select("doc_id", "text", _words(text).alias("words")).select(
        "doc_id", "text", "words", F.size("words").cast("long").alias("n_words"),
        F.array_intersect("words", _literal(vocabulary)).alias("hits"),
        F.array_intersect("words", _literal(spoken)).alias("spoken"))
    none = F.array().cast("array<int>")
    places = {label: F.when(_holds(F.col("spoken"), p.split()), _starts(F.col("words"), p.split())).otherwise(none)
              for p, label in PHRASES.items()}
    enough = _any([_holds(F.col("hits"), t.split(), need(len(set(t.split())))) for _, t in templates])
    lines = F.transform(F.split(text, "\n"), lambda line: F.array_intersect(_words(line), _literal(vocabulary)))
    step = max(len(t.split()) for _, t in templates)
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(step)),
                          lambda i: F.array_intersect(F.slice("words", i, WIDE * step), _literal(vocabulary)))
    return found.select("doc_id", "n_words", "hits", *(c.alias(f"at_{label}") for label, c in places.items()),
                        F.when(enough, F.concat(lines, windows)).alias("lines"))


def blocks(found: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, line and the template words of each block that has enough of them for some template."""
    least = min(need(len(set(t.split()))) for _, t in templates)
    return found.select("doc_id", F.posexplode("lines").alias("line", "words")).filter(F.size("words") >= least)


def ordered_templates(found: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """A row for each template word: its place in the global order and within its template."""
    spark = found.sparkSession
    rows = [(i, label, w) for i, (label, text) in enumerate(templates) for w in sorted(set(text.split()))]
    known = spark.createDataFrame(rows, "template int, label string, word string")
    sizes = [(i, len(set(t.split())), need(len(set(t.split())))) for i, (_, t) in enumerate(templates)]
    counts = found.select(F.explode("hits").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    place = Window.partitionBy("template").orderBy(F.coalesce("n", F.lit(0)), "word")
    return known.join(counts, "word", "left").join(
        spark.createDataFrame(sizes, "template int, size int, need int"), "template").withColumns({
            "place": F.row_number().over(place) - 1,
            "rank": F.coalesce("n", F.lit(0))})


def matches(found: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, line, label and containment of every block that meets the threshold."""
    lines = blocks(found, templates)
    index = ordered_templates(found, templates)
    # the global order as one small map, at most the templates' words
    order = index.select("word", "rank").distinct().collect()
    ranks = {r["word"]: i for i, r in enumerate(sorted(order, key=lambda r: (r["rank"], r["word"])))}
    place = F.create_map(*(F.lit(x) for w, i in ranks.items() for x in (w, i)))
    prefix = index.filter(F.col("place") <= F.col("size") - F.col("need")).select(
        "template", "label", "size", "need", "word", "place")
    whole = index.groupBy("template").agg(F.collect_list("word").alias("all_words"))
    met = lines.withColumn("words", F.transform(
        F.array_sort(F.transform("words", lambda w: F.struct(place[w].alias("at"), w.alias("word")))),
        lambda s: s["word"])).select("doc_id", "line", "words", F.posexplode("words").alias("at", "word"))
    pairs = met.join(F.broadcast(prefix), "word").filter(
        (F.size("words") >= F.col("need"))
        & (F.col("need") <= 1 + F.least(F.col("size") - F.col("place") - 1, F.size("words") - F.col("at") - 1)))
    shared = F.size(F.array_intersect("words", "all_words"))
    # a pair is met once for each common prefix word; it is verified at the first of them
    return pairs.join(F.broadcast(whole), "template").filter(shared >= F.col("need")).groupBy(
        "doc_id", "line", "label").agg(F.max(shared / F.col("size")).alias("containment"))


def _starts(words: Column, phrase: list[str]) -> Column:
    found = lambda i: F.reduce(
        F.array(*(F.get(words, i + k) == w for k, w in enumerate(phrase))), F.lit(True),
        lambda a, b: a & F.coalesce(b, F.lit(False)))
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), found)


def _base(found: DataFrame) -> DataFrame:
    """doc_id, n_words, base places (smallest, largest, number) and base labels."""
    labels = list(PHRASES.values())
    places = F.flatten(F.array(*(F.col(f"`at_{label}`") for label in labels)))
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        F.array_compact(F.array(*(F.when(F.size(F.col(f"`at_{label}`")) > 0, F.lit(label)) for label in labels))).alias("base"))


def op6_license_scan(docs: DataFrame) -> DataFrame:
    """The digest of every document: words, base places, labels and score.

    ``score`` is 1 with a base label, else the largest containment found, else 0.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    table = stored(read(docs), "license-words")
    found = matches(table).groupBy(F.col("doc_id").alias("found_in")).agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    joined = _base(table).join(found, F.col("doc_id").eqNullSafe(F.col("found_in")), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def _sql_words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}')"


_STEP = max(len(t.split()) for _, t in TEMPLATES)
#: The same by brute force: every line and every window of words against every template.
ORACLE_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_sql_words("coalesce(text, '')")} AS w FROM documents),
phrases(phrase, label) AS (VALUES {", ".join(f"({[*p.split()]!r}, '{label}')" for p, label in PHRASES.items())}),
places AS (
  SELECT doc_id, label, i - 1 AS place FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs) s
  JOIN phrases ON w[i:i + len(phrase) - 1] = phrase),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id),
templates(label, t) AS (VALUES {", ".join(f"('{label}', {sorted(set(t.split()))!r})" for label, t in TEMPLATES)}),
lines AS (
  SELECT doc_id, {_sql_words("unnest(string_split(text, chr(10)))")} AS w FROM docs
  UNION ALL
  SELECT doc_id, w[i:i + {WIDE * _STEP - 1}] FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1, {_STEP})) AS i FROM docs)),
hits AS (
  SELECT doc_id, label, len(list_intersect(list_distinct(w), t)) / len(t) AS part FROM lines, templates
  WHERE len(list_intersect(list_distinct(w), t)) >= ceil({THRESHOLD} * len(t) - 1e-9)),
more AS (SELECT doc_id, max(part) AS best, list(DISTINCT label) AS labels FROM hits GROUP BY doc_id)
SELECT docs.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.labels, []::VARCHAR[])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []::VARCHAR[]),
    coalesce(more.labels, []::VARCHAR[])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""
