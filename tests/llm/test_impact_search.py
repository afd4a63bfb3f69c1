"""Ranked lexical search against scores of every document."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import SF, documents, empty, long_text, odd_rows

from opscore.llm import impact_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def brute(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n_docs, total = len(own), sum(n for *_, n in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        want = Counter(terms(text))
        found = []
        for i, c, n in own:
            m = 25 + 75 * n * n_docs // total
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                        for t, k in want.items() if c[t])
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:10])]
    return out


def key(rows: list) -> list:
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("shard", [R.SHARD, 700])
def test_equal_to_brute_force(spark, shard):
    docs = documents(spark)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(7001, None), (7002, ""), (7003, "zzzz-not-there"), (7004, "p1 P2 p2 p3"), (7004, "same WORDS again again"),
              (None, "the one"), (7005, long_text(2_000)), (7006, "É 中文"), (7007, "line")]
    asked = spark.createDataFrame([(*r, "x", "y") for r in items], "item_id long, text string, doc_id string, score string")
    got = R.search(docs, asked, shard)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], items)
    assert key(got.collect()) == key(want)


def test_many_equal_documents(spark):
    rows = [(i, "one very common passage of words") for i in range(3_000, 0, -1)] + [(5_000 + i, f"rare{i} words") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    items = [(1, "common passage"), (2, "rare7 words words"), (3, "rare8 rare9 common")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert key(R.search(docs, asked).collect()) == key(brute(rows, items))


def test_rounds_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([r[:2] for r in odd_rows()], "doc_id long, text string")
    items = [(i, f"p{i} same words p{i + 1}") for i in range(7)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(R, "ITEMS", 3)
    assert key(R.search(docs, asked).collect()) == key(brute([r[:2] for r in odd_rows()], items))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert R.search(empty(spark), some).collect() == []
    assert R.search(documents(spark), none).collect() == []


def test_range_maxima_and_pruning():
    rnd = np.random.default_rng(1)
    docs, vocabulary = 2_000, 30
    lists = [np.sort(rnd.choice(vocabulary, rnd.integers(1, 12), replace=False)) for _ in range(docs)]
    tfs = [rnd.integers(1, 5, len(x)) for x in lists]
    heads = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    shard = R.Shard(rnd.permutation(docs), rnd.integers(25, 200, docs), heads, np.concatenate(lists), np.concatenate(tfs),
                    rnd.integers(1, 9_000, vocabulary))
    for a, b in rnd.integers(0, len(shard.keys), (200, 2)):
        a, b = min(a, b), max(a, b)
        same = shard.keys // docs == shard.keys[a] // docs
        b = min(b, int(np.flatnonzero(same)[-1]) + 1)
        value, place = shard.greatest(np.array([[a]]), np.array([[b]]))
        assert value[0, 0] == shard.impact[a:b].max(initial=0)
    scored = []
    shard_bounds = shard._bounds
    shard._bounds = lambda lo, *rest: scored.append(len(lo)) or shard_bounds(lo, *rest)
    shard.search(np.array([3]), np.array([1]), [])
    assert sum(scored) < docs / 4  # one term: the split documents come in order of impact
