"""Hard-negative mining against scores of all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from cases import SF

from opscore.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score string, pair string, vector string"


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(4)


def brute(rows: list[tuple]) -> list[tuple]:
    good = []
    for vec, v, label in rows:
        if v is None or label is None or any(x is None or not math.isfinite(256 * x) for x in v):
            continue
        if vec is not None and vec % 7 == 0:
            label = math.fmod(label + 1, 10)
        good.append((vec, [math.floor(256 * x) for x in v], label))
    first = lambda x: (-x[0], x[1] is not None, x[1] or 0)
    out = []
    for i, (vec, v, label) in enumerate(good):
        if vec is None or vec % 50:
            continue
        scored = [(max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), other, lab)
                  for j, (other, w, lab) in enumerate(good) if j != i]
        for ps, positive, _ in sorted((x for x in scored if x[2] == label), key=first)[:5]:
            near = [x for x in scored if x[2] != label and 50 * ps <= 100 * x[0] <= 95 * ps]
            out += [(vec, positive, k + 1, neg, ps, ns) for k, (ns, neg, _) in enumerate(sorted(near, key=first)[:3])]
    return out


def key(rows: list) -> list:
    return sorted((tuple(r) for r in rows), key=str)


def vectors(n: int, size: int, seed: int) -> list[tuple]:
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((4, size))
    return [(i, ((centres[i % 4] + rnd.standard_normal(size)) / size ** 0.5).tolist(), int(rnd.integers(0, 5))) for i in range(n)]


def test_smallest_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = H.op12_hard_negatives(df)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert key(got.collect()) == key(brute(rows))


@pytest.mark.parametrize("size", [1, 3, 64, 70, 130])
def test_other_lengths(spark, size):
    rows = vectors(400, size, size)
    assert key(H.mine(frame(spark, rows)).collect()) == key(brute(rows))


def test_odd_rows(spark):
    rows = vectors(300, 8, 9)
    v = rows[0][1]
    nan, inf = float("nan"), float("inf")
    rows += [(None, v, 2), (None, v, 3), (50, v, 1), (50, v, 1), (50, v, 1), (350, v, None), (400, None, 1), (450, [], 1),
             (500, [None, *v[1:]], 1), (550, [nan, *v[1:]], 1), (600, [inf, *v[1:]], 1), (650, v[:3], 1), (700, [0.0] * 8, 1),
             (701, [1e300] * 8, 1), (750, [1e300, -1e300] * 4, 2), (751, [1e9] * 8, 2), (752, [-1e9] * 8, 1), (800, [1e307] * 8, 2),
             (-50, v, -3), (-49, v, -3), (850, [-1e9] * 8, 4)]
    assert key(H.mine(frame(spark, rows)).collect()) == key(brute(rows))


def test_many_equal_rows(spark):
    rows = [(i, [0.5, -0.25, 0.125, 1.0], i % 2) for i in range(600)] + [(1000 + i, [0.45, -0.25, 0.1, 0.9], 1) for i in range(99)]
    assert key(H.mine(frame(spark, rows)).collect()) == key(brute(rows))


def test_rounds_give_the_same(spark, monkeypatch):
    rows = vectors(900, 16, 4)
    monkeypatch.setattr(H, "ANCHORS", 4)
    assert key(H.mine(frame(spark, rows)).collect()) == key(brute(rows))


def test_nothing_to_mine(spark):
    assert H.mine(frame(spark, [])).collect() == []
    assert H.mine(frame(spark, [(1, [1.0], 1)])).collect() == []
    assert H.mine(frame(spark, [(50, [1.0], 1), (51, [1.0], 2)])).collect() == []


@pytest.mark.parametrize("size", [2, 64, 100])
def test_intervals_are_certain_and_drop_most_pairs(size):
    rnd = np.random.default_rng(size)
    data = np.floor(256 * rnd.standard_normal((900, size)) / size ** 0.5)
    turn = H.rotation(size)
    assert np.allclose(turn @ turn.T, np.eye(size))
    rows = H.Rows(data, np.zeros(900, int), np.arange(900), np.arange(900), turn)
    planes = H.Planes.of(data[:90] @ turn)
    true = data[:90] @ data.T
    norm = np.sqrt((data * data).sum(1))
    least, most = 0.45 * norm[:90] * norm.mean(), 0.6 * norm[:90] * norm.mean()
    inside = (true >= least[:, None]) & (true <= most[:, None])
    for sparse in (0.0, 0.2, 1.0):
        H.SPARSE, before = sparse, H.SPARSE
        anchor, row = rows.candidates(planes, slice(0, 90), least, most, np.ones((90, 900), bool))
        H.SPARSE = before
        kept = np.zeros((90, 900), bool)
        kept[anchor, row] = True
        assert (kept | ~inside).all()
        assert size < 64 or kept.mean() < 0.1
