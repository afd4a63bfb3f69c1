"""Near-duplicate join against all pairs that share a shingle."""

from collections import defaultdict

import cases  # noqa: I001
import pytest

from opscore.llm import components, jaccard_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").translate(LOWER).encode().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    smallest = lambda a, b: min((a, b), key=lambda k: (k is not None, k or 0))
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for at, (i, own) in enumerate(sets):
        shared = defaultdict(int)
        for s in own:
            for other in index[s]:
                shared[other] += 1
            index[s].append(at)
        for other, n in shared.items():
            j, its = sets[other]
            if 100 * n >= 75 * (len(own) + len(its) - n) and find(i) != find(j):
                a, b = find(i), find(j)
                low = smallest(a, b)
                root[b if low == a else a] = low
    return sorted(((i, len(s), find(i)) for i, s in sets), key=cases.key)


@pytest.fixture(scope="module")
def family(spark):
    """A crowd of copies with more and more words changed: links, near links and chains."""
    import random
    rnd = random.Random(5)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(150)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(i % 17):
            words[rnd.randrange(len(words))] = f"v{rnd.randint(0, 9999)}"
        rows.append((5_000 - i, " ".join(words), None, "src0", None) + ("extra",) * 10)
    return spark.createDataFrame(rows, cases.SCHEMA).unionByName(cases.documents(spark))


@pytest.mark.parametrize("long_list", [64, 3])
def test_components(family, long_list, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONG_LIST", long_list)
    monkeypatch.setattr(jaccard_join.links, "__defaults__", (long_list,))
    got = sorted(map(tuple, jaccard_join.op7_jaccard_join(family).collect()), key=cases.key)
    want = expected([(r.doc_id, r.text) for r in family.collect()])
    assert got == want
    assert len({c for _, _, c in want}) < len(want) - 50


def test_keep_first_keeps_one_of_each_group(family):
    kept = jaccard_join.keep_first(family)
    assert kept.dtypes == family.dtypes
    want = expected([(r.doc_id, r.text) for r in family.collect()])
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(i) for i, _, c in want if i == c)


def test_empty(spark):
    assert jaccard_join.op7_jaccard_join(cases.empty(spark)).count() == 0
    assert jaccard_join.keep_first(cases.empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    rows = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (130, 101)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in (*range(101, 130), 130)}}


def test_signatures_never_exclude_a_link():
    import numpy as np
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, 60)) for _ in range(40)]
    cells = [np.bincount(s % 64, minlength=64) & 1 for s in sets]
    for s, a in zip(sets, cells, strict=True):
        for t, b in zip(sets, cells, strict=True):
            assert (a != b).sum() <= len(np.setxor1d(s, t))


def test_sets_of_a_slice():
    """Slices are small; the sets are sorted and distinct, the signatures those of each row alone."""
    import numpy as np
    import pyarrow as pa
    texts = ["some words of a text again " * 300, None, "", "one", "A b c d e", "a b c d e f a b c d e f"] * 60
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    sets = []
    for lo, own in jaccard_join.row_sets(batch.column(1)):
        assert lo == len(sets) and sum(len(t or "") for t in texts[lo:lo + len(own)]) <= 1 << 17
        sets += own
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert all((np.diff(s.astype(object)) > 0).all() for s in sets)
    rows = pa.Table.from_batches(list(jaccard_join._fingerprints(iter([batch])))).to_pylist()
    for r, s in zip(rows, sets, strict=True):
        bits = np.packbits(np.bincount((jaccard_join.mix(s) & np.uint64(1023)).astype(int), minlength=1024).astype(np.uint8) & 1)
        assert (r["n"], r["f1"] % 2**64) == (len(s), int(s.sum(dtype=np.uint64)))
        assert r["f2"] % 2**64 == int(np.bitwise_xor.reduce(jaccard_join.mix(s + np.uint64(1)))) if len(s) else r["f2"] == 0
        assert [r[m] for m in jaccard_join.MARKS] == bits.view(np.int64).tolist()


def test_the_stage_leaves_one_table_on_disk(family):
    """Tables written on the way are deleted as soon as nothing reads them: the next stages need the disk."""
    from opscore.llm import scratch
    before = list(scratch._MADE)
    kept = jaccard_join.keep_first(family)
    left = [p for p in scratch._MADE if p not in before]
    assert len(left) == 1 and "small-star" in left[0]
    assert 0 < kept.count() < family.count()
