"""Quality rules, the additive model and the language field."""

import math
import re
from collections import Counter

import cases  # noqa: I001
import numpy as np
import pytest
from pyspark.sql import functions as F

from opscore.llm import language_crf, quality_gam, quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    count, marked = Counter(grams), set()
    for k, g in enumerate(grams):
        if count[g] > 1:
            marked |= {k, k + 1, k + 2}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked),
            n < 50 or 100 * len(marked) > 50 * n)


@pytest.fixture(scope="module")
def docs(spark):
    return cases.documents(spark)


@pytest.fixture(scope="module")
def labels(spark):
    known = spark.read.parquet(f"{cases.SF}/labels.parquet")
    odd = spark.createDataFrame([(None, 1, 0), (3, None, 0), (1_000_012, 0, 0), (1_000_012, 1, None)],
                                "doc_id long, quality int, toxic int")
    return known.unionByName(odd)


def test_base_numbers(docs, labels):
    got = quality_rules.op1_quality_rules(docs, labels).collect()
    want = Counter((r.doc_id, *base(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_rules_without_labels_and_on_an_empty_table(spark, docs, labels):
    none = labels.limit(0)
    assert all(r.kept == (not r.base_failed) for r in quality_rules.op1_quality_rules(docs, none).collect())
    assert quality_rules.op1_quality_rules(cases.empty(spark), labels).count() == 0
    assert quality_rules.keep_good(docs, none).dtypes == docs.dtypes


@pytest.mark.parametrize("k,n,error", [(0, 100, 0.01), (3, 250, 0.05), (40, 60, 0.02), (0, 1, 0.5)])
def test_exact_bound(k, n, error):
    p = quality_rules.upper_bound(k, n, error)
    tail = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    assert abs(tail - error) < 1e-6
    assert quality_rules.upper_bound(n, n, error) == 1.0


def test_guarantee_holds_on_repeated_holdouts():
    """True false rejection rates of the chosen cutoffs stay within the risk in nearly all trials."""
    rng = np.random.default_rng(4)
    broken = 0
    for _ in range(200):
        good, bad = rng.exponential(0.5, 400), rng.exponential(3, 100)
        tally = {0: (400, [int((good > c).sum()) for c in quality_rules.CUTS], [int((bad > c).sum()) for c in quality_rules.CUTS])}
        cut = quality_rules.choose(tally, 0.05, 0.05, 0.2).get(0)
        broken += cut is not None and math.exp(-cut / 0.5) > 0.05
    assert broken <= 10


def test_gam_scores_held_out_documents(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marked = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_gam.op4_quality_gam(docs, marked).join(marked, "doc_id").filter("held_out").collect()
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_gam_odd_cases(spark, docs, labels):
    got = quality_gam.op4_quality_gam(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    import zlib
    for r in got:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert {r.score for r in quality_gam.op4_quality_gam(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_gam.op4_quality_gam(cases.empty(spark), labels).count() == 0


def test_gam_finds_an_interaction():
    rng = np.random.default_rng(6)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y, rounds=20, n_pairs=1)
    assert model.pairs == [(1, 0)]
    assert np.mean((model.score(x) > 0.5) == (y > 0.5)) > 0.95


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_crf.op10_language_crf(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97


def test_language_odd_cases(spark, docs):
    got = {r.doc_id: r for r in language_crf.op10_language_crf(docs).collect()}
    for i in (1_000_001, 1_000_002, 1_000_003, 1_000_007):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[1_000_004].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_crf.op10_language_crf(bare).collect()} == {"und"}
    assert language_crf.op10_language_crf(cases.empty(spark)).count() == 0


def test_code_switched_words():
    pieces = [" ".join(f"the{c} of{c}ing" for c in "abcdefgh")] * 30 + [" ".join(f"der{c} und{c}ung" for c in "abcdefgh")] * 30
    model = language_crf.fit(pieces, ["en"] * 30 + ["de"] * 30)
    import pyarrow as pa
    text = pieces[0] + " " + pieces[-1]
    (_, found, _, _), = language_crf.labelled(pa.array([text]), model)
    assert [model.langs[k] for k in found.argmax(1)] == ["en"] * 16 + ["de"] * 16


def test_forward_backward_equals_the_plain_recursion():
    rng = np.random.default_rng(8)
    n, k = 700, 3
    e, start, moves = rng.normal(size=(n, k)), rng.normal(size=k), rng.normal(size=(k, k))
    first = rng.random(n) < 0.01
    first[0] = True
    got = language_crf.forward_backward(e, first, start, moves)
    cuts = [*np.flatnonzero(first), n]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        f, back = [np.exp(start + e[a])], [np.ones(k)]
        for i in range(a + 1, b):
            f.append((f[-1] @ np.exp(moves)) * np.exp(e[i]))
            f[-1] /= f[-1].sum()
        for i in range(b - 1, a, -1):
            back.append(np.exp(moves) @ (np.exp(e[i]) * back[-1]))
            back[-1] /= back[-1].sum()
        want = np.array(f) * np.array(back[::-1])
        assert np.allclose(got[a:b], want / want.sum(1, keepdims=True), atol=1e-9)


def test_transition_gradient_by_finite_differences():
    """Observed minus expected pairs is the slope of the likelihood of the labels, by enumeration of all labellings."""
    import itertools
    rng = np.random.default_rng(3)
    n, k = 6, 3
    e, start, moves = rng.normal(size=(n, k)), rng.normal(size=k), rng.normal(size=(k, k))
    first = np.array([True, False, False, True, False, False])
    truth = rng.integers(0, k, n)

    def total(y, moves):
        return sum(e[i, y[i]] + (start[y[i]] if first[i] else moves[y[i - 1], y[i]]) for i in range(n))

    def likelihood(moves):
        return total(truth, moves) - np.log(sum(np.exp(total(y, moves)) for y in itertools.product(range(k), repeat=n)))

    found, pairs = language_crf.expected_pairs(e, first, start, moves)
    slope = -pairs
    inner = np.flatnonzero(~first)
    np.add.at(slope, (truth[inner - 1], truth[inner]), 1)
    for a in range(k):
        for b in range(k):
            step = np.zeros((k, k))
            step[a, b] = 1e-5
            assert abs((likelihood(moves + step) - likelihood(moves - step)) / 2e-5 - slope[a, b]) < 1e-6
    assert abs(pairs.sum() - len(inner)) < 1e-9


def test_a_rare_language_is_learned_whole():
    got = language_crf.shares({"en": 1_000_000, "de": 1_000_000, "xx": 20}, 4_000)
    assert got["xx"] == 1 and abs(got["en"] * 1_000_000 - 1_990) < 1
    assert language_crf.shares({"en": 3}, 10) == {"en": 1.0} and language_crf.shares({}, 10) == {}


def test_the_stage_shuffles_no_text(spark):
    """Where no rows share a doc_id a row is judged by itself; the rows are those that a join by doc_id gives."""
    texts = ["word " * 80, "# * $ %% " * 60, " ".join(f"w{i}" for i in range(120)), None, "short", "LINE OF TEXT 12 " * 30]
    rows = [(None if k == 7 else k, f"{texts[k % 6]} {' '.join(f'x{k}y{i}' for i in range(k))}" if texts[k % 6] else None,
             "band", "kept") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, band string, n_words string").repartition(6)
    labels = spark.createDataFrame([(k, 0 if k % 6 in (1, 5) else 1) for k in range(300)], "doc_id long, quality int")
    kept = quality_rules.keep_good(docs, labels)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and kept.schema == docs.schema
    good = {r.doc_id for r in quality_rules.verdicts(docs, labels).filter("kept").collect()}
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id in good)
    assert 0 < len(good) < 300
    # rows that share a doc_id stay if one does
    twice = docs.unionAll(spark.createDataFrame([(2, "short", None, None), (4, texts[2], None, None)], docs.schema))
    good = {r.doc_id for r in quality_rules.verdicts(twice, labels).filter("kept").collect()}
    got = quality_rules.keep_good(twice, labels).collect()
    assert sorted(map(str, got)) == sorted(str(r) for r in twice.collect() if r.doc_id in good)
    assert sum(r.doc_id == 2 for r in got) == 2 and sum(r.doc_id == 4 for r in got) == 2
