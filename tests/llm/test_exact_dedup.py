"""Substring dedup by words and by bytes against brute force."""

import hashlib

import cases  # noqa: I001
import numpy as np
import pyarrow as pa
import pytest

from opscore.llm import sketch, substring_dedup, suffix_index


def expected(rows, split, join, size):
    out, seen = [], set()
    for same in cases.groups(rows):
        added = set()
        for doc_id, text in same:
            tokens, own, gone = split(text or ""), set(), None
            gone = [False] * len(tokens)
            for k in range(len(tokens) - size + 1):
                w = hash(join(tokens[k:k + size]))
                if w in seen or w in own:
                    gone[k:k + size] = [True] * size
                own.add(w)
            added |= own
            spans = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
            kept = join([t for t, g in zip(tokens, gone, strict=True) if not g])
            out.append((doc_id, len(tokens), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
        seen |= added
    return sorted(out, key=cases.key)


@pytest.fixture(scope="module")
def docs(spark):
    found = cases.documents(spark)
    return found, [(r.doc_id, r.text) for r in found.collect()]


def test_words(docs):
    got = substring_dedup.op9_substring_dedup(docs[0]).collect()
    want = expected(docs[1], lambda t: t.encode().split(), b" ".join, 20)
    assert sorted(map(tuple, got), key=cases.key) == sorted(((a, b, c, e) for a, b, c, _, e in want), key=cases.key)
    assert sum(r.n_removed for r in got) > 0


@pytest.mark.parametrize("batches,most", [(4, 500), (1, 500), (5, 2)])
def test_bytes(docs, batches, most):
    """Also with one batch, and with nearly every repeated anchor taken as crowded."""
    got = suffix_index.op3_suffix_dedup(docs[0], batches, most).collect()
    want = expected(docs[1], lambda t: [bytes([b]) for b in t.encode()], b"".join, 100)
    assert sorted(map(tuple, got), key=cases.key) == want


@pytest.fixture(scope="module")
def shared_ids(spark):
    """Many rows without an id or with the same one: texts of their own, a passage of all, equal rows."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(None if k % 3 else 7, f"{' '.join(f'w{k}x{i}' for i in range(60))} {passage if k % 2 else ''}") for k in range(600)]
    rows += [(None, rows[1][1])] * 200 + [(8, f"{rows[3][1]} {passage} {passage}"), (9, None), (None, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(7), rows


def test_words_of_many_rows_that_share_an_id(shared_ids):
    docs, rows = shared_ids
    got = substring_dedup.op9_substring_dedup(docs).collect()
    want = expected(rows, lambda t: t.encode().split(), b" ".join, 20)
    assert sorted(map(tuple, got), key=cases.key) == sorted(((a, b, c, e) for a, b, c, _, e in want), key=cases.key)


@pytest.mark.parametrize("most", [500, 2])
def test_bytes_of_many_rows_that_share_an_id(shared_ids, most):
    docs, rows = shared_ids
    got = suffix_index.op3_suffix_dedup(docs, 2, most).collect()
    want = expected(rows, lambda t: [bytes([b]) for b in t.encode()], b"".join, 100)
    assert sorted(map(tuple, got), key=cases.key) == want


def test_a_row_meets_its_own_windows_only(shared_ids):
    found, _ = substring_dedup._with_firsts(shared_ids[0])
    rows = found.selectExpr("size(split(trim(text), ' ')) - 19 AS windows", "size(__firsts) AS firsts").collect()
    assert len(rows) == len(shared_ids[1]) and max(r.firsts or 0 for r in rows) > 0
    assert all((r.firsts or 0) <= max(r.windows or 0, 0) for r in rows)


def test_comparing_the_strings_of_no_anchor():
    """A task may get no rows, or batches without any."""
    import pyarrow as pa
    assert list(suffix_index._compare(iter([]))) == []
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 5 + [pa.array([], pa.binary())], list("abcdef"))
    assert list(suffix_index._compare(iter([empty, empty]))) == []


def test_dedup_stage_keeps_columns_and_clean_documents(spark, docs):
    got = {}
    stage = substring_dedup.dedup(docs[0])
    assert stage.columns == docs[0].columns and stage.dtypes == docs[0].dtypes
    digest = {r.doc_id: r for r in substring_dedup.op9_substring_dedup(docs[0]).collect()}
    for r in stage.collect():
        got.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs[1]:
        d = digest[doc_id]
        if d.n_removed == 0:
            assert [r.text for r in got[doc_id]] == [text] * len(got[doc_id])
        elif d.n_removed == d.n_words:
            assert doc_id not in got
        else:
            kept = " ".join(got[doc_id][0].text.encode().split()[i].decode() for i in range(d.n_words - d.n_removed))
            assert hashlib.sha256(kept.encode()).hexdigest() == d.kept_sha256
            assert got[doc_id][0].n_chars == len(got[doc_id][0].text)


def test_empty_tables(spark):
    assert substring_dedup.op9_substring_dedup(cases.empty(spark)).count() == 0
    assert suffix_index.op3_suffix_dedup(cases.empty(spark)).count() == 0
    assert substring_dedup.dedup(cases.empty(spark)).count() == 0


def test_levels_merge_geometrically(spark):
    docs = spark.range(8).selectExpr("id AS doc_id", "concat('%d ', repeat(concat('word', id % 3, ' '), 60)) AS text")
    index, sizes = suffix_index.SuffixIndex(spark), []
    for k in range(7):
        index.add(docs.filter(f"doc_id = {k}"))
        sizes.append(sorted(index.levels))
    index.clear()
    assert sizes == [[1], [2], [1, 2], [4], [1, 4], [2, 4], [1, 2, 4]]


def test_sketch_never_underestimates():
    import numpy as np
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5_000).astype(np.uint64)
    counts = sketch.Counts(16)
    counts.add(keys[:3_000])
    counts.add(keys[2_000:])
    twice = [c > 1 for c in counts.rows]
    for r in range(sketch.DEPTH):
        assert twice[r][sketch.cells(keys[2_000:3_000], 16, r)].all()
    assert sum((twice[0][sketch.cells(keys, 16, 0)]) & (twice[1][sketch.cells(keys, 16, 1)])) < 1_400


def test_sketch_takes_two_bits_a_cell():
    rng = np.random.default_rng(8)
    counts, want = sketch.Counts(16), [np.zeros(1 << 16, np.int64) for _ in range(sketch.DEPTH)]
    for n in (0, 1, 5_000, 5_000):
        keys = rng.integers(0, 2**63, n).astype(np.uint64)
        counts.add(keys)
        for r, cells in enumerate(want):
            np.add.at(cells, sketch.cells(keys, 16, r), 1)
    assert all((np.minimum(a, 2) == b).all() for a, b in zip(want, counts.rows, strict=True))
    held = sum(x.nbytes for v in vars(counts).values() if isinstance(v, list) for x in v)
    assert held == sketch.DEPTH * (1 << 16) // 4


def test_working_arrays_of_a_slice_are_small():
    texts = pa.array(["some words of a text " * 500] * 200)
    assert max(len(data) for _, _, _, data, _ in suffix_index._runs(pa.RecordBatch.from_arrays([texts], ["text"]), 0)) <= 1 << 18


def test_a_task_gives_each_crowded_window_once(spark):
    """Windows that many slices of a task share are combined before they are shuffled."""
    class Some:  # takes every key
        value = type("", (), {"may": staticmethod(lambda keys: np.ones(len(keys), bool))})
    line = "".join(f"{k} of a common line, " for k in range(40))
    docs = spark.createDataFrame([(k, line) for k in range(400, 0, -1)], "doc_id long, text string").coalesce(1)
    assert 400 * len(line) > 4 * suffix_index.SLICE
    plan = suffix_index._windows(docs, Some, Some, Some)
    assert {r.doc_id for r in plan.collect()} == {1} and plan.count() == len({line[k:k + 100] for k in range(len(line) - 99)})
    h, c, i = (np.array(x) for x in ([5, 5, 5, 2], [1, 1, 0, 1], [9, 3, 4, 8]))
    assert [x.tolist() for x in suffix_index._firsts([(h, c, i), (h, c, i - 1)])] == [[2, 5, 5], [1, 0, 1], [7, 3, 2]]


def test_suffixes_are_dealt_by_bucket_before_they_are_counted(spark, monkeypatch):
    """No task holds the counts of all its own suffixes: the exchange comes before the aggregate."""
    plans = []
    monkeypatch.setattr(suffix_index.SuffixIndex, "_write", lambda self, df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or spark.createDataFrame([], "key long, copies long, doc_id long").createOrReplaceTempView("none") or "none")
    suffix_index.SuffixIndex(spark).add(spark.createDataFrame([(1, "a" * 300)], "doc_id long, text string"))
    assert plans[0].count("Exchange") == 1 and "partial_sum" in plans[0].split("Exchange")[0]


def test_arrow_batches_are_small_and_the_setting_comes_back(spark):
    """No batch that op3's tasks get has more than MOST_ROWS documents, whatever the session says."""
    before, name = spark.conf.get(suffix_index._ROWS), suffix_index._ROWS
    docs = spark.range(5_000).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1)

    def largest():
        def run(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])
        return docs.mapInArrow(run, "n long").agg({"n": "max"}).first()[0]

    try:
        for given in ("10000", "0", "70"):
            spark.conf.set(name, given)
            with suffix_index._small_batches(spark):
                assert largest() == min(int(given) or 10_000, suffix_index.MOST_ROWS)
            assert spark.conf.get(name) == given
        assert suffix_index.op3_suffix_dedup(docs).count() == 5_000 and spark.conf.get(name) == given
    finally:
        spark.conf.set(name, before)


def test_a_string_that_goes_whole_is_one_stretch(monkeypatch):
    """Only strings of which some windows stay are taken apart into windows."""
    class May:
        def __init__(self, says):
            self.value, self.says = self, says

        def may(self, keys):
            return np.full(len(keys), self.says)

    text = "".join(f"{k} of a repeated text, " for k in range(60))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, text[:700] + "x" * 300])], ["doc_id", "text"])
    ((_, _, r, _, off),) = suffix_index._runs(batch, 1)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    listed = []
    real = type(r).windows
    monkeypatch.setattr(type(r), "windows", lambda self, which: listed.append(int((self.last[which] - self.first[which] + 1).sum())) or real(self, which))
    gone = suffix_index._gone(r, none, May(True), May(False), May(False), off)
    assert gone.all() and sum(listed) == 0
    # one string is the text's own: its windows stay, the rest go
    h = np.sort(suffix_index._in_row(suffix_index.mix(r.spans(*suffix_index._span(r, np.array([3])))), r.row[[3]]))
    gone = suffix_index._gone(r, (h, np.zeros(1, np.int64)), May(True), May(False), May(False), off)
    want = np.zeros(len(gone), bool)
    for k in range(len(r.first)):
        if k != 3:
            want[r.first[k]:r.last[k] + suffix_index.SIZE] = True
    assert (gone == want).all()
    # some of its windows go
    name = suffix_index._in_row(suffix_index._in_text(suffix_index.mix(r.spans(*suffix_index._span(r, np.array([3])))),
                                                      suffix_index.mix(r.spans(off[:-1], off[1:]))[r.row[[3]]]), r.row[[3]])
    have = np.concatenate([h, name])
    order = np.argsort(have)
    partly = suffix_index._gone(r, (have[order], np.array([0, 1])[order]), May(True), May(False), May(False), off)
    want[r.first[3]:r.first[3] + suffix_index.SIZE] = True
    assert (partly == want).all() and sum(listed) == r.last[3] - r.first[3] + 1


def test_suffixes_of_a_batch_are_counted_once():
    text = "".join(f"{k % 7} of a repeated text, " for k in range(60))
    batch = pa.RecordBatch.from_arrays([pa.array([9, 2, 5]), pa.array([text, text + "!", None])], ["doc_id", "text"])
    found = pa.Table.from_batches(list(suffix_index._suffixes(iter([batch])))).to_pylist()
    ((_, _, r, _, _),) = suffix_index._runs(batch, 1)
    want = {}
    for g, row in zip(r.gram.view(np.int64).tolist(), r.row.tolist(), strict=True):
        n, first = want.get(g, (0, 99))
        want[g] = n + 1, min(first, [9, 2, 5][row])
    assert {x["key"]: (x["copies"], x["doc_id"]) for x in found} == want and len(found) == len(want)
