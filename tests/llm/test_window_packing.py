"""Packing by non-negative least squares: exact round trip of every id, no padding, and the plan itself."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import documents, empty

from opscore.llm import window_packing as W


def reference_ids(text: str | None) -> list[int]:
    from tokenizers import Tokenizer
    if not hasattr(reference_ids, "own"):
        reference_ids.own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        reference_ids.own.encode_special_tokens = True
    return [*reference_ids.own.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def layout_is_whole(rows: list, window: int) -> None:
    """Every sequence is gapless from 0 and full, or a power of two long."""
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)


def test_every_id_is_in_one_piece(spark):
    docs = documents(spark)
    rows = W.op11_window_packing(docs).collect()
    texts = docs.select("doc_id", "text").collect()
    want: dict = {}
    for doc, text in texts:
        ids = reference_ids(text)
        want.setdefault(doc, []).append(ids)
    got: dict = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(want)
    for doc, options in want.items():
        # rows that share a doc_id are told apart by their order of starts
        assert sum(r["length"] for r in got[doc]) == sum(map(len, options))
        assert {r["doc_tokens"] for r in got[doc]} == {len(ids) for ids in options}
        for r in got[doc]:
            assert r["ids_crc32"] in {crc(ids[r["start"]:r["start"] + r["length"]]) for ids in options}
        if len(options) == 1:
            at = 0
            for r in sorted(got[doc], key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]
    layout_is_whole(rows, W.WINDOW)


def test_small_window_has_many_cuts(spark):
    rows = [(i, " ".join(["word"] * (i % 37 + 1))) for i in range(400)] + [(900 + i, "a b c") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = W.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=16).collect()
    layout_is_whole(out, 16)
    total = sum(len(reference_ids(t)) for _, t in rows)
    assert sum(r["length"] for r in out) == total
    ids = {i: reference_ids(t) for i, t in rows}
    assert all(r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]) for r in out)
    assert len(out) < 1.2 * len(rows) + total / 16


def test_empty_table(spark):
    assert W.op11_window_packing(empty(spark)).collect() == []


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "a \n b", "\n\n  x", "é   b  \x1c c\x85d", "<|endoftext|> a <|endoftext|>", "x" * 3000,
                                  "it's 'S we'll \t\tq", "中文 字 …  a", " " * 700 + "b", "a\r\n\r\n b", "٣٤ Ⅷ ñ ß"])
def test_ids_are_those_of_the_tokenizer_file(text):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        ids = W.Ids(f.read())
    assert [*ids(text).tolist(), 1] == reference_ids(text)


def test_other_tokenizer_files_have_no_fast_path():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert W.Ids(f.read()).ranked is None


def pieces(counts: np.ndarray) -> tuple:
    slots, sequences = W.plan(counts)
    rest = np.repeat(np.arange(len(counts)), counts)
    rank = np.concatenate([np.arange(n) for n in counts])
    return rest, W.Lookup(slots, counts * 0, sequences)(rest, rank)


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_every_rest_once(seed):
    rnd = np.random.default_rng(seed)
    counts = [rnd.integers(0, 30, 256), np.bincount(rnd.integers(1, 256, 9), minlength=256),
              np.where(np.arange(256) == 190, 5000, 0), np.where(np.arange(256) % 3 == 0, 1000, 0)][seed]
    counts[0] = 0
    rest, (row, start, length, sequence, offset) = pieces(counts)
    assert (np.bincount(row, weights=length, minlength=len(rest)) == rest).all()
    order = np.lexsort((start, row))
    ends = (start + length)[order]
    same = row[order][1:] == row[order][:-1]
    assert (start[order][1:][same] == ends[:-1][same]).all()
    layout_is_whole([{"sequence_id": s, "offset": o, "length": n} for s, o, n in zip(sequence, offset, length)], 256)


def test_least_squares_finds_a_perfect_fit():
    counts = np.zeros(64, np.int64)
    for lengths, times in (([40, 24], 700), ([30, 20, 14], 300), ([33, 31], 5)):
        for length in lengths:
            counts[length] += times
    ways = W.combinations(counts)
    assert all(sum(w) == 64 for w in ways.tolist())
    x = W.repeat_counts(ways, counts, 1000)
    used = sum(np.bincount(w, weights=x, minlength=64) for w in ways.T)
    assert np.abs(used[1:] - counts[1:]).max() < 1
    slots, sequences = W.plan(counts)
    assert sequences == 1005 and sum(s.n for s in slots) == counts.sum()  # no rest is cut


def test_plan_does_not_grow_with_the_rows():
    lengths = np.random.default_rng(5).lognormal(5, 1, 20_000).astype(int) % 512
    counts = np.bincount(lengths, minlength=512)
    small, large = (len(W.plan(counts * times)[0]) for times in (100, 1_000_000))
    assert large < 2 * small
