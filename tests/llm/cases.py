"""Rows that every operator of the corpus package must take: the smallest table and odd cases."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
#: Extra columns have names that the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, "
          "component_id string, h string, c string, n string, bin_id string, band string, score string, words string")


def long_text(words: int = 30_000, seed: int = 3) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice("abcdefghij") * rnd.randint(1, 4) + rnd.choice("xyz") for _ in range(words))


def odd_rows() -> list[tuple]:
    long_ = long_text()
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [
        (1_000_001, None), (1_000_002, ""), (1_000_003, " \t\n \x0b"), (1_000_004, "one"), (1_000_005, "ONE"),
        (1_000_006, "É é 中文 字 – …"), (1_000_007, "#!$ %% 123 ||"), (1_000_008, long_),
        (1_000_009, long_[:5_000] + " tail " + long_[100:4_000]),
        (1_000_010, f"before {passage} between {passage} after"), (1_000_011, f"other {passage}\nother {passage}"),
        (1_000_012, "a b " * 200), (1_000_013, "same words again " * 30), (1_000_014, "same words again " * 30),
        (1_000_015, "twice the same row " + passage), (1_000_015, "twice the same row " + passage),
        (None, "no id here, " + passage), (None, "no id here, " + passage), (1_000_016, "x" * 150_000),
        (1_000_017, "line\nline\n\nline\n" * 40),
    ]
    return [(i, t, None if (i or 0) % 3 == 0 else "en", None if (i or 0) % 4 == 0 else "src0", None) for i, t in texts]


def documents(spark: SparkSession) -> DataFrame:
    """The smallest table's documents and the odd rows, with clashing extra columns."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()] + odd_rows()
    extra = ("extra",) * 10
    return spark.createDataFrame([r + extra for r in rows], SCHEMA).repartition(5)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def groups(rows: list[tuple]) -> list[list]:
    """Rows by doc_id in order, a null doc_id first."""
    by: dict = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    return [by[k] for k in sorted(by, key=lambda k: (k is not None, k or 0))]


def key(r) -> tuple:
    return tuple((x is not None, str(x)) for x in r)
