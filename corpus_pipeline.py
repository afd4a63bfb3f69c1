"""Corpus preparation: five stages from raw documents to packed training sequences.

Each stage works on all documents that the one before kept; every intermediate result is
a Parquet table in the session's shared folder.  All stages but the last return the
columns of ``documents``; the last returns the pieces and their bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opscore.llm import best_fit, decontaminate, jaccard_join, quality_rules, scratch, ship, substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship.package(spark)
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship.package(spark)
    return jaccard_join.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    ship.package(spark)
    return substring_dedup.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    ship.package(spark)
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the training sequence each is in."""
    ship.package(spark)
    return best_fit.pack(docs)


STAGES = [("quality_rules", quality), ("jaccard_join", near_duplicates), ("substring_dedup", repeated_passages),
          ("decontaminate", decontamination), ("best_fit", packing)]

#: Learned cutoffs, latent retrieval and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
