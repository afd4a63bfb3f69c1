"""Queries of the corpus operators: ``opN_<name>`` over the whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import best_fit, decontaminate, hard_negatives, html_extract, impact_search, jaccard_join, language_crf, license_scan, quality_gam, quality_rules, ship, substring_dedup, suffix_index, window_packing


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op1_quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.op3_suffix_dedup(_table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.op6_license_scan(_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.op7_jaccard_join(_table(spark, sf_dir, "documents"))


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.op4_quality_gam(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.op10_language_crf(_table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.op5_html_extract(_table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op2_decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.op8_best_fit(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.op9_substring_dedup(_table(spark, sf_dir, "documents"))


def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.op11_window_packing(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.op12_hard_negatives(_table(spark, sf_dir, "embeddings"))


def op13_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.op13_impact_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_QUERIES = [op1_quality_rules, op2_decontaminate, op3_suffix_dedup, op4_quality_gam, op5_html_extract, op6_license_scan,
            op7_jaccard_join, op8_best_fit, op9_substring_dedup, op10_language_crf,
            op11_window_packing, op12_hard_negatives, op13_impact_search]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        @functools.wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship.package(spark)
            return query(spark, sf_dir)
        return run
    return {q.__name__: shipped(q) for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_suffix_dedup": suffix_index.ORACLE_SQL, "op6_license_scan": license_scan.ORACLE_SQL,
            "op7_jaccard_join": jaccard_join.ORACLE_SQL, "op9_substring_dedup": substring_dedup.ORACLE_SQL,
            "op12_hard_negatives": hard_negatives.ORACLE_SQL, "op13_impact_search": impact_search.ORACLE_SQL}
