"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, fingerprints, language, mixing, neardup, passages, quality, suffixes, toxicity, warc
from .store import read_table, set_python_batches


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read_table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_python_batches(spark)
    return toxicity.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_python_batches(spark)
    return passages.report(read_table(spark, sf_dir, "documents"))


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(read_table(spark, sf_dir, "pages"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_python_batches(spark)
    return language.report(read_table(spark, sf_dir, "documents"))


def op7_exact_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_python_batches(spark)
    return suffixes.report(read_table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_python_batches(spark)
    return neardup.report(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_python_batches(spark)
    return quality.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_python_batches(spark)
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_mix_sources, op2_fingerprints, op3_toxicity, op4_fuzzy_passages, op5_warc_revisits, op6_language, op7_exact_substrings, op8_near_duplicates, op9_quality, op10_decontaminate)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mixing.ORACLE, "op5_warc_revisits": warc.ORACLE}
