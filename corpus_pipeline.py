"""Corpus pipeline (part of the llm subpackage): five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the last return the
columns of documents. run() writes what each stage returns to the shared folder, so a stage is computed once and a
lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import decontaminate, mixing, neardup, passages, toxicity
from vellum.llm.store import read_table, set_python_batches, written

#: Random draws, connected components and alignments have no SQL form here; tests hold each stage to brute force.
ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the toxicity classifier rejects."""
    set_python_batches(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class: that of least doc_id."""
    set_python_batches(spark)
    return neardup.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document has; the first occurrence stays."""
    set_python_batches(spark)
    return passages.cut_passages(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    set_python_batches(spark)
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how many copies of each."""
    return mixing.mix(docs, keep=("text", "lang", "n_chars")).where(F.col("copies") > 0)


STAGES = [
    ("toxicity", toxic),
    ("minhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
