"""The corpus pipeline: quality rules, line dedup, Jaccard join, decontamination, packing.

Every stage gets what its predecessor kept, as a table read back from Parquet;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsgate.llm import common as C
from obsgate.llm.decontaminate import drop_contaminated
from obsgate.llm.jaccard_join import one_per_group
from obsgate.llm.line_dedup import drop_boilerplate
from obsgate.llm.packing import pack
from obsgate.llm.quality_rules import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source leave the texts; ``n_chars`` is counted again."""
    return drop_boilerplate(docs, length_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, the one with the smallest id."""
    return one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("jaccard_join", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# Repeats, near duplicates and token ids are beyond SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = C.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
