"""From raw documents to packed training sequences, in five stages.

Every stage works on all rows that the one before kept. Stages are written as Parquet to
the shared scratch folder and read again, so a later stage never repeats an earlier one.
Empty and null texts fail the quality rules; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import minhash, packing, quality, repeats, toxicity
from tidemark.llm.common import ship, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed bounds and the estimate of their language and source accept."""
    ship(spark)
    return quality.keep_good(docs)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the rows that are left."""
    ship(spark)
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similarity 0.8 connect."""
    ship(spark)
    return minhash.keep_one(docs, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of 200 bytes and more that stand in several places."""
    ship(spark)
    return repeats.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", civil),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packed),
]

#: No stage but the counting ones can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
