"""Corpus pipeline over ``documents``: classify, dedup, decontaminate, mix, shard.

Each stage takes what the one before kept, as a stored table, and returns the columns of
documents; the last adds ``shard`` and ``slot``.  Rows with nulls go through all stages
by the rules of the operators; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockcast.llm.common import materialise, table
from dockcast.llm.decontaminate import drop_contaminated
from dockcast.llm.mixing import mixed_rows
from dockcast.llm.neardup import keep_one
from dockcast.llm.quality import keep_good
from dockcast.llm.sharding import shard_rows


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark passages."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_rows(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot in the shuffled order."""
    return shard_rows(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", neardup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# A trained model, sketches and hash-based places cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
