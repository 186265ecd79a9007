"""Parquet tables of a data directory (one file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one table; naming the columns lets the scan prune the rest."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
