"""Columnar weather JSON (``hourly: {time: [...], var: [...]}``) -> hourly rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast import config
from dockcast.functions.columns import utc_normalise

HOURLY_SCHEMA = T.StructType([T.StructField("hourly", T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in config.WEATHER_COLS]))])


def rows_from_documents(docs: DataFrame) -> DataFrame:
    """Zip the parallel arrays into rows; a variable missing from a document is null."""
    h = F.col("hourly")
    n = F.size(h["time"])
    absent = F.array_repeat(F.lit(None).cast("double"), n)          # variable missing from the document
    zipped = F.arrays_zip(h["time"].alias("time"), *[F.coalesce(h[c], absent).alias(c) for c in config.WEATHER_COLS])
    rows = docs.select(F.inline(zipped))
    return rows.select(utc_normalise(F.col("time")).alias("ts"), *config.WEATHER_COLS)


def read_hourly_json(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.schema(HOURLY_SCHEMA).option("multiLine", True).json(path)
    return rows_from_documents(docs)
