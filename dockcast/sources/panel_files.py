"""Panel and weather files with declared schemas (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.functions.columns import utc_normalise

PANEL_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType()), T.StructField("station_id", T.StringType()),
    T.StructField("bikes_available", T.FloatType()), T.StructField("capacity", T.FloatType())])
WEATHER_SCHEMA = T.StructType([
    T.StructField("ts", T.TimestampNTZType()), T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()), T.StructField("wind_speed_10m", T.DoubleType())])


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV columns found by name in the header, in any order; times with or without a zone become UTC.

    A time that is not empty and cannot be read fails the job; it never turns into a null.
    """
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)

    def column(f: T.StructField):
        c = F.trim(F.col(f"`{f.name}`"))
        if not isinstance(f.dataType, T.TimestampNTZType):
            return F.nullif(c, F.lit("")).cast(f.dataType).alias(f.name)
        t = utc_normalise(F.nullif(c, F.lit("")))
        bad = F.raise_error(F.concat(F.lit(f"unreadable time in {f.name}: "), c)).cast("timestamp_ntz")
        return F.when(t.isNull() & (c != ""), bad).otherwise(t).alias(f.name)
    return text.select(*[column(f) for f in schema.fields])


def read_panel(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Panel file(s): ``ts, station_id, bikes_available, capacity`` by name; other columns are not read."""
    if fmt == "csv":
        return _csv(spark, path, PANEL_SCHEMA)
    return spark.read.schema(PANEL_SCHEMA).format(fmt).load(path)


def read_weather(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Hourly weather file(s) by column name; times may carry a zone."""
    if fmt == "csv":
        return _csv(spark, path, WEATHER_SCHEMA)
    return spark.read.schema(WEATHER_SCHEMA).format(fmt).load(path)
