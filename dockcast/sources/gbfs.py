"""GBFS station documents -> one snapshot table.

A poll fetches ``station_information`` and ``station_status`` documents of
the form ``{"data": {"stations": [...]}}``.  Landed as JSON files they are
read with a declared superset schema (both spellings of the renamed fields),
exploded, harmonised, joined on ``station_id`` and stamped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast import config
from dockcast.functions.columns import from_micros

INFO_STATION = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.DoubleType()), T.StructField("stationCode", T.StringType())])
STATUS_STATION = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("is_installed", T.IntegerType()),
    T.StructField("is_renting", T.IntegerType()), T.StructField("is_returning", T.IntegerType()),
    T.StructField("last_reported", T.LongType()),
    T.StructField("num_bikes_available", T.IntegerType()), T.StructField("numBikesAvailable", T.IntegerType()),
    T.StructField("num_docks_available", T.IntegerType()), T.StructField("numDocksAvailable", T.IntegerType()),
    T.StructField("stationCode", T.StringType())])


def document_schema(station: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("last_updated", T.LongType()),
        T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(station))]))])


def read_stations(spark: SparkSession, path: str, station: T.StructType) -> DataFrame:
    """Rows of ``data.stations`` of every document under ``path`` (+ its file name)."""
    docs = spark.read.schema(document_schema(station)).option("multiLine", True).json(path)
    return docs.select(F.input_file_name().alias("_doc"), "last_updated", F.inline("data.stations"))


def harmonise(status: DataFrame, aliases=config.GBFS_ALIASES) -> DataFrame:
    """snake_case wins; camelCase fills in where the snake_case value is missing.

    Over a superset schema an absent field is a null column, so ``coalesce``
    is the per-row form of "use the alias when the field is absent"; it also
    rescues rows whose snake_case value alone is null (documented superset).
    """
    d = status
    for snake, camel in aliases:
        parts = [F.col(c) for c in (snake, camel) if c in d.columns]
        if parts:
            d = d.withColumn(snake, F.coalesce(*parts))
    return d


def merge(status: DataFrame, info: DataFrame, on=("station_id",)) -> DataFrame:
    """Inner join status ⋈ info; overlapping non-key columns get _status / _info suffixes."""
    keys = list(on)
    both = (set(status.columns) & set(info.columns)) - set(keys)
    s = status.select(*[F.col(c).alias(f"{c}_status" if c in both else c) for c in status.columns])
    i = info.select(*[F.col(c).alias(f"{c}_info" if c in both else c) for c in info.columns])
    return s.join(i, keys, "inner")


def keep_existing(df: DataFrame, keep=config.GBFS_KEEP) -> DataFrame:
    return df.select(*[c for c in keep if c in df.columns])


def stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Capture time of the snapshot (UTC wall clock)."""
    now = at if at is not None else from_micros(F.unix_micros(F.current_timestamp()))   # UTC, zone-free
    return df.withColumn("snapshot_ts", now)


def snapshot(status: DataFrame, info: DataFrame, at: Column | None = None) -> DataFrame:
    """One poll: harmonise -> merge -> keep -> stamp."""
    return stamp(keep_existing(merge(harmonise(status), info)), at)


def read_snapshot(spark: SparkSession, info_path: str, status_path: str) -> DataFrame:
    """One poll: the information and status documents at these paths."""
    info = read_stations(spark, info_path, INFO_STATION).drop("_doc", "last_updated")
    status = read_stations(spark, status_path, STATUS_STATION).drop("_doc", "last_updated")
    return snapshot(status, info)


STAMP = r"([0-9]{8}T[0-9]{6}Z)"


def read_polls(spark: SparkSession, info_glob: str, status_glob: str) -> DataFrame:
    """Many polls at once: documents are paired by the UTC stamp in their file
    names (``..._20240101T000000Z.json``), so stations join within a poll only
    (no fan-out across polls); the stamp becomes ``snapshot_ts``."""
    def stamped(path, schema):
        d = read_stations(spark, path, schema)
        return d.withColumn("_poll", F.regexp_extract("_doc", STAMP, 1)).drop("_doc", "last_updated")
    info, status = stamped(info_glob, INFO_STATION), stamped(status_glob, STATUS_STATION)
    merged = merge(harmonise(status), info, on=("_poll", "station_id"))
    merged = merged.withColumn("snapshot_ts", F.to_timestamp_ntz("_poll", F.lit("yyyyMMdd'T'HHmmss'Z'")))
    return merged.select(*[c for c in config.GBFS_KEEP if c in merged.columns], "snapshot_ts")
