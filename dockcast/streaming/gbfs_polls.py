"""GBFS information and status documents as two streams, joined per poll.

A poll fetches both documents within seconds.  Each lands as one line of JSON with
``last_updated``; the two file streams are exploded to stations and joined on
``station_id`` where the information is at most ``bound`` older than the status, so
polls never mix as long as they are farther apart than that.  Both sides have a
watermark; with the time bound it lets the join drop state: an information row
waits until no status of its poll can still come, and the other way round.

A poll of which one document never comes gives no rows.  A document that comes late,
but within ``delay`` of the newest time both streams have reached, is joined as if
in time; one that comes later is dropped, because its partners have left the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast import config
from dockcast.functions.columns import from_micros
from dockcast.sources.gbfs import INFO_STATION, STATUS_STATION, document_schema, harmonise


def document_stream(spark: SparkSession, path: str, station: T.StructType, delay: str, max_files: int) -> DataFrame:
    """Stations of every landed document, with the document's time in ``_et`` under a watermark."""
    docs = spark.readStream.schema(document_schema(station)).option("maxFilesPerTrigger", max_files).json(path)
    timed = docs.select(F.timestamp_seconds("last_updated").alias("_et"), "data").withWatermark("_et", delay)
    return timed.select("_et", F.inline("data.stations"))


def join_polls(info: DataFrame, status: DataFrame, bound: str = "1 minute", keep=config.GBFS_KEEP) -> DataFrame:
    """status ⋈ info of the same poll and station, harmonised, stamped with the status document's time."""
    i = info.select(F.col("_et").alias("_info_et"), *[F.col(c).alias(f"_i_{c}") for c in INFO_STATION.fieldNames()])
    s = harmonise(status)
    both = s.join(i, F.expr(f"station_id = _i_station_id AND _info_et <= _et AND _info_et >= _et - INTERVAL {bound}"), "inner")
    names = [F.col(c) if c in s.columns else F.col(f"_i_{c}").alias(c) for c in keep]
    return both.select(*names, from_micros(F.unix_micros("_et")).alias("snapshot_ts"))


def start_polls(spark: SparkSession, info: str, status: str, out: str, checkpoint: str, delay: str = "10 minutes",
                bound: str = "1 minute", max_files: int = 4, available_now: bool = False):
    """Join landed documents into snapshot rows, appended to a Parquet table."""
    rows = join_polls(document_stream(spark, info, INFO_STATION, delay, max_files),
                      document_stream(spark, status, STATUS_STATION, delay, max_files), bound)
    w = (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append"))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()
