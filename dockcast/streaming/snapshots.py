"""Structured Streaming: snapshot files -> snapshot table, latest state, 5-minute panel.

The original polls an HTTP feed in a loop and writes one file per poll.
Here the landed files are a file-source stream: every trigger picks up the
new files (``maxFilesPerTrigger`` bounds a batch), and the checkpoint in the
shared folder makes the job restartable after a lost driver or executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast import config
from dockcast.functions.columns import from_micros, micros
from dockcast.sources import versions
from dockcast.sources.sinks import latest_per_station

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("capacity", T.DoubleType()), T.StructField("is_installed", T.IntegerType()),
    T.StructField("is_renting", T.IntegerType()), T.StructField("is_returning", T.IntegerType()),
    T.StructField("last_reported", T.LongType()), T.StructField("num_bikes_available", T.DoubleType()),
    T.StructField("num_docks_available", T.DoubleType()), T.StructField("snapshot_ts", T.TimestampNTZType())])


def read_snapshot_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = SNAPSHOT_SCHEMA,
                         max_files: int = 1000) -> DataFrame:
    return (spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files)
                 .option("header", True).load(path))


def to_panel(snapshots: DataFrame, freq_min: int = config.FREQ_MIN, ts: str = "snapshot_ts",
             bikes: str = "num_bikes_available", watermark: str | None = None) -> DataFrame:
    """Snapshots -> one row per (station, 5-minute tick): the latest reading in the tick.

    Batch and stream share this code.  On a stream pass ``watermark``
    (e.g. ``"10 minutes"``): duplicates inside it are dropped, a tick is
    emitted once the watermark passes its end, and later data for a closed
    tick is ignored (the late-data rule of this design).
    """
    # event time as an instant (watermarks need TIMESTAMP); UTC wall clock <-> epoch µs, zone-free
    d = snapshots.withColumn("_et", F.timestamp_micros(micros(ts)))
    if watermark:
        d = d.withWatermark("_et", watermark).dropDuplicatesWithinWatermark(["station_id", "_et"])
    g = d.groupBy("station_id", F.window("_et", f"{freq_min} minutes").alias("w"))
    agg = g.agg(F.max_by(F.struct(F.col(bikes).cast("float").alias("bikes_available"),
                                  F.col("capacity").cast("float").alias("capacity")), F.col("_et")).alias("_r"),
                F.count(F.lit(1)).alias("n_snapshots"))
    return agg.select("station_id", from_micros(F.unix_micros("w.start")).alias("ts"), "_r.bikes_available",
                      "_r.capacity", "n_snapshots")


def start_ingest(spark: SparkSession, landing: str, table: str, checkpoint: str, fmt: str = "parquet",
                 trigger_seconds: int | None = 60, available_now: bool = False):
    """Append every landed snapshot to a day-partitioned Parquet table."""
    s = read_snapshot_stream(spark, landing, fmt).withColumn("snapshot_date", F.to_date("snapshot_ts"))
    w = (s.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
          .partitionBy("snapshot_date").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def start_latest(spark: SparkSession, landing: str, out: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = False, max_files: int = 1000, keep: int = versions.KEEP):
    """Keep a ``latest`` table: each micro-batch merges its newest row per station into the version
    before and commits a version of its own (foreachBatch).

    A version counts once its pointer is written, so a crash loses nothing and a repeated batch
    starts from the version before it again (``keep`` is at least 2); a read error fails the batch.
    Read it with ``versions.read``.
    """
    def merge(batch: DataFrame, epoch: int) -> None:
        fresh = latest_per_station(batch)
        old = versions.read(batch.sparkSession, out, before=epoch)
        if old is not None:
            fresh = latest_per_station(old.unionByName(fresh))
        versions.commit(fresh, out, epoch, max(2, keep))

    s = read_snapshot_stream(spark, landing, fmt, max_files=max_files)
    w = s.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()


def start_panel(spark: SparkSession, landing: str, out: str, checkpoint: str, fmt: str = "parquet",
                watermark: str = "10 minutes", available_now: bool = False, max_files: int = 1000):
    """Stream the 5-minute panel into Parquet (append mode, closed ticks only)."""
    p = to_panel(read_snapshot_stream(spark, landing, fmt, max_files=max_files), watermark=watermark)
    w = (p.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
          .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()
