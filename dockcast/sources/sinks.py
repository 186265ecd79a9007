"""Writers: snapshots (+ latest), weather, metrics, config and sample rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.operators.dims import materialise
from dockcast.sources import versions

FORMATS = ("csv", "parquet")


def write_snapshots(df: DataFrame, outdir: str, fmt: str = "parquet", latest: bool = True) -> None:
    """Append snapshots partitioned by day; optionally commit the newest snapshot of
    each station as the next version of ``latest`` (read it with ``versions.read``)."""
    fmt = fmt.lower()
    if fmt == "pq":
        fmt = "parquet"
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r} (csv|parquet)")
    df = materialise(df)                                   # history and latest show the same rows and stamps
    d = df.withColumn("snapshot_date", F.to_date("snapshot_ts"))
    w = d.write.mode("append").partitionBy("snapshot_date")
    (w.option("header", True).csv if fmt == "csv" else w.parquet)(f"{outdir}/snapshots")
    if latest:
        versions.commit(latest_per_station(df), f"{outdir}/latest", fmt=fmt)


def latest_per_station(df: DataFrame, ts: str = "snapshot_ts", key: str = "station_id") -> DataFrame:
    """Newest row per station: ``max_by`` with partial aggregation (no full sort)."""
    cols = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("_r"))
              .select(key, "_r.*"))


def write_weather(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_metrics(df: DataFrame, path: str, run_id: str | None = None) -> None:
    """Metrics table (horizon_min, mae_naive, mae_model, best_iter, gamma); a few rows."""
    d = df if run_id is None else df.withColumn("run_id", F.lit(run_id))
    d.coalesce(1).write.mode("append" if run_id else "overwrite").option("header", True).csv(path)


def write_config(spark: SparkSession, path: str, cfg: dict, feat_cols: list[str]) -> None:
    """One-row JSON config including the ordered feature list and the gamma map."""
    row = dict(cfg, feature_cols=list(feat_cols))
    spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_config(spark: SparkSession, path: str) -> dict:
    """The config row (one small file): horizons, gammas (key ``gammas``), feature order."""
    return json.loads(spark.read.text(path).first()["value"])


def write_sample_row(frame: DataFrame, feat_cols: list[str], path: str, order=("station_id", "ts")) -> DataFrame:
    """First fully defined row by (station, ts) — a top-1, not a sort."""
    row = frame.dropna(subset=list(feat_cols)).orderBy(*order).limit(1).select(*feat_cols)
    row.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return row
