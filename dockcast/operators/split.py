"""Temporal split and split-aware delta targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import from_micros, micros
from dockcast.operators.quantile import exact_quantile


TIME_BIN_US = 60_000_000.0      # one-minute buckets for time quantiles


def temporal_cut(df: DataFrame, q: float = config.SPLIT_TRAINTEST, ts: str = "ts") -> DataFrame:
    """One row: ``n_rows``, ``cut_us`` (floor of the interpolated quantile of ts in µs)
    and ``cut_ts``.  Rows with ``ts <= cut`` are train, the rest test."""
    qd = exact_quantile(df, micros(ts), q, out="_cut", width=TIME_BIN_US)
    cut_us = F.floor("_cut")
    return qd.select(F.col("n").alias("n_rows"), cut_us.alias("cut_us"), from_micros(cut_us).alias("cut_ts"))


def label_split(df: DataFrame, cut: DataFrame, ts: str = "ts", col: str = "is_train") -> DataFrame:
    """Attach the cut (one row, broadcast) and a boolean ``is_train``."""
    c = F.broadcast(cut.select(F.col("cut_us").alias("_cut_us")))
    return df.crossJoin(c).withColumn(col, micros(ts) <= F.col("_cut_us"))


def split_frames(df: DataFrame, q: float = config.SPLIT_TRAINTEST, ts: str = "ts",
                 cut: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) with ``ts <= cut`` / ``ts > cut``; both lazy, one shared cut."""
    cut = cut if cut is not None else temporal_cut(df, q, ts)
    lab = label_split(df, cut, ts)
    return (lab.where("is_train").drop("is_train", "_cut_us"),
            lab.where(~F.col("is_train")).drop("is_train", "_cut_us"))


def delta_targets(df: DataFrame, cut: DataFrame, horizons=config.HORIZONS) -> DataFrame:
    """``occ_delta_target_h = occ(t+h) - occ(t)`` computed *inside* each split.

    Train and test are a prefix and a suffix of each station's rows, so the
    lead inside a split equals the lead on the whole frame unless the target
    row lies across the cut; ``ts_h`` (kept by ``build_features``) tells.
    No second window is needed.
    """
    # reuse a cut already attached by ``label_split``; else attach the one-row cut
    d = df if "_cut_us" in df.columns else df.crossJoin(F.broadcast(cut.select(F.col("cut_us").alias("_cut_us"))))
    cols = {}
    for h in horizons:
        crosses = (micros("ts") <= F.col("_cut_us")) & (micros(f"ts_{h}") > F.col("_cut_us"))
        cols[f"occ_delta_target_{h}"] = F.when(~crosses, F.col(f"occ_{h}") - F.col("occ")).cast("float")
    return d.withColumns(cols).drop("_cut_us")
