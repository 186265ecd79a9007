"""Station encodings learnt on the train split only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.columns import calendar_columns
from dockcast.operators.dims import sized_join
from dockcast.operators.quantile import grouped_quantile


def station_mean(train: DataFrame) -> DataFrame:
    """Mean occupancy per station (nulls skipped)."""
    return train.groupBy("station_id").agg(F.avg("occ").alias("sta_mean_occ"))


def station_hour_median(train: DataFrame, approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Median occupancy per (station, dow, hour); exact by default, also for continuous values.

    ``approx=True`` opts into ``percentile_approx`` (a fixed-size sketch).
    """
    t = _narrow(train)
    if not approx:
        return grouped_quantile(t, ["station_id", "dow", "hour"], "occ", out="sta_hdh_occ")
    return t.groupBy("station_id", "dow", "hour").agg(F.percentile_approx("occ", 0.5, accuracy).cast("double").alias("sta_hdh_occ"))


def _narrow(train: DataFrame) -> DataFrame:
    """(station_id, dow, hour, occ): all the encodings read."""
    if {"dow", "hour"} <= set(train.columns) and "ts" not in train.columns:
        return train.select("station_id", "dow", "hour", "occ")
    cal = calendar_columns(F.col("ts"))
    return train.select("station_id", cal["dow"].alias("dow"), cal["hour"].alias("hour"), "occ")


def fit(train: DataFrame, approx: bool = False, store: bool = False) -> tuple[DataFrame, DataFrame]:
    """Both encodings.  ``store`` writes the narrow train projection once, so the
    two aggregates read it instead of each recomputing the train plan."""
    t = _narrow(train)
    if store:
        from dockcast.operators.dims import materialise
        t = materialise(t)
    return station_mean(t), station_hour_median(t, approx)


def apply(frame: DataFrame, enc: tuple[DataFrame, DataFrame], materialize: bool = True) -> DataFrame:
    """Left-join both encodings; a missing hour median falls back to the station mean."""
    mean, hdh = enc
    out = sized_join(frame, mean, "station_id", "left", materialize=materialize)
    out = sized_join(out, hdh, ["station_id", "dow", "hour"], "left", materialize=materialize)
    return out.withColumn("sta_hdh_occ", F.coalesce(F.col("sta_hdh_occ"), F.col("sta_mean_occ")))
