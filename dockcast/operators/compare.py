"""Errors of several forecasts on the same rows: a row counts for all methods of a horizon or for none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import calendar_columns
from dockcast.operators.baselines import seasonal_median
from dockcast.operators.dims import sized_join


def with_seasonal(train: DataFrame, test: DataFrame) -> DataFrame:
    """``test`` with ``pred_seasonal``: the train median of bikes per (station, weekday, hour), null where train has none."""
    cal = calendar_columns(F.col("ts"))
    keyed = test.withColumns({"dow": cal["dow"], "hour": cal["hour"]})
    return sized_join(keyed, seasonal_median(train), ["station_id", "dow", "hour"], "left")


def common_errors(test: DataFrame, methods: dict[str, dict[int, Column]], horizons=config.HORIZONS) -> DataFrame:
    """(horizon_min, n_rows, mae_<method> ...): one aggregate over ``test``.

    ``methods`` gives each method's forecast in bikes by horizon; truth is ``y_<h>``.  A horizon's rows
    are those with the truth and every method's forecast; without such rows its errors are null.
    """
    aggs = []
    for h in horizons:
        truth = F.col(f"y_{h}").cast("double")
        ok = truth.isNotNull()
        for by_horizon in methods.values():
            ok = ok & by_horizon[h].isNotNull()
        aggs.append(F.count(F.when(ok, F.lit(1))).alias(f"n_{h}"))
        aggs += [F.avg(F.when(ok, F.abs(truth - by_horizon[h].cast("double")))).alias(f"{name}_{h}") for name, by_horizon in methods.items()]
    rows = [F.struct(F.lit(h).alias("horizon_min"), F.col(f"n_{h}").alias("n_rows"), *[F.col(f"{name}_{h}").alias(f"mae_{name}") for name in methods])
            for h in horizons]
    return test.agg(*aggs).select(F.inline(F.array(*rows)))
