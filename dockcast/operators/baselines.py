"""Baseline forecasts and their errors (mean absolute error, in bikes).

Each MAE for all horizons is one aggregate with conditional averages (one
pass, partial aggregation), returned as long rows ``(horizon_min, ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import calendar_columns
from dockcast.operators import split as split_ops
from dockcast.operators.dims import sized_join
from dockcast.operators.quantile import grouped_quantile


def _long(row: DataFrame, metrics: dict[str, str], horizons=config.HORIZONS) -> DataFrame:
    """One wide row -> one row per horizon."""
    structs = [F.struct(F.lit(h).alias("horizon_min"),
                        *[F.col(tmpl.format(h=h)).alias(name) for name, tmpl in metrics.items()])
               for h in horizons]
    return row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def _mae_bikes(truth: Column, pred: Column, cap: Column) -> Column:
    """|truth*cap - pred*cap| in float arithmetic (the stored precision)."""
    return F.abs(truth * cap - pred * cap)


def naive_mae(test: DataFrame, horizons=config.HORIZONS) -> DataFrame:
    """Last value forecast: occ(t) for occ(t+h); rows need occ_h, occ, capacity."""
    aggs = []
    for h in horizons:
        ok = F.col(f"occ_{h}").isNotNull() & F.col("occ").isNotNull() & F.col("capacity").isNotNull()
        e = F.when(ok, _mae_bikes(F.col(f"occ_{h}"), F.col("occ"), F.col("capacity")))
        aggs += [F.avg(e).alias(f"m{h}"), F.count(e).alias(f"n{h}")]
    return _long(test.agg(*aggs), {"mae_naive": "m{h}", "n_rows": "n{h}"}, horizons)


def ewma_mae(test: DataFrame, horizons=config.HORIZONS, ema_col: str = "occ_ema_fast") -> DataFrame:
    """EWMA forecast: the EMA of the previous occupancies stands for occ(t+h)."""
    aggs = []
    for h in horizons:
        ok = F.col(f"occ_{h}").isNotNull() & F.col(ema_col).isNotNull() & F.col("capacity").isNotNull()
        e = F.when(ok, _mae_bikes(F.col(f"occ_{h}"), F.col(ema_col), F.col("capacity")))
        aggs += [F.avg(e).alias(f"m{h}"), F.count(e).alias(f"n{h}")]
    return _long(test.agg(*aggs), {"mae_ewma": "m{h}", "n_rows": "n{h}"}, horizons)


def naive_and_ewma_mae(test: DataFrame, horizons=config.HORIZONS, ema_col: str = "occ_ema_fast") -> DataFrame:
    """Both persistence baselines from one aggregate pass over the test rows."""
    aggs = []
    for h in horizons:
        base = F.col(f"occ_{h}").isNotNull() & F.col("capacity").isNotNull()
        en = F.when(base & F.col("occ").isNotNull(), _mae_bikes(F.col(f"occ_{h}"), F.col("occ"), F.col("capacity")))
        ee = F.when(base & F.col(ema_col).isNotNull(), _mae_bikes(F.col(f"occ_{h}"), F.col(ema_col), F.col("capacity")))
        aggs += [F.avg(en).alias(f"n{h}"), F.avg(ee).alias(f"e{h}")]
    return _long(test.agg(*aggs), {"mae_naive": "n{h}", "mae_ewma": "e{h}"}, horizons)


def seasonal_median(train: DataFrame, value: str = "bikes_available") -> DataFrame:
    """Exact median of ``value`` per (station, dow, hour) on train."""
    cal = calendar_columns(F.col("ts"))
    t = train.select("station_id", cal["dow"].alias("dow"), cal["hour"].alias("hour"), value)
    return grouped_quantile(t, ["station_id", "dow", "hour"], value, out="pred_seasonal")


def seasonal_mae(with_targets: DataFrame, horizons=config.HORIZONS, q: float = config.SPLIT_TRAINTEST,
                 cut: DataFrame | None = None) -> DataFrame:
    """Seasonal forecast in bikes: train median of (station, dow, hour) for y_h.

    ``with_targets`` is the raw panel with ``y_h`` (future bikes).  Rows are
    scored where both the truth and the median exist.  ``cut`` may be a
    stored one-row cut of the same rows.
    """
    cut = cut if cut is not None else split_ops.temporal_cut(with_targets, q)
    train, test = split_ops.split_frames(with_targets, q, cut=cut)
    med = seasonal_median(train)
    cal = calendar_columns(F.col("ts"))
    t = test.withColumns({"dow": cal["dow"], "hour": cal["hour"]})
    scored = sized_join(t, med, ["station_id", "dow", "hour"], "left")
    aggs = []
    for h in horizons:
        e = F.when(F.col(f"y_{h}").isNotNull() & F.col("pred_seasonal").isNotNull(),
                   F.abs(F.col(f"y_{h}").cast("double") - F.col("pred_seasonal")))
        aggs += [F.avg(e).alias(f"m{h}"), F.count(e).alias(f"n{h}")]
    return _long(scored.agg(*aggs), {"mae_seasonal": "m{h}", "n_rows": "n{h}"}, horizons)


def bikespace_naive_mae(bike_feat: DataFrame, horizons=config.HORIZONS, q: float = config.SPLIT_TRAINTEST) -> DataFrame:
    """Naive forecast in bikes on the fully defined bike-space frame (all nulls dropped first)."""
    full = bike_feat.dropna()
    _, test = split_ops.split_frames(full, q)
    aggs = []
    for h in horizons:
        e = F.abs(F.col(f"y_{h}") - F.col("bikes_available"))
        aggs += [F.avg(e).alias(f"m{h}"), F.count(e).alias(f"n{h}")]
    return _long(test.agg(*aggs), {"mae_naive": "m{h}", "n_rows": "n{h}"}, horizons)
