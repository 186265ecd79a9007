"""Scoring requests: features from scalars + history, alignment, weather, predictions.

A request row is ``station_id, bikes_available, capacity, ts, history_5min``
(oldest -> newest).  Everything here is a per-row projection with
higher-order array functions — requests never shuffle — so the same code
scores a batch table or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import calendar_columns, clip, clip01, delta_to_bikes, gamma_for, rain_flag

STORED_FEATURES = config.feature_list(use_ema=False, use_sta=False, use_weather=True)


def _occ_of(x: Column, cap: Column) -> Column:
    """Serving occupancy: 0.0 for missing / non-positive capacity."""
    return F.when(cap > 0, F.coalesce(F.least(F.greatest(x / cap, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))).otherwise(F.lit(0.0))


def _occ_known(x: Column, cap: Column) -> Column:
    """Training occupancy: null bikes or no positive capacity stay null."""
    return F.when(cap > 0, clip01(x / cap))


def _mean(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)


def history_features(req: DataFrame, mode: str = "consistent") -> DataFrame:
    """Lag, rolling and delta features of a request from its history array.

    ``compat``: as the original service — at most the last 12 values, a
    missing lag or an empty history falls back to the current occupancy,
    rolling means use whatever is there (so 120/180 equal 60), and the
    12 h harmonics and 15/30 rolling means are not built (0.0 after align).
    ``consistent``: the training definitions — up to 36 values, every lag or
    rolling mean null unless its full history is present and known, all
    features built; null readings stay null.
    """
    cap = F.col("capacity").cast("double")
    occ_of = _occ_of if mode == "compat" else _occ_known
    occ_now = occ_of(F.col("bikes_available").cast("double"), cap)
    hist = F.coalesce(F.col("history_5min"), F.array().cast("array<double>"))
    keep = 12 if mode == "compat" else max(config.ROLL_STEPS)
    last = F.slice(hist, F.greatest(F.lit(1), F.size(hist) - (keep - 1)), keep)
    d = req.withColumns({"occ_now": occ_now, "_ho": F.transform(last, lambda v: occ_of(v, cap))})
    ho, n, now = F.col("_ho"), F.size("_ho"), F.col("occ_now")
    cols = {}
    lags = {k: (F.when(n >= k, F.element_at(ho, -k)).otherwise(now) if mode == "compat"
                else F.when(n >= k, F.element_at(ho, -k))) for k in config.LAG_STEPS}
    for k, v in lags.items():
        cols[f"occ_lag_{k * config.FREQ_MIN}"] = v
    rolls = (12, 24, 36) if mode == "compat" else config.ROLL_STEPS
    for k in rolls:
        tail = F.slice(ho, F.greatest(F.lit(1), n - k + 1), k)
        cols[f"occ_roll_{k * config.FREQ_MIN}"] = (F.when(n > 0, _mean(tail)).otherwise(now) if mode == "compat"
                                                   else F.when(n >= k, _mean(tail)))
    for k in config.DELTA_STEPS:
        lag = lags[k] if k in lags else F.when(n >= k, F.element_at(ho, -k)).otherwise(now)
        cols[f"occ_delta_{k * config.FREQ_MIN}"] = now - lag
    cal = calendar_columns(F.col("ts"))
    names = ("dow", "is_weekend", "hour_sin", "hour_cos") + (() if mode == "compat" else ("hour_sin2", "hour_cos2"))
    cols.update({k: cal[k] for k in names})
    return d.withColumns(cols).drop("_ho")


def current_weather(hourly: DataFrame) -> DataFrame:
    """The latest known value of each variable (missing -> 0.0): exactly one row, or none for an empty table.

    ``max_by`` over the rows where a variable is known is its forward filled value at
    the last hour; one aggregate with partial aggregation, no order over all hours.
    """
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in config.WEATHER_COLS]
    one = hourly.agg(F.count(F.lit(1)).alias("_n"), *last).where("_n > 0")
    return (one.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in config.WEATHER_COLS])
            .withColumn("is_rain", rain_flag(F.col("precipitation"))))


def with_weather(req: DataFrame, weather_row: DataFrame) -> DataFrame:
    """Every request gets the one current weather row (a one-row broadcast)."""
    return req.crossJoin(F.broadcast(weather_row))


def align(df: DataFrame, feat_cols=STORED_FEATURES, keep=("station_id", "ts", "bikes_available")) -> DataFrame:
    """Project to the model's ordered columns as float; missing or null -> 0.0.

    Station encodings default to the current occupancy when not joined.
    """
    d = df
    for c in config.STATION_FEATURES:
        if c in feat_cols:
            d = d.withColumn(c, F.coalesce(F.col(c), F.col("occ_now")) if c in d.columns else F.col("occ_now"))
    cols = [F.col(k) for k in keep if k in d.columns]
    if "capacity" in d.columns:                      # the request's own value, used to clip
        cols.append(F.col("capacity").cast("double").alias("capacity_in"))
    for c in feat_cols:
        v = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in d.columns else F.lit(0.0)
        cols.append(v.cast("float").alias(c))
    return d.select(*cols)


def accepted_horizons(requested: Column, available=config.HORIZONS) -> Column:
    """Requested horizons that have a model; none requested means all available."""
    avail = F.array(*[F.lit(h) for h in available])
    return F.filter(F.coalesce(requested, avail), lambda h: F.array_contains(avail, h))


def horizon_filter(req: DataFrame, requested: str = "horizons", available=config.HORIZONS) -> DataFrame:
    """One row per requested horizon with ``accepted`` (unknown ones are the side output)."""
    avail = F.array(*[F.lit(h) for h in available])
    r = F.coalesce(F.col(requested), avail)
    return (req.select("station_id", "ts", F.explode(r).alias("horizon_min"))
               .withColumn("accepted", F.array_contains(avail, F.col("horizon_min"))))


def predict(aligned: DataFrame, delta_cols: dict[int, str], gammas: dict[str, float] | Column,
            requested: str | None = None, target_kind: str = "delta_occ", long: bool = True) -> DataFrame:
    """Turn per-horizon model outputs (Δocc columns) into bike forecasts.

    ``predicted_bikes = round(clip(bikes + gamma*delta*capacity, 0, capacity), 3)``,
    ``delta_model = round(gamma*delta, 6)``.  ``long`` gives one row per
    accepted horizon, else one row per request with a map horizon -> struct.
    """
    gmap = gammas if isinstance(gammas, Column) else F.create_map(
        *[x for k, v in gammas.items() for x in (F.lit(str(k)), F.lit(None if v is None else float(v)).cast("double"))])
    hs = accepted_horizons(F.col(requested) if requested else F.lit(None).cast("array<int>"), sorted(delta_cols))
    bikes = F.col("bikes_available").cast("double")
    cap = F.col("capacity_in" if "capacity_in" in aligned.columns else "capacity").cast("double")

    def one(h: Column) -> Column:
        delta = F.lit(None).cast("double")
        for hz, c in delta_cols.items():
            delta = F.when(h == hz, F.col(c).cast("double")).otherwise(delta)
        dg = delta * gamma_for(gmap, h)
        y = clip(bikes + delta_to_bikes(dg, cap, target_kind), F.lit(0.0), cap)
        return F.struct(h.alias("horizon_min"), F.bround(y, 3).alias("predicted_bikes"), F.bround(dg, 6).alias("delta_model"))

    d = aligned.withColumn("_p", F.transform(hs, one))
    if long:
        return d.select("*", F.explode("_p").alias("_r")).select(
            *[c for c in aligned.columns], "_r.horizon_min", "_r.predicted_bikes", "_r.delta_model")
    entries = F.transform("_p", lambda s: F.struct(s["horizon_min"].cast("string"),
                                                   F.struct(s["predicted_bikes"], s["delta_model"])))
    return d.select("station_id", "ts", F.map_from_entries(entries).alias("predictions"))
