"""Queries of the scoring side: request features, alignment, weather, predictions,
horizon handling, reconstruction and gamma calibration (with a fixed stand-in delta)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import micros
from dockcast.operators.quantile import exact_quantile
from dockcast.plans import scoring
from dockcast.plans.catalog import KEYS, register
from dockcast.plans.q_panel import CUT_SQL, DT_SQL, _clean_cols
from dockcast.plans.q_weather import WEATHER_HOURLY, WFILL
from dockcast.plans.sqltext import FEATS, with_

H = config.HORIZONS
RKEYS = [("station_id", "s"), ("ts", "t")]
# stand-in per-horizon delta of the SQL-checkable scoring queries: persistence
# of the last h-minute change (a real run uses the MLlib models, see q_models)
STAND_IN = {h: f"occ_delta_{h}" for h in H}
GAMMAS = {"15": 0.5, "30": 0.0, "60": 0.9}      # 0 means "not calibrated" -> 1.0

REQ_SQL = """req AS (
  SELECT CAST(user_id AS VARCHAR) AS station_id, CAST(COALESCE(bikes, 0) AS DOUBLE) AS bikes_available,
         CASE WHEN user_id % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(20 + user_id % 40 AS DOUBLE) END AS capacity, ts,
         CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 14 = 0 THEN CAST([] AS DOUBLE[])
              ELSE list_slice(h, greatest(len(h) - user_id % 14 + 1, 1), len(h)) END AS history_5min,
         user_id
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r,
               list_filter(list(bikes) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                             ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING), lambda x: x IS NOT NULL) AS h
        FROM (SELECT *, CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS bikes FROM events) e) x
  WHERE r = 1)"""

_OCC = "CASE WHEN capacity > 0 THEN COALESCE(LEAST(GREATEST({v} / capacity, CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)), CAST(0 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END"


def _hf_sql() -> str:
    hist = "COALESCE(history_5min, CAST([] AS DOUBLE[]))"
    lags = {k: f"CASE WHEN len(ho) >= {k} THEN ho[-{k}] ELSE occ_now END" for k in config.LAG_STEPS}
    parts = [f"{v} AS occ_lag_{k * config.FREQ_MIN}" for k, v in lags.items()]
    for k in (12, 24, 36):
        tail = f"list_slice(ho, greatest(len(ho) - {k} + 1, 1), len(ho))"
        parts.append(f"CASE WHEN len(ho) > 0 THEN list_sum({tail}) / len({tail}) ELSE occ_now END AS occ_roll_{k * config.FREQ_MIN}")
    parts += [f"occ_now - ({lags[k]}) AS occ_delta_{k * config.FREQ_MIN}" for k in config.DELTA_STEPS]
    hd = "CAST(hour(ts) AS DOUBLE)"
    parts += ["CAST(isodow(ts) - 1 AS TINYINT) AS dow", "CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS TINYINT) AS is_weekend",
              f"CAST(sin(2*pi()*{hd}/24) AS REAL) AS hour_sin", f"CAST(cos(2*pi()*{hd}/24) AS REAL) AS hour_cos"]
    inner = (f"SELECT *, {_OCC.format(v='bikes_available')} AS occ_now, "
             f"list_transform(list_slice({hist}, greatest(len({hist}) - 11, 1), len({hist})), lambda v: {_OCC.format(v='v')}) AS ho FROM req")
    return f"hf AS (SELECT *, {', '.join(parts)} FROM ({inner}) x)"


HF_SQL = _hf_sql()
HIST_COLS = (["occ_now"] + [f"occ_lag_{k * config.FREQ_MIN}" for k in config.LAG_STEPS]
             + [f"occ_roll_{k}" for k in (60, 120, 180)] + [f"occ_delta_{k * config.FREQ_MIN}" for k in config.DELTA_STEPS])
CW_SQL = """cw AS (SELECT COALESCE(temperature_2m, CAST(0 AS DOUBLE)) AS temperature_2m,
               COALESCE(precipitation, CAST(0 AS DOUBLE)) AS precipitation,
               COALESCE(wind_speed_10m, CAST(0 AS DOUBLE)) AS wind_speed_10m,
               CASE WHEN COALESCE(precipitation, CAST(0 AS DOUBLE)) > CAST(0.1 AS DOUBLE) THEN 1 ELSE 0 END AS is_rain
             FROM wfill ORDER BY ts DESC LIMIT 1)"""
_BUILT = set(HIST_COLS) | {"dow", "is_weekend", "hour_sin", "hour_cos", "capacity", "temperature_2m",
                           "precipitation", "wind_speed_10m", "is_rain"}
AL_SQL = "al AS (SELECT station_id, ts, bikes_available, capacity AS capacity_in, user_id, " + ", ".join(
    f"CAST(COALESCE(CAST({c} AS DOUBLE), CAST(0 AS DOUBLE)) AS REAL) AS {c}" if c in _BUILT else f"CAST(0 AS REAL) AS {c}"
    for c in scoring.STORED_FEATURES) + " FROM hf, cw)"


def _requests_features(c):
    req = scoring.history_features(c.requests, "compat")
    return scoring.with_weather(req, scoring.current_weather(c.weather_hourly))


@register("history_features", RKEYS + [(x, "q") for x in HIST_COLS],
          with_(REQ_SQL, HF_SQL) + "SELECT {out} FROM hf")
def history_features(c):
    """Lags / rolling means / deltas from each request's history array, as the original service builds them."""
    return scoring.history_features(c.requests, "compat")


LONG_REQ_SQL = """req AS (
  SELECT CAST(user_id AS VARCHAR) AS station_id, CAST(COALESCE(bikes, 0) AS DOUBLE) AS bikes_available,
         CASE WHEN user_id % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(20 + user_id % 40 AS DOUBLE) END AS capacity, ts,
         CASE WHEN user_id % 17 = 0 THEN NULL
              ELSE list_slice(h, greatest(len(h) - greatest(36 - user_id % 14 * 3, 0) + 1, 1), len(h)) END AS history_5min
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r,
               list(bikes) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 36 PRECEDING AND 1 PRECEDING) AS h
        FROM (SELECT *, CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS bikes FROM events) e) x
  WHERE r = 1)"""


def _consistent_sql() -> str:
    occ = ("CASE WHEN capacity > 0 AND {v} IS NOT NULL "
           "THEN LEAST(GREATEST({v} / capacity, CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) END")
    lag = {k: f"CASE WHEN len(ho) >= {k} THEN ho[-{k}] END" for k in config.LAG_STEPS}
    cols = [f"{v} AS occ_lag_{k * config.FREQ_MIN}" for k, v in lag.items()]
    for k in config.ROLL_STEPS:
        tail = f"list_slice(ho, len(ho) - {k} + 1, len(ho))"
        cols.append(f"CASE WHEN len(ho) >= {k} AND len(list_filter({tail}, lambda v: v IS NULL)) = 0 "
                    f"THEN list_sum({tail}) / {k} END AS occ_roll_{k * config.FREQ_MIN}")
    cols += [f"occ_now - ({lag[k]}) AS occ_delta_{k * config.FREQ_MIN}" for k in config.DELTA_STEPS]
    inner = (f"SELECT *, {occ.format(v='bikes_available')} AS occ_now, list_transform(COALESCE(history_5min, CAST([] AS DOUBLE[])), "
             f"lambda v: {occ.format(v='v')}) AS ho FROM req")
    return f"hf AS (SELECT *, {', '.join(cols)} FROM ({inner}) x)"


_CONSISTENT = (["occ_now"] + [f"occ_lag_{k * config.FREQ_MIN}" for k in config.LAG_STEPS]
               + [f"occ_roll_{k * config.FREQ_MIN}" for k in config.ROLL_STEPS]
               + [f"occ_delta_{k * config.FREQ_MIN}" for k in config.DELTA_STEPS])


@register("history_features_consistent", RKEYS + [(x, "q") for x in _CONSISTENT],
          with_(LONG_REQ_SQL, _consistent_sql()) + "SELECT {out} FROM hf")
def history_features_consistent(c):
    """The training definitions from histories of up to 36 readings; an unknown reading leaves its windows null."""
    return scoring.history_features(c.long_requests)


@register("request_weather", RKEYS + [(x, "q") for x in config.WEATHER_COLS] + [("is_rain", "i")],
          with_(REQ_SQL, WEATHER_HOURLY, WFILL, CW_SQL) + "SELECT {out} FROM req, cw")
def request_weather(c):
    """Every request joined with the one current weather row."""
    return scoring.with_weather(c.requests, scoring.current_weather(c.weather_hourly))


@register("align_features", RKEYS + [(x, "q") for x in scoring.STORED_FEATURES],
          with_(REQ_SQL, HF_SQL, WEATHER_HOURLY, WFILL, CW_SQL, AL_SQL) + "SELECT {out} FROM al")
def align_features(c):
    """Request features projected onto the stored 26-column model order (absent -> 0.0)."""
    return scoring.align(_requests_features(c))


_REQ_H = ("CASE WHEN user_id % 4 = 0 THEN [15, 45, 60] WHEN user_id % 4 = 1 THEN [30] "
          "WHEN user_id % 4 = 2 THEN [5, 15] ELSE NULL END")


def _with_requested(df, c):
    u = F.col("station_id").cast("long")
    req_h = (F.when(u % 4 == 0, F.array(F.lit(15), F.lit(45), F.lit(60)))
              .when(u % 4 == 1, F.array(F.lit(30)))
              .when(u % 4 == 2, F.array(F.lit(5), F.lit(15))))
    return df.withColumn("horizons", req_h)


@register("horizon_filter", RKEYS + [("horizon_min", "i"), ("accepted", "b")],
          with_(REQ_SQL) + f"""SELECT {{out}} FROM (SELECT station_id, ts, unnest(COALESCE({_REQ_H}, [15, 30, 60])) AS horizon_min FROM req) x
             , LATERAL (SELECT list_contains([15, 30, 60], x.horizon_min) AS accepted) y""")
def horizon_filter(c):
    """Requested horizons x available models; unknown horizons flagged, not scored."""
    return scoring.horizon_filter(_with_requested(c.requests, c))


def _gamma_sql(h: str) -> str:
    return f"CASE {h} WHEN 15 THEN CAST(0.5 AS DOUBLE) WHEN 30 THEN CAST(1 AS DOUBLE) WHEN 60 THEN CAST(0.9 AS DOUBLE) END"


_SCORE_SQL = f"""sr AS (
  SELECT station_id, ts, horizon_min,
         round_even(LEAST(GREATEST(bikes_available + (d * g) * capacity_in, CAST(0 AS DOUBLE)), capacity_in), 3) AS predicted_bikes,
         round_even(d * g, 6) AS delta_model
  FROM (SELECT al.*, h.horizon_min,
               CASE h.horizon_min WHEN 15 THEN CAST(occ_delta_15 AS DOUBLE) WHEN 30 THEN CAST(occ_delta_30 AS DOUBLE)
                                  WHEN 60 THEN CAST(occ_delta_60 AS DOUBLE) END AS d,
               {_gamma_sql('h.horizon_min')} AS g
        FROM al, LATERAL (SELECT unnest(list_filter(COALESCE({_REQ_H}, [15, 30, 60]), lambda v: list_contains([15, 30, 60], v))) AS horizon_min) h) x)"""


@register("score_requests", RKEYS + [("horizon_min", "i"), ("predicted_bikes", "q"), ("delta_model", "q")],
          with_(REQ_SQL, HF_SQL, WEATHER_HOURLY, WFILL, CW_SQL, AL_SQL, _SCORE_SQL) + "SELECT {out} FROM sr")
def score_requests(c):
    """Requests -> features -> per-horizon Δ (stand-in) -> gamma -> bikes, one row per accepted horizon."""
    al = _with_requested(scoring.align(_requests_features(c)), c)
    return scoring.predict(al, STAND_IN, GAMMAS, requested="horizons")


@register("score_nested", RKEYS + [("horizon_min", "i"), ("predicted_bikes", "q"), ("delta_model", "q")],
          with_(REQ_SQL, HF_SQL, WEATHER_HOURLY, WFILL, CW_SQL, AL_SQL, _SCORE_SQL) + "SELECT {out} FROM sr")
def score_nested(c):
    """The service's nested answer (a map horizon -> {predicted_bikes, delta_model} per request), read entry by entry."""
    al = _with_requested(scoring.align(_requests_features(c)), c)
    nested = scoring.predict(al, STAND_IN, GAMMAS, requested="horizons", long=False)
    entry = F.explode("predictions").alias("horizon_min", "answer")
    return nested.select("station_id", "ts", entry).select("station_id", "ts", F.col("horizon_min").cast("int").alias("horizon_min"), "answer.*")


_RECON_G = 0.7


@register("reconstruct", KEYS + [("horizon_min", "i"), ("y_hat", "q"), ("y_true", "q")],
          with_(*FEATS, CUT_SQL, DT_SQL) + "SELECT {out} FROM (" + " UNION ALL ".join(f"""SELECT station_id, ts, event_id, {h} AS horizon_min,
             LEAST(GREATEST(CAST(occ_now AS DOUBLE) + CAST({_RECON_G!r} AS DOUBLE) * CAST(occ_delta_{h} AS DOUBLE),
                            CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) * CAST(capacity AS DOUBLE) AS y_hat,
             occ_{h} * capacity AS y_true
             FROM dt WHERE NOT is_train AND occ_delta_{h} IS NOT NULL AND occ_{h} IS NOT NULL""" for h in H) + ") x")
def reconstruct(c):
    """Bikes from a Δ-occupancy forecast of each horizon: clip(occ_now + γ·Δ, 0, 1)·capacity (stand-in Δ)."""
    from dockcast.plans.models import reconstruct_bikes
    rows = [F.when(F.col(f"occ_delta_{h}").isNotNull() & F.col(f"occ_{h}").isNotNull(), F.struct(
        F.lit(h).alias("horizon_min"), reconstruct_bikes(F.col("occ_now"), F.lit(_RECON_G), F.col(f"occ_delta_{h}"), F.col("capacity")).alias("y_hat"),
        (F.col(f"occ_{h}") * F.col("capacity")).alias("y_true"))) for h in H]
    te = c.labelled.where(~F.col("is_train")).withColumn("_h", F.explode(F.array_compact(F.array(*rows))))
    return te.select(*[k for k, _ in KEYS], "_h.*")


def _gamma_grid_sql() -> str:
    parts = []
    for h in H:
        cond = " AND ".join(f"{x} IS NOT NULL" for x in _clean_cols(h))
        parts.append(f"v{h} AS (SELECT {h} AS horizon_min, ts, occ_now, occ_delta_15 AS d, capacity, occ_{h} AS y "
                     f"FROM dt WHERE is_train AND {cond})")
        parts.append(f"c{h} AS (SELECT floor(quantile_cont(epoch_us(ts), {config.SPLIT_TRAINVAL})) AS cut_us FROM v{h})")
    vals = " UNION ALL ".join(f"SELECT v{h}.* FROM v{h}, c{h} WHERE epoch_us(v{h}.ts) > c{h}.cut_us" for h in H)
    grid = ", ".join(f"({g!r}, {i})" for i, g in enumerate(config.GAMMA_GRID))
    parts.append(f"val AS ({vals})")
    parts.append(f"""gg AS (SELECT horizon_min, g.gamma, g.pos,
        avg(abs(CAST(y * capacity AS DOUBLE) - LEAST(GREATEST(CAST(occ_now AS DOUBLE) + CAST(g.gamma AS DOUBLE) * CAST(d AS DOUBLE),
            CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) * CAST(capacity AS DOUBLE))) AS mae_val, count(*) AS n_val
        FROM val, (VALUES {grid}) g(gamma, pos) GROUP BY horizon_min, g.gamma, g.pos)""")
    return ",\n".join(parts)


@register("gamma_grid", [("horizon_min", "i"), ("gamma", "q"), ("mae_val", "q"), ("n_val", "l"), ("is_best", "b")],
          with_(*FEATS, CUT_SQL, DT_SQL, _gamma_grid_sql()) + """SELECT {out} FROM (SELECT horizon_min, gamma, mae_val, n_val,
             row_number() OVER (PARTITION BY horizon_min ORDER BY mae_val, pos) = 1 AS is_best FROM gg) x""")
def gamma_grid(c):
    """Shrink factor per horizon on the validation tail of train (first of equal errors wins)."""
    from dockcast.plans.models import calibrate_gamma
    parts = []
    for h in H:
        clean = c.labelled_stored.where("is_train").dropna(subset=_clean_cols(h))
        parts.append(clean.select(F.lit(h).alias("horizon_min"), "ts", "occ_now", F.col("occ_delta_15").alias("delta"),
                                  "capacity", F.col(f"occ_{h}").alias("y_occ")))
    allv = parts[0]
    for p in parts[1:]:
        allv = allv.unionByName(p)
    # the three validation cuts (85% of each horizon's train time) in one grouped pass pair
    cuts = exact_quantile(allv, micros("ts"), config.SPLIT_TRAINVAL, width=60_000_000.0, out="_vcut", by=["horizon_min"])
    val = allv.join(F.broadcast(cuts.select("horizon_min", "_vcut")), "horizon_min").where(micros("ts") > F.col("_vcut"))
    return calibrate_gamma(val)
