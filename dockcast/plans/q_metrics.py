"""Queries over errors and data quality: baselines, EMA, comparison, summaries, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockcast import config
from dockcast.operators import baselines, features, quality
from dockcast.plans.catalog import KEYS, register
from dockcast.plans.q_panel import BF_ALL, BF_SQL, CUT_SQL, MODEL_FEATURES, TARGETS
from dockcast.plans.q_weather import W5, WEATHER_HOURLY, WFILL, add_weather_sql
from dockcast.plans.sqltext import BASE, FEATS, STATION_TS, W, with_

H = config.HORIZONS
LONG = lambda m: [("horizon_min", "i"), (f"mae_{m}", "q"), ("n_rows", "l")]
TE = "te AS (SELECT feat.* FROM feat, cut WHERE epoch_us(feat.ts) > cut.cut_us)"


def _per_horizon(metric: str, cond: str, err: str, src: str) -> str:
    """UNION ALL of one aggregate row per horizon; ``{h}`` in cond/err is the horizon."""
    parts = []
    for h in H:
        c, e = cond.format(h=h), err.format(h=h)
        parts.append(f"SELECT {h} AS horizon_min, avg(CASE WHEN {c} THEN {e} END) AS mae_{metric}, "
                     f"count(CASE WHEN {c} THEN {e} END) AS n_rows FROM {src}")
    return " UNION ALL ".join(parts)


NAIVE_SQL = "naive AS (" + _per_horizon(
    "naive", "occ_{h} IS NOT NULL AND occ IS NOT NULL AND capacity IS NOT NULL",
    "abs(occ_{h} * capacity - occ * capacity)", "te") + ")"


@register("mae_naive", LONG("naive"), with_(*FEATS, CUT_SQL, TE, NAIVE_SQL) + "SELECT {out} FROM naive")
def mae_naive(c):
    """Flagship: MAE in bikes of the last-value forecast on the test split, per horizon."""
    return baselines.naive_mae(c.train_test(c.feat)[1])


_BFN = "bfn AS (SELECT * FROM bf WHERE " + " AND ".join(f"{x} IS NOT NULL" for x in BF_ALL) + ")"
_BCUT = "bcut AS (SELECT floor(quantile_cont(epoch_us(ts), 0.7)) AS cut_us FROM bfn)"
_BTE = "bte AS (SELECT bfn.* FROM bfn, bcut WHERE epoch_us(bfn.ts) > bcut.cut_us)"


@register("mae_naive_bikespace", LONG("naive"),
          with_(STATION_TS, BF_SQL, _BFN, _BCUT, _BTE) + "SELECT {out} FROM ("
          + _per_horizon("naive", "TRUE", "abs(y_{h} - bikes_available)", "bte") + ") x")
def mae_naive_bikespace(c):
    """Naive MAE in bikes on the fully defined bike-space frame (its own cut)."""
    return baselines.bikespace_naive_mae(features.build_bike_features(c.raw, c.seq))


_TGT = ("tgt AS (SELECT *, CAST(isodow(ts) - 1 AS TINYINT) AS dow, CAST(hour(ts) AS TINYINT) AS hour, "
        + ", ".join(f"CAST(lead(bikes_available, {config.steps(h)}) OVER ({W}) AS REAL) AS y_{h}" for h in H)
        + " FROM station_ts)")
_RCUT = "rcut AS (SELECT floor(quantile_cont(epoch_us(ts), 0.7)) AS cut_us FROM tgt)"
_MED = ("med AS (SELECT station_id, dow, hour, median(CAST(bikes_available AS DOUBLE)) AS pred_seasonal "
        "FROM (SELECT tgt.* FROM tgt, rcut WHERE epoch_us(tgt.ts) <= rcut.cut_us) t GROUP BY ALL)")
_SC = ("sc AS (SELECT t.*, m.pred_seasonal FROM (SELECT tgt.* FROM tgt, rcut WHERE epoch_us(tgt.ts) > rcut.cut_us) t "
       "LEFT JOIN med m ON t.station_id = m.station_id AND t.dow = m.dow AND t.hour = m.hour)")
SEASONAL_SQL = "seasonal AS (" + _per_horizon(
    "seasonal", "y_{h} IS NOT NULL AND pred_seasonal IS NOT NULL",
    "abs(CAST(y_{h} AS DOUBLE) - pred_seasonal)", "sc") + ")"


@register("seasonal_median", [("station_id", "s"), ("dow", "i"), ("hour", "i"), ("pred_seasonal", "q")],
          with_(STATION_TS, _TGT, _RCUT, _MED) + "SELECT {out} FROM med")
def seasonal_median(c):
    """Train median of bikes per (station, dow, hour) on the raw panel."""
    train, _ = _raw_split(c)
    return baselines.seasonal_median(train)


def _raw_split(c):
    from dockcast.operators import split
    return split.split_frames(c.raw, config.SPLIT_TRAINTEST, cut=c.raw_cut)


@register("mae_seasonal", LONG("seasonal"),
          with_(STATION_TS, _TGT, _RCUT, _MED, _SC, SEASONAL_SQL) + "SELECT {out} FROM seasonal")
def mae_seasonal(c):
    """Seasonal-median forecast error in bikes, rows where truth and median exist."""
    return baselines.seasonal_mae(features.with_targets_only(c.raw, "bikes_available", "y", c.seq), cut=c.raw_cut)


def _ema_rec(a: float, y: str, w: str, r: str = "r", e: str = "e") -> tuple[str, str]:
    """pandas ewm(adjust=False) step: the value carries over nulls while its weight decays."""
    A, B = f"CAST('{1 - a!r}' AS DOUBLE)", f"CAST('{a!r}' AS DOUBLE)"
    val = (f"CASE WHEN {r}.{y} IS NULL THEN {e}.x WHEN {e}.x IS NULL THEN {r}.{y} WHEN {e}.x = {r}.{y} THEN {r}.{y} "
           f"ELSE (({r}.{w} * {A}) * {r}.{y} + {B} * {e}.x) / (({r}.{w} * {A}) + {B}) END")
    wt = f"CASE WHEN {r}.{y} IS NULL THEN {r}.{w} WHEN {e}.x IS NULL THEN {r}.{w} * {A} ELSE CAST(1 AS DOUBLE) END"
    return val, wt


_fv, _fw = _ema_rec(config.EMA_FAST_ALPHA, "yf", "wf")
_sv, _sw = _ema_rec(config.EMA_SLOW_ALPHA, "ys", "ws")
EMA_SQL = f"""e0 AS (SELECT station_id, ts, event_id, row_number() OVER ({W}) AS rn,
                        CAST(lag(occ) OVER ({W}) AS DOUBLE) AS x FROM panel),
ema(station_id, rn, yf, wf, ys, ws) AS (
  SELECT station_id, rn, x, CAST(1 AS DOUBLE), x, CAST(1 AS DOUBLE) FROM e0 WHERE rn = 1
  UNION ALL
  SELECT e.station_id, e.rn, {_fv}, {_fw}, {_sv}, {_sw}
  FROM ema r JOIN e0 e ON e.station_id = r.station_id AND e.rn = r.rn + 1),
emaf AS (SELECT e0.station_id, e0.ts, e0.event_id, CAST(ema.yf AS REAL) AS occ_ema_fast, CAST(ema.ys AS REAL) AS occ_ema_slow,
                CAST(CAST(ema.yf AS REAL) - CAST(ema.ys AS REAL) AS REAL) AS occ_momentum
         FROM e0 JOIN ema ON e0.station_id = ema.station_id AND e0.rn = ema.rn)"""
with_recursive = lambda *ctes: "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


@register("occ_ema", KEYS + [("occ_ema_fast", "q"), ("occ_ema_slow", "q"), ("occ_momentum", "q")],
          with_recursive(*BASE, EMA_SQL) + "SELECT {out} FROM emaf")
def occ_ema(c):
    """EMA (alpha 0.5 / 0.1) of the previous occupancies and their difference."""
    return c.feat_ema


_EMA_TE = ("ete AS (SELECT f.*, m.occ_ema_fast FROM feat f JOIN emaf m ON f.station_id = m.station_id "
           "AND f.ts = m.ts AND f.event_id = m.event_id, cut WHERE epoch_us(f.ts) > cut.cut_us)")
EWMA_SQL = "ewma AS (" + _per_horizon(
    "ewma", "occ_{h} IS NOT NULL AND occ_ema_fast IS NOT NULL AND capacity IS NOT NULL",
    "abs(occ_{h} * capacity - occ_ema_fast * capacity)", "ete") + ")"


@register("mae_ewma", LONG("ewma"),
          with_recursive(*FEATS, CUT_SQL, EMA_SQL, _EMA_TE, EWMA_SQL) + "SELECT {out} FROM ewma")
def mae_ewma(c):
    """EWMA forecast (fast EMA of past occupancy) error in bikes on the test split."""
    return baselines.ewma_mae(c.train_test(c.feat_ema)[1])


@register("comparison_table", [("horizon_min", "i"), ("mae_naive", "q"), ("mae_seasonal", "q"), ("mae_ewma", "q")],
          with_recursive(*FEATS, CUT_SQL, TE, NAIVE_SQL, _TGT, _RCUT, _MED, _SC, SEASONAL_SQL, EMA_SQL, _EMA_TE, EWMA_SQL)
          + """SELECT {out} FROM (SELECT n.horizon_min, n.mae_naive, s.mae_seasonal, e.mae_ewma
               FROM naive n JOIN seasonal s ON n.horizon_min = s.horizon_min JOIN ewma e ON n.horizon_min = e.horizon_min) x""")
def comparison_table(c):
    """Horizon x method table of the baseline errors (pivot)."""
    both = baselines.naive_and_ewma_mae(c.train_test(c.feat_ema)[1])    # one feature + EMA pass, one aggregate
    seasonal = baselines.seasonal_mae(features.with_targets_only(c.raw, "bikes_available", "y", c.seq), cut=c.raw_cut)
    return both.join(F.broadcast(seasonal.select("horizon_min", "mae_seasonal")), "horizon_min")   # 3 rows each


@register("station_variance", [("station_id", "s"), ("var_bikes", "q")],
          with_(STATION_TS) + "SELECT {out} FROM (SELECT station_id, var_samp(CAST(bikes_available AS DOUBLE)) AS var_bikes "
          "FROM station_ts GROUP BY station_id) x")
def station_variance(c):
    return quality.station_variance(c.raw)


@register("dev_sample", KEYS,
          with_(STATION_TS) + """SELECT {out} FROM station_ts WHERE station_id IN (
             SELECT station_id FROM (SELECT station_id, var_samp(CAST(bikes_available AS DOUBLE)) AS v FROM station_ts GROUP BY station_id)
             ORDER BY v DESC NULLS LAST, station_id LIMIT 200)""")
def dev_sample(c):
    """Rows of the 200 most variable stations (top-k + semi join)."""
    return quality.dev_sample(c.raw, 200)


@register("dev_sample_quarter", KEYS,
          with_(STATION_TS) + """SELECT {out} FROM station_ts WHERE station_id IN (
             SELECT station_id FROM (SELECT station_id, var_samp(CAST(bikes_available AS DOUBLE)) AS v, count(*) OVER () // 4 AS k
                                     FROM station_ts GROUP BY station_id)
             QUALIFY row_number() OVER (ORDER BY v DESC NULLS LAST, station_id) <= k)""")
def dev_sample_quarter(c):
    """Rows of the most variable quarter of the stations, so that the sample leaves stations out at any scale."""
    return quality.dev_sample(c.raw, share=0.25)


@register("panel_counts", [("n_rows", "l"), ("n_stations", "l")],
          with_(*BASE) + "SELECT {out} FROM (SELECT count(*) AS n_rows, count(DISTINCT station_id) AS n_stations FROM panel) x")
def panel_counts(c):
    return quality.panel_counts(c.panel)


@register("occ_summary", [("occ_min", "q"), ("occ_mean", "q"), ("occ_median", "q"), ("occ_max", "q")],
          with_(*BASE) + "SELECT {out} FROM (SELECT min(occ) AS occ_min, avg(occ) AS occ_mean, "
          "median(CAST(occ AS DOUBLE)) AS occ_median, max(occ) AS occ_max FROM panel) x")
def occ_summary(c):
    return quality.occ_summary(c.panel)


NULL_COLS = [x for x in MODEL_FEATURES if x != "occ_now"] + TARGETS
_NULL_SQL = "nr AS (" + " UNION ALL ".join(
    f"SELECT '{x}' AS feature, avg(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) AS null_rate, "
    f"sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) AS n_null FROM feat" for x in NULL_COLS) + ")"


@register("null_rates", [("feature", "s"), ("null_rate", "q"), ("n_null", "l")],
          with_(*FEATS, _NULL_SQL) + "SELECT {out} FROM nr")
def null_rates(c):
    return quality.null_rates(c.feat, NULL_COLS)


@register("top_null_features", [("feature", "s"), ("null_rate", "q"), ("n_null", "l")],
          with_(*FEATS, _NULL_SQL) + "SELECT {out} FROM (SELECT * FROM nr ORDER BY null_rate DESC, feature LIMIT 5) x")
def top_null_features(c):
    return quality.top_null_features(c.feat, NULL_COLS, 5)


REQUIRED = ["ts", "station_id", "bikes_available", "capacity", "occ", "occ_now"]


def _qc_sql() -> str:
    rows = []
    for x in REQUIRED:
        if x == "occ_now":
            rows.append("SELECT 'occ_now' AS column_name, FALSE AS present, count(*) AS n_rows, count(*) AS n_null, 0 AS n_out_of_range FROM panel")
            continue
        bad = {"occ": "sum(CASE WHEN occ < 0 OR occ > 1 THEN 1 ELSE 0 END)",
               "capacity": "sum(CASE WHEN capacity <= 0 THEN 1 ELSE 0 END)"}.get(x, "0")
        rows.append(f"SELECT '{x}' AS column_name, TRUE AS present, count(*) AS n_rows, "
                    f"sum(CASE WHEN {x} IS NULL THEN 1 ELSE 0 END) AS n_null, {bad} AS n_out_of_range FROM panel")
    return " UNION ALL ".join(rows)


@register("quality_check", [("column_name", "s"), ("present", "b"), ("n_rows", "l"), ("n_null", "l"), ("n_out_of_range", "l")],
          with_(*BASE) + "SELECT {out} FROM (" + _qc_sql() + ") x")
def quality_check(c):
    """Required columns present, null counts and range violations in one pass."""
    return quality.quality_check(c.panel, REQUIRED)


@register("audit_sample", KEYS + [("capacity", "q"), ("y_true", "q"), ("y_naive", "q")],
          with_(*FEATS, CUT_SQL, TE) + """SELECT {out} FROM (SELECT station_id, ts, event_id, capacity,
             occ_30 * capacity AS y_true, occ * capacity AS y_naive FROM te
             WHERE occ_30 IS NOT NULL AND occ IS NOT NULL ORDER BY station_id, ts, event_id LIMIT 20) x""")
def audit_sample(c):
    """First 20 test rows: truth vs naive forecast at 30 minutes, in bikes."""
    te = c.train_test(c.feat)[1].where(F.col("occ_30").isNotNull() & F.col("occ").isNotNull())
    te = te.withColumns({"y_true": F.col("occ_30") * F.col("capacity"), "y_naive": F.col("occ") * F.col("capacity")})
    return quality.first_rows(te, 20, tiebreak=("event_id",))


SAMPLE_FEATURES = config.feature_list(use_ema=False, use_sta=False, use_weather=True)


@register("sample_feature_row", KEYS + [(x, "i" if x in ("dow", "is_weekend", "is_rain") else "q") for x in SAMPLE_FEATURES],
          with_(*FEATS, CUT_SQL, WEATHER_HOURLY, WFILL, W5, add_weather_sql("feat"))
          + "SELECT {out} FROM (SELECT aw.*, aw.occ AS occ_now FROM aw, cut WHERE epoch_us(aw.ts) > cut.cut_us) x WHERE "
          + " AND ".join(f"{x} IS NOT NULL" for x in SAMPLE_FEATURES) + " ORDER BY station_id, ts, event_id LIMIT 1")
def sample_feature_row(c):
    """First fully defined test row of the stored run's 26 features (weather on)."""
    te = c.train_test(c.with_weather(c.feat))[1].withColumn("occ_now", F.col("occ"))
    return quality.first_rows(te.dropna(subset=SAMPLE_FEATURES), 1, tiebreak=("event_id",))
