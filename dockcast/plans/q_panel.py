"""Queries over the panel: scan, cleaning, calendar and window features,
split, delta targets, null filters and station encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import calendar_columns, occupancy_serving
from dockcast.operators import encode, features
from dockcast.plans.catalog import KEYS, register
from dockcast.plans.models import required_columns
from dockcast.plans.sqltext import BASE, FEATS, FILLED, STATION_TS, W, calendar_sql, with_

H = config.HORIZONS
LAGS = [f"occ_lag_{k * config.FREQ_MIN}" for k in config.LAG_STEPS]
ROLLS = [f"occ_roll_{k * config.FREQ_MIN}" for k in config.ROLL_STEPS]
DELTAS = [f"occ_delta_{k * config.FREQ_MIN}" for k in config.DELTA_STEPS]
TARGETS = [f"occ_{h}" for h in H]
CAL = [("hour", "i"), ("dow", "i"), ("is_weekend", "i"), ("hour_sin", "q"), ("hour_cos", "q"),
       ("hour_sin2", "q"), ("hour_cos2", "q")]
CUT_SQL = "cut AS (SELECT count(*) AS n_rows, floor(quantile_cont(epoch_us(ts), 0.7)) AS cut_us FROM panel)"
# split-aware delta targets the way the original computes them: a lead inside each split
DT_SQL = ("dt AS (SELECT *, occ AS occ_now, " + ", ".join(
    f"CAST(lead(occ, {config.steps(h)}) OVER (PARTITION BY is_train, station_id ORDER BY ts, event_id) - occ AS REAL) "
    f"AS occ_delta_target_{h}" for h in H)
    + " FROM (SELECT feat.*, epoch_us(feat.ts) <= cut.cut_us AS is_train FROM feat, cut) x)")
MODEL_FEATURES = config.feature_list(use_ema=False, use_sta=False)


def _notnull(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


@register("panel_scan", KEYS + [("bikes_available", "q"), ("capacity", "q")],
          with_(STATION_TS) + "SELECT {out} FROM station_ts")
def panel_scan(c):
    """Panel rows with declared types (station string, float bikes/capacity)."""
    return c.raw


@register("capacity_clean", KEYS + [("capacity", "q")],
          with_(STATION_TS, FILLED) + "SELECT {out} FROM filled WHERE capacity > 0")
def capacity_clean(c):
    """Capacity forward/back filled per station; non-positive or unknown dropped."""
    return c.panel


@register("occupancy", KEYS + [("bikes_available", "q"), ("capacity", "q"), ("occ", "q")],
          with_(*BASE) + "SELECT {out} FROM panel")
def occupancy(c):
    """occ = clip(bikes / capacity, 0, 1), null bikes stay null."""
    return c.panel


@register("occupancy_serving", KEYS + [("occ_serving", "q")],
          with_(STATION_TS) + """SELECT {out} FROM (SELECT *, CASE WHEN capacity > 0 THEN COALESCE(
              LEAST(GREATEST(CAST(bikes_available AS DOUBLE) / CAST(capacity AS DOUBLE), CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)),
              CAST(0 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END AS occ_serving FROM station_ts) x""")
def occupancy_serving_q(c):
    """Serving twin of occupancy: missing / non-positive capacity gives 0."""
    return c.raw.withColumn("occ_serving", occupancy_serving(F.col("bikes_available"), F.col("capacity")))


@register("calendar_features", KEYS + CAL,
          with_(STATION_TS) + f"SELECT {{out}} FROM (SELECT *, {calendar_sql()} FROM station_ts) x")
def calendar_features(c):
    """hour, Monday-based day of week, weekend flag, 24 h and 12 h harmonics."""
    return c.raw.withColumns(calendar_columns(F.col("ts")))


_FEAT_SQL = with_(*FEATS) + "SELECT {out} FROM feat"


@register("occ_features", KEYS + [("occ", "q")] + CAL + [(x, "q") for x in LAGS + ROLLS + DELTAS + TARGETS]
          + [(f"ts_{h}", "t") for h in H], _FEAT_SQL)
def occ_features(c):
    """The whole feature frame (flagship): calendar, lags, rolling means, deltas, targets."""
    return c.feat


@register("occ_lags", KEYS + [(x, "q") for x in LAGS], _FEAT_SQL)
def occ_lags(c):
    return c.feat


@register("occ_rolling", KEYS + [(x, "q") for x in ROLLS], _FEAT_SQL)
def occ_rolling(c):
    """Means of the k previous rows, null unless all k exist (never across stations)."""
    return c.feat


@register("occ_deltas", KEYS + [(x, "q") for x in DELTAS], _FEAT_SQL)
def occ_deltas(c):
    return c.feat


@register("occ_targets", KEYS + [(x, "q") for x in TARGETS] + [(f"ts_{h}", "t") for h in H], _FEAT_SQL)
def occ_targets(c):
    """Future occupancy 15/30/60 minutes (3/6/12 rows) ahead, on the unsplit frame."""
    return c.feat


@register("temporal_cut", [("n_rows", "l"), ("cut_us", "l"), ("cut_ts", "t")],
          with_(*BASE, CUT_SQL) + "SELECT {out} FROM (SELECT n_rows, CAST(cut_us AS BIGINT) AS cut_us, "
          "make_timestamp(CAST(cut_us AS BIGINT)) AS cut_ts FROM cut) x")
def temporal_cut(c):
    """Exact 70% quantile of ts (linear interpolation), as the split point."""
    return c.cut


@register("split_train", KEYS + [("occ", "q")],
          with_(*FEATS, CUT_SQL) + "SELECT {out} FROM (SELECT feat.* FROM feat, cut WHERE epoch_us(feat.ts) <= cut.cut_us) x")
def split_train(c):
    return c.train_test(c.feat)[0]


@register("split_test", KEYS + [("occ", "q")],
          with_(*FEATS, CUT_SQL) + "SELECT {out} FROM (SELECT feat.* FROM feat, cut WHERE epoch_us(feat.ts) > cut.cut_us) x")
def split_test(c):
    return c.train_test(c.feat)[1]


@register("delta_targets", KEYS + [("is_train", "b")] + [(f"occ_delta_target_{h}", "q") for h in H],
          with_(*FEATS, CUT_SQL, DT_SQL) + "SELECT {out} FROM dt")
def delta_targets(c):
    """occ(t+h) - occ(t) inside each split (the last rows of a station's train part get none)."""
    return c.labelled


def _clean_cols(h: int) -> list[str]:
    return required_columns(MODEL_FEATURES, h)


_ALL_CLEAN = required_columns(MODEL_FEATURES, *H)


def _long_horizons(c, ok, columns):
    """A row per horizon and row of the labelled frame that is fully defined for it: one read for all horizons."""
    rows = [F.when(ok(h), F.struct(F.lit(h).alias("horizon_min"), *columns(h))) for h in H]
    return c.labelled.withColumn("_h", F.explode(F.array_compact(F.array(*rows))))


def _defined(h: int):
    out = F.lit(True)
    for x in _clean_cols(h):
        out = out & F.col(x).isNotNull()
    return out


def _per_horizon_sql(columns, where) -> str:
    return " UNION ALL ".join(f"SELECT station_id, ts, event_id, is_train, {h} AS horizon_min, {columns(h)} FROM dt WHERE {where(h)}" for h in H)


@register("clean_horizon", KEYS + [("horizon_min", "i"), ("is_train", "b"), ("y_occ", "q"), ("y_delta", "q")],
          with_(*FEATS, CUT_SQL, DT_SQL) + "SELECT {out} FROM ("
          + _per_horizon_sql(lambda h: f"occ_{h} AS y_occ, occ_delta_target_{h} AS y_delta", lambda h: _notnull(_clean_cols(h))) + ") x")
def clean_horizon(c):
    """Rows fully defined for the model of each horizon (features, target, anchor, capacity)."""
    d = _long_horizons(c, _defined, lambda h: [F.col(f"occ_{h}").alias("y_occ"), F.col(f"occ_delta_target_{h}").alias("y_delta")])
    return d.select(*[k for k, _ in KEYS], "is_train", "_h.*")


@register("clean_all_horizons", KEYS + [("is_train", "b")],
          with_(*FEATS, CUT_SQL, DT_SQL) + f"SELECT {{out}} FROM dt WHERE {_notnull(_ALL_CLEAN)}")
def clean_all_horizons(c):
    return c.labelled.dropna(subset=_ALL_CLEAN)


@register("feature_matrix", KEYS + [("horizon_min", "i")] + [(x, "q") for x in MODEL_FEATURES] + [("y_delta", "q")],
          with_(*FEATS, CUT_SQL, DT_SQL) + "SELECT {out} FROM ("
          + _per_horizon_sql(lambda h: ", ".join(MODEL_FEATURES) + f", occ_delta_target_{h} AS y_delta", lambda h: f"is_train AND {_notnull(_clean_cols(h))}") + ") x")
def feature_matrix(c):
    """Ordered model inputs + label of each horizon's train matrix (what the assembler reads)."""
    d = _long_horizons(c, lambda h: F.col("is_train") & _defined(h), lambda h: [F.col(f"occ_delta_target_{h}").alias("y_delta")])
    return d.select(*[k for k, _ in KEYS], *MODEL_FEATURES, "_h.*")


_TRAIN = "(SELECT panel.* FROM panel, cut WHERE epoch_us(panel.ts) <= cut.cut_us)"
_MEAN_SQL = f"smean AS (SELECT station_id, avg(occ) AS sta_mean_occ FROM {_TRAIN} t GROUP BY station_id)"
_HDH_SQL = (f"shdh AS (SELECT station_id, CAST(isodow(ts) - 1 AS TINYINT) AS dow, CAST(hour(ts) AS TINYINT) AS hour, "
            f"median(CAST(occ AS DOUBLE)) AS sta_hdh_occ FROM {_TRAIN} t GROUP BY ALL)")


@register("station_mean", [("station_id", "s"), ("sta_mean_occ", "q")],
          with_(*BASE, CUT_SQL, _MEAN_SQL) + "SELECT {out} FROM smean")
def station_mean(c):
    """Mean occupancy per station on the train split."""
    return c.encodings[0]


@register("station_hour_median", [("station_id", "s"), ("dow", "i"), ("hour", "i"), ("sta_hdh_occ", "q")],
          with_(*BASE, CUT_SQL, _HDH_SQL) + "SELECT {out} FROM shdh")
def station_hour_median(c):
    """Exact median occupancy per (station, dow, hour) on the train split."""
    return c.encodings[1]


@register("station_encodings", KEYS + [("sta_mean_occ", "q"), ("sta_hdh_occ", "q")],
          with_(*FEATS, CUT_SQL, _MEAN_SQL, _HDH_SQL) + """SELECT {out} FROM (
            SELECT f.station_id, f.ts, f.event_id, m.sta_mean_occ, COALESCE(h.sta_hdh_occ, m.sta_mean_occ) AS sta_hdh_occ
            FROM feat f LEFT JOIN smean m ON f.station_id = m.station_id
            LEFT JOIN shdh h ON f.station_id = h.station_id AND f.dow = h.dow AND f.hour = h.hour) x""")
def station_encodings(c):
    """Train-only encodings joined to every row; missing hour medians fall back to the mean."""
    return encode.apply(c.feat, c.encodings)


BIKE_COLS = ([f"lag_{k * config.FREQ_MIN}" for k in config.LAG_STEPS] + ["roll_mean_60", "delta_5"]
             + [f"y_{h}" for h in H])


def _bike_sql() -> str:
    b = "bikes_available"
    parts = [f"CAST(lag({b}, {k}) OVER ({W}) AS REAL) AS lag_{k * config.FREQ_MIN}" for k in config.LAG_STEPS]
    fr = f"{W} ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING"
    parts.append(f"CAST(CASE WHEN count({b}) OVER ({fr}) = 12 THEN avg({b}) OVER ({fr}) END AS REAL) AS roll_mean_60")
    parts.append(f"CAST({b} - lag({b}, 1) OVER ({W}) AS REAL) AS delta_5")
    parts += [f"CAST(lead({b}, {config.steps(h)}) OVER ({W}) AS REAL) AS y_{h}" for h in H]
    h = "CAST(hour(ts) AS DOUBLE)"
    cal = (f"CAST(hour(ts) AS TINYINT) AS hour, CAST(isodow(ts) - 1 AS TINYINT) AS dow, "
           f"CAST(sin(2*pi()*{h}/24) AS REAL) AS hour_sin, CAST(cos(2*pi()*{h}/24) AS REAL) AS hour_cos")
    return f"bf AS (SELECT *, {cal}, {', '.join(parts)} FROM station_ts)"


BF_SQL = _bike_sql()
BF_ALL = ["station_id", "ts", "event_id", "bikes_available", "capacity", "hour", "dow", "hour_sin", "hour_cos"] + BIKE_COLS


@register("bikes_features", KEYS + [("bikes_available", "q")] + [(x, "q") for x in BIKE_COLS],
          with_(STATION_TS, BF_SQL) + "SELECT {out} FROM bf")
def bikes_features(c):
    """Bike-space twin: lags, 1 h rolling mean, 5-min delta, future bikes (raw panel)."""
    return features.build_bike_features(c.raw, c.seq)


@register("dropna_all", KEYS + [("bikes_available", "q"), ("roll_mean_60", "q"), ("y_60", "q")],
          with_(STATION_TS, BF_SQL) + f"SELECT {{out}} FROM bf WHERE {_notnull(BF_ALL)}")
def dropna_all(c):
    """Rows of the bike-space frame with no null in any column."""
    return features.build_bike_features(c.raw, c.seq).dropna()


@register("panel_gaps", [("station_id", "s"), ("first_tick", "t"), ("last_tick", "t"), ("n_expected", "l"),
                         ("n_present", "l"), ("n_missing", "l")],
          with_(*BASE) + """SELECT {out} FROM (SELECT station_id, min(tick) AS first_tick, max(tick) AS last_tick,
             (epoch_us(max(tick)) - epoch_us(min(tick))) // 300000000 + 1 AS n_expected, count(DISTINCT tick) AS n_present,
             (epoch_us(max(tick)) - epoch_us(min(tick))) // 300000000 + 1 - count(DISTINCT tick) AS n_missing
             FROM (SELECT station_id, make_timestamp(epoch_us(ts) - epoch_us(ts) % 300000000) AS tick FROM panel) t
             GROUP BY station_id) x""")
def panel_gaps(c):
    """Per station: expected vs present 5-minute ticks (row lags mean minutes only without gaps)."""
    from dockcast.operators.grid import gap_report
    return gap_report(c.panel)


@register("missing_ticks", [("station_id", "s"), ("day", "t"), ("n_missing", "l"), ("first_missing", "t")],
          with_(*BASE) + """SELECT {out} FROM (
            SELECT station_id, date_trunc('day', tick) AS day, count(*) AS n_missing, min(tick) AS first_missing FROM (
              SELECT station_id, unnest(generate_series(min(tick), max(tick), INTERVAL 5 MINUTES)) AS tick
              FROM (SELECT station_id, make_timestamp(epoch_us(ts) - epoch_us(ts) % 300000000) AS tick FROM panel) t GROUP BY station_id
            ) g WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.station_id = g.station_id
                                  AND make_timestamp(epoch_us(p.ts) - epoch_us(p.ts) % 300000000) = g.tick)
            GROUP BY ALL) x""")
def missing_ticks(c):
    """Grid ticks without a reading, counted per station and day, with the day's first."""
    from dockcast.operators.grid import missing_ticks as missing
    return missing(c.panel).groupBy("station_id", "day").agg(
        F.count(F.lit(1)).alias("n_missing"), F.min("tick").alias("first_missing"))


_TLAGS = [k * config.FREQ_MIN for k in config.LAG_STEPS]
_TROLLS = [k * config.FREQ_MIN for k in config.ROLL_STEPS]
_TSQL = ", ".join([f"max(occ) OVER (PARTITION BY station_id ORDER BY ts RANGE BETWEEN INTERVAL {m} MINUTES PRECEDING AND INTERVAL {m} MINUTES PRECEDING) "
                   f"AS occ_tlag_{m}" for m in _TLAGS]
                  + [f"{fn}(occ) OVER (PARTITION BY station_id ORDER BY ts RANGE BETWEEN INTERVAL {m} MINUTES PRECEDING AND INTERVAL 1 SECOND PRECEDING) "
                     f"AS occ_t{name}_{m}" for m in _TROLLS for fn, name in (("avg", "mean"), ("count", "count"))])


@register("occ_lags_time", [("station_id", "s"), ("ts", "t"), ("occ", "q")] + [(f"occ_tlag_{m}", "q") for m in _TLAGS]
          + [x for m in _TROLLS for x in ((f"occ_tmean_{m}", "q"), (f"occ_tcount_{m}", "l"))],
          with_(*BASE, """grid AS (SELECT station_id, make_timestamp(epoch_us(ts) - epoch_us(ts) % 300000000) AS ts,
            arg_max({'o': occ}, {'ts': panel.ts, 'id': event_id}).o AS occ FROM panel GROUP BY 1, 2)""")
          + f"SELECT {{out}} FROM (SELECT *, {_TSQL} FROM grid) x")
def occ_lags_time(c):
    """Lags and means by time over the 5-minute grid: minutes, not rows, whatever is missing."""
    from dockcast.operators.timewindow import on_grid, time_lags
    return time_lags(on_grid(c.panel))
