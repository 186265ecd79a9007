"""Model queries (rows-only: learners have no SQL form).

The library's learners run the full round budgets with patience; so do the bike-space boosters here
(``gbt_multi``, ``comparison_learners``).  A round is a few Spark jobs however small the table, and three Δ learners with
their full budget (800 rounds, patience 50) did not finish in four minutes on 10,000 rows, so the
queries with those and the direct ones stop at ``ROUNDS``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast import config
from dockcast.operators import compare, features, gram, quality, split
from dockcast.plans import artifacts, experiment, models, scoring
from dockcast.plans.catalog import KEYS, register
from dockcast.plans.q_panel import BF_ALL, BF_SQL, MODEL_FEATURES, _clean_cols, _notnull
from dockcast.plans.sqltext import STATION_TS, with_
from dockcast.session import table_folder

ROUNDS = 8
H = config.HORIZONS
BIKE_X = list(config.BIKE_FEATURES)


def _split_clean(c, h):
    frame = c.labelled_stored
    return (frame.where("is_train").dropna(subset=_clean_cols(h)),
            frame.where(~F.col("is_train")).dropna(subset=_clean_cols(h)))


def _per_horizon(fit, c) -> list:
    """One result per horizon; the fits are independent, so their jobs run side by side."""
    c.labelled_stored                                                  # stored once, before the threads start
    return _side_by_side(fit)


def _side_by_side(fit) -> list:
    with ThreadPoolExecutor(max_workers=len(H)) as pool:
        return list(pool.map(fit, H))


@register("gbt_delta", [("horizon_min", "i"), ("mae_model", "q"), ("n_test", "l"), ("best_iter", "i"), ("gamma", "q")])
def gbt_delta(c):
    """Δ-occupancy GBT (L1) per horizon, early-stopped, gamma-calibrated, scored on test."""
    res = _per_horizon(lambda h: models.train_delta_gamma(*_split_clean(c, h), MODEL_FEATURES, h, ROUNDS), c)
    rows = [(h, r["mae_model"], int(r["n_test"]), r["best_iter"], r["gamma"]) for h, r in zip(H, res)]
    return c.spark.createDataFrame(rows, "horizon_min int, mae_model double, n_test long, best_iter int, gamma double")


@register("gbt_occ", [("horizon_min", "i"), ("mae_model", "q"), ("n_test", "l")])
def gbt_occ(c):
    """Direct occupancy GBT (squared loss) per horizon, prediction clipped to [0, 1]."""
    fitted = _per_horizon(lambda h: models.fit_occ(_split_clean(c, h)[0], MODEL_FEATURES, h, ROUNDS), c)
    parts = []
    for h, m in zip(H, fitted):
        p = m.transform(models.assemble(_split_clean(c, h)[1], MODEL_FEATURES))
        y_hat = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0)) * F.col("capacity").cast("double")
        err = F.abs((F.col(f"occ_{h}") * F.col("capacity")).cast("double") - y_hat)
        parts.append(p.agg(F.lit(h).alias("horizon_min"), F.avg(err).alias("mae_model"), F.count(F.lit(1)).alias("n_test")))
    return reduce(DataFrame.unionByName, parts)


def _bike_frames(c):
    from dockcast.operators.dims import materialise
    bf = materialise(features.build_bike_features(c.raw, c.seq).dropna())
    return split.split_frames(bf, config.SPLIT_TRAINTEST)


def _common_frames(c):
    """Train and test of the bike-space frame, and all readings up to its cut (the seasonal median learns from them)."""
    from dockcast.operators.dims import materialise
    bf = materialise(features.build_bike_features(c.raw, c.seq).dropna())
    cut = materialise(split.temporal_cut(bf, config.SPLIT_TRAINTEST))
    return *split.split_frames(bf, cut=cut), split.split_frames(c.raw, cut=cut)[0]


_BIKE_Y = [f"y_{h}" for h in H]


@register("ridge", [("horizon_min", "i"), ("mae_model", "q"), ("n_test", "l")])
def ridge(c):
    """Ridge (alpha 1, summed loss) of every horizon on the bike-space frame: one pass for all moments, one to score."""
    tr, te = _bike_frames(c)
    fitted = gram.ridge_solutions(gram.moments(tr, BIKE_X, _BIKE_Y), BIKE_X, _BIKE_Y)
    errors = [F.avg(F.abs(F.col(y).cast("double") - gram.linear(BIKE_X, *fitted[y]))).alias(f"e{h}") for h, y in zip(H, _BIKE_Y)]
    one = te.agg(F.count(F.lit(1)).alias("n_test"), *errors)
    rows = [F.struct(F.lit(h).alias("horizon_min"), F.col(f"e{h}").alias("mae_model"), F.col("n_test")) for h in H]
    return one.select(F.inline(F.array(*rows)))


def _moments_sql() -> str:
    pairs = gram.moment_pairs(BIKE_X, _BIKE_Y)
    x = lambda c: "CAST(1 AS DOUBLE)" if c == "1" else f"CAST({c} AS DOUBLE)"
    return "m AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, avg({x(a)} * {x(b)}) AS mean_product FROM tr" for a, b in pairs) + ")"


@register("ridge_moments", [("a", "s"), ("b", "s"), ("n", "l"), ("mean_product", "q")],
          with_(STATION_TS, BF_SQL, f"bfc AS (SELECT * FROM bf WHERE {_notnull(BF_ALL)})",
                "bcut AS (SELECT floor(quantile_cont(epoch_us(ts), 0.7)) AS cut_us FROM bfc)",
                "tr AS (SELECT bfc.* FROM bfc, bcut WHERE epoch_us(bfc.ts) <= bcut.cut_us)", _moments_sql()) + "SELECT {out} FROM m")
def ridge_moments(c):
    """Second moments of the bike-space inputs and targets on train: all that the ridge models are solved from."""
    return gram.moments(_bike_frames(c)[0], BIKE_X, _BIKE_Y)


@register("gbt_multi", [("horizon_min", "i"), ("mae_model", "q"), ("n_test", "l")])
def gbt_multi(c):
    """Histogram-boosting twin: one depth-6 GBT per horizon on the bike-space frame."""
    tr, te = _bike_frames(c)
    fitted = _side_by_side(lambda h: models.fit_bikes(tr, BIKE_X, f"y_{h}"))
    parts = []
    for h, m in zip(H, fitted):
        p = m.transform(models.assemble(te, BIKE_X))
        parts.append(p.agg(F.lit(h).alias("horizon_min"), F.avg(F.abs(F.col(f"y_{h}") - F.col("prediction"))).alias("mae_model"),
                           F.count(F.lit(1)).alias("n_test")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _constant(name: str) -> dict:
    """The same forecast column for every horizon."""
    return {h: F.col(name) for h in H}


_COMMON_SQL = ("med AS (SELECT station_id, dow, hour, median(CAST(bikes_available AS DOUBLE)) AS pred_seasonal FROM past GROUP BY ALL),\n"
               "te AS (SELECT b.*, m.pred_seasonal FROM bfc b CROSS JOIN bcut LEFT JOIN med m ON b.station_id = m.station_id AND b.dow = m.dow "
               "AND b.hour = m.hour WHERE epoch_us(b.ts) > bcut.cut_us AND m.pred_seasonal IS NOT NULL),\n"
               "cmp AS (" + " UNION ALL ".join(
                   f"SELECT {h} AS horizon_min, count(*) AS n_rows, avg(abs(CAST(y_{h} AS DOUBLE) - CAST(bikes_available AS DOUBLE))) AS mae_naive, "
                   f"avg(abs(CAST(y_{h} AS DOUBLE) - pred_seasonal)) AS mae_seasonal FROM te" for h in H) + ")")


@register("comparison_common", [("horizon_min", "i"), ("n_rows", "l"), ("mae_naive", "q"), ("mae_seasonal", "q")],
          with_(STATION_TS, BF_SQL, f"bfc AS (SELECT * FROM bf WHERE {_notnull(BF_ALL)})",
                "bcut AS (SELECT floor(quantile_cont(epoch_us(ts), 0.7)) AS cut_us FROM bfc)",
                "past AS (SELECT s.*, isodow(ts) - 1 AS dow, hour(ts) AS hour FROM station_ts s, bcut WHERE epoch_us(s.ts) <= bcut.cut_us)", _COMMON_SQL) + "SELECT {out} FROM cmp")
def comparison_common(c):
    """Last-value and seasonal-median errors on the same fully defined test rows."""
    _, te, past = _common_frames(c)
    return compare.common_errors(compare.with_seasonal(past, te), {"naive": _constant("bikes_available"), "seasonal": _constant("pred_seasonal")})


@register("comparison_learners", [("horizon_min", "i"), ("n_rows", "l")] + [(f"mae_{m}", "q") for m in ("naive", "seasonal", "ridge", "gbt")])
def comparison_learners(c):
    """Horizon x method errors of the baselines, ridge and the boosters, all on the same test rows."""
    tr, te, past = _common_frames(c)
    solved = gram.ridge_solutions(gram.moments(tr, BIKE_X, _BIKE_Y), BIKE_X, _BIKE_Y)
    fitted = _side_by_side(lambda h: models.fit_bikes(tr, BIKE_X, f"y_{h}"))
    scored = models.assemble(compare.with_seasonal(past, te), BIKE_X)
    for h, m in zip(H, fitted):
        scored = m.copy().setPredictionCol(f"gbt_{h}").transform(scored)
    return compare.common_errors(scored, {
        "naive": _constant("bikes_available"), "seasonal": _constant("pred_seasonal"),
        "ridge": {h: gram.linear(BIKE_X, *solved[y]) for h, y in zip(H, _BIKE_Y)}, "gbt": {h: F.col(f"gbt_{h}") for h in H}})


@register("audit_model", KEYS + [("bikes_available", "q"), ("capacity", "q"), ("y_true", "q"), ("y_hat", "q"), ("gamma", "q")])
def audit_model(c):
    """First 20 test rows: truth against the calibrated 30-minute Δ model's forecast, in bikes."""
    h = 30
    tr, te = _split_clean(c, h)
    done = models.train_delta_gamma(tr, te, MODEL_FEATURES, h, ROUNDS)
    first = quality.first_rows(te, 20, tiebreak=("event_id",))
    scored = models.score_batch(first, {h: done["model"]}, MODEL_FEATURES, {str(h): done["gamma"]})
    return scored.withColumns({"y_true": F.col(f"occ_{h}") * F.col("capacity"), "y_hat": F.col(f"pred_bikes_{h}"), "gamma": F.lit(done["gamma"])})


@register("score_batch", KEYS + [(f"pred_bikes_{h}", "q") for h in H])
def score_batch(c):
    """Every test feature row scored by the three Δ models with their calibrated gammas (forecasts in bikes)."""
    done = _per_horizon(lambda h: models.train_delta_gamma(*_split_clean(c, h), MODEL_FEATURES, h, ROUNDS), c)
    fitted, gammas = {r["horizon_min"]: r["model"] for r in done}, {str(r["horizon_min"]): r["gamma"] for r in done}
    te = c.labelled_stored.where(~F.col("is_train")).dropna(subset=MODEL_FEATURES)
    return models.score_batch(te, fitted, MODEL_FEATURES, gammas)


@register("feature_importance", [("rank", "i"), ("feature", "s"), ("importance", "q")])
def feature_importance(c):
    """Top-10 feature importances of the 30-minute Δ model."""
    tr, _ = _split_clean(c, 30)
    m = models.fit_delta(tr, MODEL_FEATURES, 30, ROUNDS)
    top = models.feature_importance(m, MODEL_FEATURES)[:10]          # as long as the feature list
    return c.spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(top)], "rank int, feature string, importance double")


@register("experiment", [("horizon_min", "i"), ("mae_naive", "q"), ("mae_model", "q"), ("best_iter", "i"), ("gamma", "q")])
def experiment_q(c):
    """The whole training run with weather, as the stored artifacts were produced."""
    return experiment.run(c.spark, c.raw, c.seq, weather_hourly=c.weather_hourly, max_iter=ROUNDS)


@register("score_requests_models", [("station_id", "s"), ("ts", "t"), ("horizon_min", "i"), ("predicted_bikes", "q"), ("delta_model", "q")])
def score_requests_models(c):
    """Every request scored by the models of a training run that was saved and loaded again."""
    folder = table_folder(c.spark)
    experiment.run(c.spark, c.raw, c.seq, weather_hourly=c.weather_hourly, max_iter=ROUNDS, out_dir=folder)
    return artifacts.score_requests(c.long_requests, artifacts.load_artifacts(c.spark, folder),
                                    scoring.current_weather(c.weather_hourly))
