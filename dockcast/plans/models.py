"""Learning operators on DataFrames (MLlib): delta / direct GBT, ridge,
validation split, gamma calibration, reconstruction, batch scoring, importances.

Training data is materialised once in the shared checkpoint folder before the
iterative MLlib jobs, so every boosting round reads stored rows instead of
recomputing the feature plan, and a lost executor re-reads them.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import micros
from dockcast.operators.dims import materialise
from dockcast.operators.quantile import exact_quantile


def reconstruct_bikes(occ_now: Column, gamma: Column, delta: Column, capacity: Column) -> Column:
    """clip(occ_now + gamma * delta, 0, 1) * capacity, in double."""
    occ = F.least(F.greatest(occ_now.cast("double") + gamma.cast("double") * delta.cast("double"), F.lit(0.0)), F.lit(1.0))
    return occ * capacity.cast("double")


def required_columns(features, *horizons: int) -> list[str]:
    """Columns a row must have to train and score Δ models of these horizons, each once."""
    targets = [c for h in horizons for c in (f"occ_{h}", f"occ_delta_target_{h}")]
    return sorted({*features, *targets, "occ_now", "capacity"})


def with_validation_flag(clean: DataFrame, q: float = config.SPLIT_TRAINVAL, col: str = "is_val") -> DataFrame:
    cut = exact_quantile(clean, micros("ts"), q, out="_vcut", width=60_000_000.0).select("_vcut")
    return clean.crossJoin(F.broadcast(cut)).withColumn(col, micros("ts") > F.col("_vcut")).drop("_vcut")


def calibrate_gamma(val: DataFrame, grid=config.GAMMA_GRID) -> DataFrame:
    """MAE in bikes of each gamma on validation rows, and the best (first on ties).

    ``val``: horizon_min, occ_now, delta, capacity, y_occ.  All gammas are
    scored in one pass with conditional aggregates (no row expansion).
    """
    truth = (F.col("y_occ") * F.col("capacity")).cast("double")
    aggs = []
    for i, g in enumerate(grid):
        err = F.abs(truth - reconstruct_bikes(F.col("occ_now"), F.lit(float(g)), F.col("delta"), F.col("capacity")))
        aggs.append(F.avg(err).alias(f"m{i}"))
    per_h = val.groupBy("horizon_min").agg(F.count(F.lit(1)).alias("n_val"), *aggs)
    rows = [F.struct(F.lit(float(g)).alias("gamma"), F.lit(i).alias("pos"), F.col(f"m{i}").alias("mae_val"))
            for i, g in enumerate(grid)]
    long = per_h.select("horizon_min", "n_val", F.explode(F.array(*rows)).alias("_g")).select("horizon_min", "n_val", "_g.*")
    best = long.groupBy("horizon_min").agg(F.min_by("gamma", F.struct("mae_val", "pos")).alias("_best"))
    return (long.join(F.broadcast(best), "horizon_min")            # one row per horizon
                .withColumn("is_best", F.col("gamma") == F.col("_best")).drop("_best", "pos"))


def assemble(df: DataFrame, feat_cols, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(feat_cols), outputCol=out, handleInvalid="keep").transform(df)


def gbt(settings: dict, max_iter: int | None = None) -> GBTRegressor:
    """Boosted trees on ``features`` / ``label`` with one of the settings of ``config``."""
    return GBTRegressor(labelCol="label", featuresCol="features", lossType=settings["loss"],
                        maxIter=max_iter or settings["rounds"], stepSize=settings["step"],
                        subsamplingRate=settings["rows"], featureSubsetStrategy=settings["columns"],
                        minInstancesPerNode=settings["leaf"], maxDepth=config.GBT_MAX_DEPTH, seed=config.GBT_SEED)


def fit_patient(data: DataFrame, feat_cols, settings: dict, max_iter: int | None = None) -> tuple[GBTRegressionModel, int]:
    """The model of the best round on the validation rows, and that round.

    ``data`` has the feature columns, ``label`` (known) and ``is_val``.  Boosting ends
    ``patience`` rounds after the best one.  MLlib cannot go on from a model, but its round m
    draws with seed + m whatever the budget, so budgets of patience + 14 rounds, twice that and
    so on up to the full one find the same best round as one long run.  Without validation
    rows the whole budget is kept.
    """
    d = materialise(assemble(data, feat_cols).select("features", "label", "is_val"))      # read by every round
    train, val = d.where(~F.col("is_val")), d.where("is_val")
    est = gbt(settings, max_iter)
    budget, patience = est.getMaxIter(), settings["patience"]
    if val.isEmpty():
        return est.fit(train), budget
    n = min(patience + 14, budget)
    while True:
        model = est.copy({est.maxIter: n}).fit(train)
        best = stopped_round(model.evaluateEachIteration(val, settings["metric"]), patience)
        if n >= budget or best + patience <= n:
            break
        n = min(2 * n, budget)
    return (model if best == n else est.copy({est.maxIter: best}).fit(train)), best


def stopped_round(errors: list[float], patience: int) -> int:
    """1-based best round seen before ``patience`` rounds went by without a lower error (first of equals)."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_delta(train_clean: DataFrame, feat_cols, h: int, max_iter: int | None = None) -> GBTRegressionModel:
    """Δ-occupancy model for horizon h (L1 loss), early-stopped on the last 15% of train time."""
    d = with_validation_flag(train_clean).withColumn("label", F.col(f"occ_delta_target_{h}").cast("double"))
    return fit_patient(d, feat_cols, config.GBT_DELTA, max_iter)[0]


def mae_bikes_of_delta(model, frame: DataFrame, feat_cols, h: int, gamma: float = 1.0) -> DataFrame:
    p = model.transform(assemble(frame, feat_cols))
    y_hat = reconstruct_bikes(F.col("occ_now"), F.lit(float(gamma)), F.col("prediction"), F.col("capacity"))
    err = F.abs((F.col(f"occ_{h}") * F.col("capacity")).cast("double") - y_hat)
    return p.agg(F.avg(err).alias("mae_model"), F.count(F.lit(1)).alias("n_rows"))


def train_delta_gamma(train_clean: DataFrame, test_clean: DataFrame, feat_cols, h: int,
                      max_iter: int | None = None) -> dict:
    """Fit, calibrate gamma on validation, score test: the per-horizon training step."""
    flagged = materialise(with_validation_flag(train_clean).select(*required_columns(feat_cols, h), "is_val"))   # for fit and calibration
    d = flagged.withColumn("label", F.col(f"occ_delta_target_{h}").cast("double"))
    model, best_iter = fit_patient(d, feat_cols, config.GBT_DELTA, max_iter)
    val = flagged.where("is_val")
    scored = model.transform(assemble(val, feat_cols)).select(
        F.lit(h).alias("horizon_min"), "occ_now", F.col("prediction").alias("delta"), "capacity",
        F.col(f"occ_{h}").alias("y_occ"))
    cal = calibrate_gamma(scored).where("is_best").collect()      # ≤ one row per horizon
    gamma = float(cal[0]["gamma"]) if cal else 1.0
    m = mae_bikes_of_delta(model, test_clean, feat_cols, h, gamma).collect()[0]
    return {"horizon_min": h, "mae_model": m["mae_model"], "n_test": m["n_rows"],
            "best_iter": best_iter, "gamma": gamma, "model": model}


def fit_occ(train_clean: DataFrame, feat_cols, h: int, max_iter: int | None = None) -> GBTRegressionModel:
    """Direct occupancy model (squared loss, stopped by absolute error); predictions are clipped to [0, 1] when scored."""
    d = with_validation_flag(train_clean).withColumn("label", F.col(f"occ_{h}").cast("double"))
    return fit_patient(d, feat_cols, config.GBT_OCC, max_iter)[0]


def fit_bikes(train: DataFrame, feat_cols, label: str, key=("station_id", "ts"), max_iter: int | None = None) -> GBTRegressionModel:
    """Bike-space booster of one horizon, stopped on a tenth of the rows chosen by a hash of their key."""
    d = train.withColumns({"label": F.col(label).cast("double"), "is_val": F.pmod(F.xxhash64(*key), F.lit(10)) == 0})
    return fit_patient(d, feat_cols, config.GBT_BIKES, max_iter)[0]


def feature_importance(model, feat_cols) -> list[tuple[str, float]]:
    """(feature, importance) sorted descending; as long as the feature list."""
    imp = model.featureImportances.toArray()
    return sorted(zip(feat_cols, map(float, imp)), key=lambda t: (-t[1], t[0]))


def score_batch(frame: DataFrame, models: dict, feat_cols, gammas: dict) -> DataFrame:
    """Every horizon's forecast in bikes for each feature row (models applied in turn)."""
    d = assemble(frame, feat_cols)
    for h, m in models.items():
        d = m.copy().setPredictionCol(f"delta_{h}").transform(d)
        d = d.withColumn(f"pred_bikes_{h}", reconstruct_bikes(F.col("occ_now"), F.lit(float(gammas.get(str(h), 1.0) or 1.0)),
                                                              F.col(f"delta_{h}"), F.col("capacity")))
    return d.drop("features")
