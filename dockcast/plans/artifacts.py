"""Saved training runs: models, feature order and gammas written together, loaded and scored.

A folder holds ``model_h<minutes>`` per horizon and ``config`` (one JSON row with the
horizons, the ordered feature list and the gamma of each horizon).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession

from dockcast import config
from dockcast.plans import models, scoring
from dockcast.sources import sinks


@dataclass(frozen=True)
class Artifacts:
    """Δ model per horizon, the column order they were trained on, gamma per horizon (key: minutes as text)."""
    models: dict[int, GBTRegressionModel]
    feat_cols: list[str]
    gammas: dict[str, float]


def save_artifacts(spark: SparkSession, out_dir: str, art: Artifacts) -> None:
    for h, m in art.models.items():
        m.write().overwrite().save(f"{out_dir}/model_h{h}")
    cfg = {"freq_min": config.FREQ_MIN, "horizons": list(art.models), "split_train_test": config.SPLIT_TRAINTEST,
           "split_train_val": config.SPLIT_TRAINVAL, "gammas": art.gammas}
    sinks.write_config(spark, f"{out_dir}/config", cfg, art.feat_cols)


def load_artifacts(spark: SparkSession, out_dir: str) -> Artifacts:
    """What ``save_artifacts`` wrote; a missing model or config is an error."""
    cfg = sinks.read_config(spark, f"{out_dir}/config")
    fitted = {int(h): GBTRegressionModel.load(f"{out_dir}/model_h{h}") for h in cfg["horizons"]}
    return Artifacts(fitted, list(cfg["feature_cols"]), dict(cfg["gammas"]))


def score_frame(frame: DataFrame, art: Artifacts) -> DataFrame:
    """Forecasts in bikes of every feature row, all horizons."""
    return models.score_batch(frame, art.models, art.feat_cols, art.gammas)


def score_requests(req: DataFrame, art: Artifacts, weather_row: DataFrame | None = None, requested: str | None = None,
                   mode: str = "consistent", long: bool = True) -> DataFrame:
    """Requests to forecasts: history features, current weather, model order, models, gammas, bikes.

    ``requested`` names an array column of wanted horizons; those without a model are left out,
    and a null means all.  A request with null bikes gets a null forecast.
    """
    d = scoring.history_features(req, mode)
    if weather_row is not None:
        d = scoring.with_weather(d, weather_row)
    keep = ("station_id", "ts", "bikes_available") + ((requested,) if requested else ())
    al = models.assemble(scoring.align(d, art.feat_cols, keep), art.feat_cols)
    delta_cols = {}
    for h, m in art.models.items():
        delta_cols[h] = f"_delta_{h}"
        al = m.copy().setPredictionCol(delta_cols[h]).transform(al)
    out = scoring.predict(al.drop("features"), delta_cols, art.gammas, requested=requested, long=long)
    return out.drop(*delta_cols.values())
