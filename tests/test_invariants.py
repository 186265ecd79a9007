"""No look-ahead, repartition invariance, disjoint/exhaustive split, forecasts within capacity."""

import numpy as np
from pyspark.sql import functions as F

from dockcast.operators import features, panel, split
from dockcast.operators.sequence import Sequencer
from tests.helpers import close, make_panel

PAST = ([f"occ_lag_{k}" for k in (5, 10, 15, 30, 60)] + [f"occ_roll_{k}" for k in (15, 30, 60, 120, 180)]
        + [f"occ_delta_{k}" for k in (5, 15, 30, 60)] + ["occ_ema_fast", "occ_ema_slow"])


def _rows(seed, n=120):
    rng = np.random.default_rng(seed)
    return [(f"s{i % 3}", 5 * (i // 3), int(rng.integers(0, 20)), 20) for i in range(n)]


def _feat(spark, rows, parts=None):
    seq = Sequencer(order=("ts", "event_id"), strategy="key")
    df = make_panel(spark, rows)
    if parts:
        df = df.repartition(parts)
    out = features.build_features(panel.clean_panel(df, seq), seq, use_ema=True)
    return out.orderBy("station_id", "ts").toPandas()


def test_perturbing_the_future_leaves_past_features(spark):
    rows = _rows(1)
    cut_min = 5 * 25
    changed = [(s, m, (b + 7) % 20 if m > cut_min else b, c) for s, m, b, c in rows]
    a, b = _feat(spark, rows), _feat(spark, changed)
    past = a["ts"] <= a["ts"].min() + np.timedelta64(cut_min, "m")
    for c in PAST:
        assert close(a.loc[past, c], b.loc[past, c]), c


def test_repartition_invariance(spark):
    rows = _rows(2)
    a, b = _feat(spark, rows), _feat(spark, list(reversed(rows)), parts=7)
    for c in PAST + ["occ_15", "occ_60"]:
        assert close(a[c], b[c]), c


def test_split_disjoint_exhaustive_and_forecasts_bounded(spark):
    from dockcast.plans.models import reconstruct_bikes
    df = _feat(spark, _rows(3))
    sdf = spark.createDataFrame(df[["station_id", "ts", "occ", "capacity", "occ_delta_15"]])
    train, test = split.split_frames(sdf)
    n_tr, n_te = train.count(), test.count()
    assert n_tr + n_te == len(df) and train.join(test, ["station_id", "ts"]).count() == 0
    y = test.select(reconstruct_bikes(F.col("occ"), F.lit(3.0), F.col("occ_delta_15"), F.col("capacity")).alias("y"), "capacity")
    assert y.where((F.col("y") < 0) | (F.col("y") > F.col("capacity"))).count() == 0
