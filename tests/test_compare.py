import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from dockcast.operators import compare

SF = "/root/testdata/sf0.01"


def test_methods_are_scored_on_common_rows(spark):
    rows = [(1.0, 2.0, 5.0, 4.0), (3.0, None, 3.0, 9.0), (None, 1.0, 1.0, 1.0), (6.0, 6.0, None, 8.0)]
    d = spark.createDataFrame(rows, "y_15 double, a double, b double, y_30 double")
    out = compare.common_errors(d, {"a": {15: F.col("a"), 30: F.lit(0.0)}, "b": {15: F.col("b"), 30: F.col("y_30")}}, horizons=(15, 30)).collect()
    assert [tuple(r) for r in out] == [(15, 1, 1.0, 4.0), (30, 4, 5.5, 0.0)]
    assert [tuple(r) for r in compare.common_errors(d.where("false"), {"a": {15: F.col("a")}}, horizons=(15,)).collect()] == [(15, 0, None)]


def test_seasonal_median_of_the_past(spark):
    monday = dt.datetime(2024, 1, 1, 8)
    schema = "station_id string, ts timestamp_ntz, bikes_available float"
    past = spark.createDataFrame([("a", monday, 2.0), ("a", monday.replace(minute=30), 4.0), ("a", monday.replace(hour=9), 50.0)], schema)
    test = spark.createDataFrame([("a", monday.replace(day=8), 1.0), ("a", monday.replace(day=9), 1.0), ("b", monday.replace(day=8), 1.0)], schema)
    got = {(r.station_id, r.ts.day): r.pred_seasonal for r in compare.with_seasonal(past, test).collect()}
    assert got == {("a", 8): 3.0, ("a", 9): None, ("b", 8): None}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_learners_and_baselines_share_their_rows(spark):
    from dockcast.plans.registry import queries
    q = queries()
    common = {r.horizon_min: r for r in q["comparison_common"](spark, SF).collect()}
    every = {r.horizon_min: r for r in q["comparison_learners"](spark, SF).collect()}
    assert set(common) == set(every) == {15, 30, 60}
    for h, r in common.items():
        e = every[h]
        assert (e.n_rows, e.mae_naive, e.mae_seasonal) == (r.n_rows, r.mae_naive, r.mae_seasonal) and r.n_rows > 0
        assert 0 < e.mae_ridge < e.mae_naive and 0 < e.mae_gbt < e.mae_naive
