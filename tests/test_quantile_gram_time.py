"""Exact grouped order statistics, moments and ridge in one pass, windows over time."""

import datetime as dt
import random

import numpy as np
import pytest

from dockcast.operators import gram, quantile
from dockcast.operators.quantile import grouped_quantile
from dockcast.operators.timewindow import on_grid, time_lags


@pytest.mark.parametrize("q", [0.5, 0.0, 0.9, 1.0])
@pytest.mark.parametrize("most", [1 << 20, 3])
def test_grouped_quantile_on_continuous_and_tied_values(spark, monkeypatch, q, most):
    monkeypatch.setattr(quantile, "RANGES", 4)
    rng = random.Random(1)
    rows = [("hot", rng.gauss(0, 1) * 10 ** rng.randrange(-3, 9)) for _ in range(900)]
    rows += [("tied", float(rng.randrange(3))) for _ in range(101)] + [("pair", 1.0), ("pair", 2.0), ("one", -0.5), ("none", None)]
    rows += [(None, v) for v in (3.0, 1.0, None, 1e300, -1e300)] + [("near", 1.0 + i * 2.0 ** -52) for i in range(8)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r.k: r.m for r in grouped_quantile(df, ["k"], "v", q, "m", max_distinct=most).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        xs = [v for g, v in rows if g == k and v is not None]
        want[k] = float(np.quantile(xs, q)) if xs else None
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k] is None) if v is None else np.isclose(got[k], v, rtol=1e-12, atol=0), (k, got[k], v)


def test_grouped_quantile_of_nothing(spark):
    assert grouped_quantile(spark.createDataFrame([], "k string, v double"), ["k"], "v").collect() == []


def test_ridge_of_all_targets_from_one_table_of_moments(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 3)) * [1, 30, 0.1] + [0, 40, 2]
    Y = X @ rng.normal(size=(3, 2)) + [3.0, -1.0] + rng.normal(scale=0.3, size=(300, 2))
    df = spark.createDataFrame([tuple(map(float, [*a, *b])) for a, b in zip(X, Y)], "a double, b double, c double, y double, z double").repartition(3)
    table = gram.moments(df, ["a", "b", "c"], ["y", "z"])
    fitted = gram.ridge_solutions(table, ["a", "b", "c"], ["y", "z"], alpha=10.0)
    Xc = X - X.mean(0)
    for j, name in enumerate(["y", "z"]):
        w = np.linalg.solve(Xc.T @ Xc + 10.0 * np.eye(3), Xc.T @ (Y[:, j] - Y[:, j].mean()))
        b = Y[:, j].mean() - X.mean(0) @ w
        assert np.allclose(fitted[name][0], w, atol=1e-9) and abs(fitted[name][1] - b) < 1e-9
        got = sorted(r[0] for r in df.select(gram.linear(["a", "b", "c"], *fitted[name])).collect())
        assert np.allclose(got, sorted(X @ w + b))
    empty = gram.ridge_solutions(gram.moments(df.limit(0), ["a"], ["y"]), ["a"], ["y"])
    assert empty["y"][1] == 0.0 and not empty["y"][0].any()


@pytest.mark.parametrize("chunk", [86_400, 600])
def test_time_lags_mean_minutes_where_rows_are_missing(spark, chunk):
    base = dt.datetime(2024, 1, 1, 21)
    rng = random.Random(4)
    rows = [(s, base + dt.timedelta(minutes=5 * i + rng.choice([0, 1, 4])), i, None if rng.random() < 0.1 else rng.random())
            for s in "ab" for i in range(120) if rng.random() < 0.7]
    rows += [("a", base + dt.timedelta(minutes=4, seconds=59), 999, 0.25), ("a", base + dt.timedelta(minutes=4, seconds=59), 1000, 0.5)]
    panel = spark.createDataFrame(rows, "station_id string, ts timestamp_ntz, event_id long, occ double").repartition(3)
    grid = on_grid(panel)
    ticks = {}
    for s, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        ticks[s, t - dt.timedelta(minutes=t.minute % 5, seconds=t.second)] = v
    got = time_lags(grid, chunk_seconds=chunk).collect()
    assert {(r.station_id, r.ts): r.occ for r in got} == ticks and len(got) == len(ticks)
    for r in got:
        for m in (5, 10, 15, 30, 60):
            assert r[f"occ_tlag_{m}"] == ticks.get((r.station_id, r.ts - dt.timedelta(minutes=m)))
        for m in (15, 30, 60, 120, 180):
            known = [v for j in range(1, m // 5 + 1) if (v := ticks.get((r.station_id, r.ts - dt.timedelta(minutes=5 * j)))) is not None]
            assert r[f"occ_tcount_{m}"] == len(known)
            assert (r[f"occ_tmean_{m}"] is None) if not known else np.isclose(r[f"occ_tmean_{m}"], np.mean(known))
