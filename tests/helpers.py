"""Small frames and plain loops that tests compare with."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd


def make_panel(spark, rows):
    """rows: (station_id, minutes_from_start, bikes, capacity)."""
    base = dt.datetime(2024, 1, 1)
    data = [(s, base + dt.timedelta(minutes=m), None if b is None else float(b), None if c is None else float(c), i)
            for i, (s, m, b, c) in enumerate(rows)]
    return spark.createDataFrame(
        data, "station_id string, ts timestamp_ntz, bikes_available float, capacity float, event_id long")


def looped_features(pdf: pd.DataFrame) -> pd.DataFrame:
    """Lags, means of previous rows, deltas and targets from their definitions, station by station and row by row."""
    out = pdf.sort_values(["station_id", "ts", "event_id"]).reset_index(drop=True)
    names = ([f"occ_lag_{5 * k}" for k in (1, 2, 3, 6, 12)] + [f"occ_roll_{5 * k}" for k in (3, 6, 12, 24, 36)]
             + [f"occ_delta_{5 * k}" for k in (1, 3, 6, 12)] + [f"occ_{5 * k}" for k in (3, 6, 12)])
    columns: dict[str, list[float]] = {c: [] for c in names}           # present for a frame without rows too
    for _, part in out.groupby("station_id", sort=False):
        x = part["occ"].to_numpy(dtype="float64")

        def at(i, x=x):
            return x[i] if 0 <= i < len(x) else np.nan
        for i in range(len(x)):
            row = {f"occ_lag_{5 * k}": at(i - k) for k in (1, 2, 3, 6, 12)}
            for k in (3, 6, 12, 24, 36):
                before = [at(j) for j in range(i - k, i)]
                row[f"occ_roll_{5 * k}"] = float(np.sum(before)) / k
            row |= {f"occ_delta_{5 * k}": x[i] - at(i - k) for k in (1, 3, 6, 12)}
            row |= {f"occ_{5 * k}": at(i + k) for k in (3, 6, 12)}
            for c, v in row.items():
                columns[c].append(v)
    return out.assign(**columns)


def close(a, b, tol=1e-6):
    a = np.asarray(a, dtype="float64")
    b = np.asarray(b, dtype="float64")
    return bool(((np.isnan(a) & np.isnan(b)) | (np.abs(a - b) <= tol)).all())
