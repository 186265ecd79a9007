"""Leak-free features: calendar, lags, rolling means, deltas, future targets.

All row-window features share one window specification, so Spark plans a
single Exchange + Sort + Window for them (one shuffle by station, or the
blocked plan of ``Sequencer``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast import config
from dockcast.functions.columns import calendar_columns
from dockcast.operators import ema
from dockcast.operators.sequence import KNOWN_BEFORE, ROW_NUMBER, Sequencer

LOOK_BACK = max(max(config.ROLL_STEPS), max(config.LAG_STEPS), max(config.DELTA_STEPS))
LOOK_AHEAD = max(config.steps(h) for h in config.HORIZONS)


def with_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns(calendar_columns(F.col(ts)))


def _window_columns(value: str, prefix: str, w, targets: bool, lags=config.LAG_STEPS,
                    rolls=config.ROLL_STEPS, deltas=config.DELTA_STEPS, ts: str = "ts") -> dict:
    v = F.col(value)
    cols = {}
    for k in lags:
        cols[f"{prefix}_lag_{k * config.FREQ_MIN}"] = F.lag(v, k).over(w).cast("float")
    for k in rolls:
        frame = w.rowsBetween(-k, -1)
        # mean of the k previous rows, null unless all k exist and are non-null
        cols[f"{prefix}_roll_{k * config.FREQ_MIN}"] = F.when(
            F.count(v).over(frame) == k, F.avg(v).over(frame)).cast("float")
    for k in deltas:
        cols[f"{prefix}_delta_{k * config.FREQ_MIN}"] = (v - F.lag(v, k).over(w)).cast("float")
    if targets:
        for h in config.HORIZONS:
            cols[f"{prefix}_{h}"] = F.lead(v, config.steps(h)).over(w).cast("float")
            cols[f"ts_{h}"] = F.lead(F.col(ts), config.steps(h)).over(w)
    return cols


def build_features(panel: DataFrame, seq: Sequencer, use_ema: bool = False, targets: bool = True) -> DataFrame:
    """Feature frame of the clean panel (needs ``occ``).

    Adds calendar columns, ``occ_lag_*``, ``occ_roll_*``, ``occ_delta_*``
    and, when ``targets``, the future occupancies ``occ_15/30/60`` with the
    timestamps ``ts_15/30/60`` of the rows they come from (used to cut the
    delta targets at the split without another window).
    """
    df = with_calendar(panel)
    strategy = seq.resolve(df)
    if use_ema and strategy != "key":
        df = seq.index(df, known="occ")
        df = df.withColumns({ema.ROW: F.col(ROW_NUMBER), ema.BEFORE: F.col(KNOWN_BEFORE)}).drop(KNOWN_BEFORE)
    plain = df

    def build(d: DataFrame, w: Window) -> DataFrame:
        d = d.withColumns(_window_columns("occ", "occ", w, targets))
        return d.withColumns(ema.numbered(w)) if use_ema and strategy == "key" else d

    out = seq.windowed(df, LOOK_BACK, LOOK_AHEAD, build, strategy)
    if not use_ema:
        return out
    # the few columns of the scan, from the rows before the feature windows
    names = [*seq.keys, "occ"]
    rows = (plain.select(*names, *[c for c in seq.order if c not in names]).withColumns(ema.numbered(seq.key_window()))
            if strategy == "key" else plain)
    return ema.with_ema(out, rows.select(*names, ema.ROW, ema.BEFORE), seq.keys)


def build_bike_features(panel: DataFrame, seq: Sequencer) -> DataFrame:
    """Bike-space twin: lag_*, roll_mean_60, delta_5, hour/dow/sin/cos and y_h."""
    df = panel.withColumns({k: v for k, v in calendar_columns(F.col("ts")).items()
                            if k in ("hour", "dow", "hour_sin", "hour_cos")})

    def build(d: DataFrame, w: Window) -> DataFrame:
        b = F.col("bikes_available")
        cols = {f"lag_{k * config.FREQ_MIN}": F.lag(b, k).over(w).cast("float") for k in config.LAG_STEPS}
        frame = w.rowsBetween(-12, -1)
        cols["roll_mean_60"] = F.when(F.count(b).over(frame) == 12, F.avg(b).over(frame)).cast("float")
        cols["delta_5"] = (b - F.lag(b, 1).over(w)).cast("float")
        for h in config.HORIZONS:
            cols[f"y_{h}"] = F.lead(b, config.steps(h)).over(w).cast("float")
        return d.withColumns(cols)

    return seq.windowed(df, 12, LOOK_AHEAD, build)


def with_targets_only(df: DataFrame, value: str, prefix: str, seq: Sequencer) -> DataFrame:
    """Only the future values ``{prefix}_{h}`` (bike-space targets of the seasonal baseline)."""
    def build(d, w):
        return d.withColumns({f"{prefix}_{h}": F.lead(F.col(value), config.steps(h)).over(w).cast("float")
                              for h in config.HORIZONS})
    return seq.windowed(df, 0, LOOK_AHEAD, build)
