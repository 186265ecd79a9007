"""Fixed values of the forecasting setup.

These constants must equal the original project's for results to agree:
sampling step, horizons, split quantiles, window sizes, smoothing factors,
the gamma grid, the rain threshold and the ordered feature list.
"""

# --- fixed values (must match the original setup) --------------------------
FREQ_MIN = 5                      # minutes between two panel ticks
HORIZONS = (15, 30, 60)           # forecast horizons in minutes
SPLIT_TRAINTEST = 0.70            # temporal train/test quantile of ts
SPLIT_TRAINVAL = 0.85             # temporal train/validation quantile inside train
LAG_STEPS = (1, 2, 3, 6, 12)      # occ_lag_{5,10,15,30,60}
ROLL_STEPS = (3, 6, 12, 24, 36)   # occ_roll_{15,30,60,120,180}, previous rows only
DELTA_STEPS = (1, 3, 6, 12)       # occ_delta_{5,15,30,60}
EMA_FAST_ALPHA = 0.5
EMA_SLOW_ALPHA = 0.1
GAMMA_GRID = (0.5, 0.7, 0.9, 1.0)
RAIN_THRESHOLD_MM = 0.1
WEATHER_COLS = ("temperature_2m", "precipitation", "wind_speed_10m")
BASE_FEATURES = (
    "dow", "is_weekend", "hour_sin", "hour_cos", "hour_sin2", "hour_cos2",
    "occ_now",
    "occ_lag_5", "occ_lag_10", "occ_lag_15", "occ_lag_30", "occ_lag_60",
    "occ_roll_15", "occ_roll_30", "occ_roll_60", "occ_roll_120", "occ_roll_180",
    "occ_delta_5", "occ_delta_15", "occ_delta_30", "occ_delta_60",
)
EMA_FEATURES = ("occ_ema_fast", "occ_ema_slow", "occ_momentum")
STATION_FEATURES = ("sta_mean_occ", "sta_hdh_occ")
WEATHER_FEATURES = WEATHER_COLS + ("is_rain",)
# inputs of the bike-space baselines (ridge, one booster per horizon)
BIKE_FEATURES = (
    "hour_sin", "hour_cos", "dow", "capacity", "delta_5", "roll_mean_60",
    "lag_5", "lag_10", "lag_15", "lag_30", "lag_60",
)
GBFS_KEEP = (
    "station_id", "name", "lat", "lon", "capacity",
    "is_installed", "is_renting", "is_returning", "last_reported",
    "num_bikes_available", "num_docks_available",
)
GBFS_ALIASES = (("num_bikes_available", "numBikesAvailable"),
                ("num_docks_available", "numDocksAvailable"))
# boosted-tree settings: loss, validation metric, round budget, rounds without a lower
# validation error before stopping, learning rate, row and column share, minimum leaf rows
GBT_DELTA = dict(loss="absolute", metric="absolute", rounds=800, patience=50, step=0.08, rows=0.8, columns="0.85", leaf=64)
GBT_OCC = dict(loss="squared", metric="absolute", rounds=2000, patience=80, step=0.05, rows=0.8, columns="0.9", leaf=20)
GBT_BIKES = dict(loss="squared", metric="squared", rounds=400, patience=10, step=0.08, rows=1.0, columns="all", leaf=20)
GBT_MAX_DEPTH = 6
GBT_SEED = 42
# ---------------------------------------------------------------------------


def steps(minutes: int) -> int:
    """Minutes -> number of panel rows (row semantics, see README)."""
    return minutes // FREQ_MIN


def feature_list(use_ema: bool = False, use_sta: bool = True, use_weather: bool = False) -> list[str]:
    """Ordered model input columns (the order is part of a saved model)."""
    cols = list(BASE_FEATURES)
    if use_ema:
        cols += EMA_FEATURES
    if use_sta:
        cols += STATION_FEATURES
    cols.append("capacity")
    if use_weather:
        cols += WEATHER_FEATURES
    return cols
