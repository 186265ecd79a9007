"""SQL text shared by the DuckDB oracles of ``dockcast.plans.catalog``.

The fragments restate, in plain SQL over the driver tables, what the Spark
plans compute; ``W`` is the per-station ordering (ties broken by event_id).
"""

from __future__ import annotations

from dockcast import config

W = "PARTITION BY station_id ORDER BY ts, event_id"
SCALE = "CAST(1048576 AS DOUBLE)"


STATION_TS = """station_ts AS (
  SELECT CAST(user_id AS VARCHAR) AS station_id, ts, event_id,
         CAST(CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS REAL) AS bikes_available,
         CAST(CASE WHEN user_id % 50 = 0 THEN 0 WHEN user_id % 50 = 1 THEN NULL
                   WHEN event_type = 'signup' THEN 20 + user_id % 40 END AS REAL) AS capacity
  FROM events)"""

FILLED = f"""filled AS (
  SELECT station_id, ts, event_id, bikes_available,
         CAST(COALESCE(capacity,
           last_value(capacity IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(capacity IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS REAL) AS capacity
  FROM station_ts)"""

PANEL = """panel AS (
  SELECT *, CAST(CASE WHEN bikes_available IS NOT NULL THEN
              LEAST(GREATEST(CAST(bikes_available AS DOUBLE) / CAST(capacity AS DOUBLE), CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE))
            END AS REAL) AS occ
  FROM filled WHERE capacity > 0)"""


def calendar_sql(ts: str = "ts") -> str:
    h = f"CAST(hour({ts}) AS DOUBLE)"
    return (f"CAST(hour({ts}) AS TINYINT) AS hour, CAST(isodow({ts}) - 1 AS TINYINT) AS dow, "
            f"CAST(CASE WHEN isodow({ts}) >= 6 THEN 1 ELSE 0 END AS TINYINT) AS is_weekend, "
            f"CAST(sin(2*pi()*{h}/24) AS REAL) AS hour_sin, CAST(cos(2*pi()*{h}/24) AS REAL) AS hour_cos, "
            f"CAST(sin(4*pi()*{h}/24) AS REAL) AS hour_sin2, CAST(cos(4*pi()*{h}/24) AS REAL) AS hour_cos2")


def _window_sql(v: str, prefix: str, targets: bool = True) -> str:
    parts = []
    for k in config.LAG_STEPS:
        parts.append(f"CAST(lag({v}, {k}) OVER ({W}) AS REAL) AS {prefix}_lag_{k * config.FREQ_MIN}")
    for k in config.ROLL_STEPS:
        fr = f"{W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING"
        parts.append(f"CAST(CASE WHEN count({v}) OVER ({fr}) = {k} THEN avg({v}) OVER ({fr}) END AS REAL) "
                     f"AS {prefix}_roll_{k * config.FREQ_MIN}")
    for k in config.DELTA_STEPS:
        parts.append(f"CAST({v} - lag({v}, {k}) OVER ({W}) AS REAL) AS {prefix}_delta_{k * config.FREQ_MIN}")
    if targets:
        for h in config.HORIZONS:
            s = config.steps(h)
            parts.append(f"CAST(lead({v}, {s}) OVER ({W}) AS REAL) AS {prefix}_{h}")
            parts.append(f"lead(ts, {s}) OVER ({W}) AS ts_{h}")
    return ",\n    ".join(parts)


FEAT = f"""feat AS (
  SELECT *,
    {_window_sql('occ', 'occ')}
  FROM (SELECT *, {calendar_sql()} FROM panel) p)"""



def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (STATION_TS, FILLED, PANEL)
FEATS = BASE + (FEAT,)
