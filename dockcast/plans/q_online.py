"""Queries of the online feature stream: what it serves and what comes too late."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockcast.functions.columns import from_micros, micros
from dockcast.operators.dims import materialise
from dockcast.plans.catalog import KEYS, register
from dockcast.plans.sqltext import BASE, _window_sql, with_
from dockcast.session import table_folder
from dockcast.streaming.landing import by_time, land
from dockcast.streaming.online import FEATURES, start_online

DROPS, FILES = 6, 4

# every 29th reading is delivered after all others; it is late if its station has been served a newer one
_ORDER = """held AS (SELECT station_id, ts, event_id, occ, event_id % 29 = 0 AS held FROM panel),
marked AS (SELECT *, max(CASE WHEN NOT held THEN {'ts': ts, 'id': event_id} END) OVER (PARTITION BY station_id) AS newest FROM held),
split AS (SELECT *, held AND newest IS NOT NULL AND (ts < newest.ts OR (ts = newest.ts AND event_id < newest.id)) AS late FROM marked)"""


def _run(c):
    """Land the panel's readings, run the stream to its end; folders of served and late readings."""
    root = table_folder(c.spark)
    p = materialise(c.panel.select("station_id", "ts", "event_id", "occ"))        # read for its time span and for its rows
    when = F.when(F.col("event_id") % 29 == 0, F.lit(DROPS)).otherwise(by_time(p, "ts", DROPS))
    land(p, when, DROPS + 1, f"{root}/landing", files=FILES,
         write=lambda d, path: d.withColumn("ts", F.timestamp_micros(micros("ts"))).write.mode("append").parquet(path))
    q = start_online(c.spark, f"{root}/landing", f"{root}/served", f"{root}/late", f"{root}/ckpt", max_files=FILES, available_now=True)
    q.awaitTermination()
    return f"{root}/served", f"{root}/late"


def _wall(df, *names):
    return df.withColumns({n: from_micros(F.unix_micros(n)) for n in names})


@register("online_features", KEYS + [("occ", "q")] + [(f, "q") for f in FEATURES],
          with_(*BASE, _ORDER, f"served AS (SELECT *, {_window_sql('occ', 'occ', targets=False)} FROM split WHERE NOT late)")
          + "SELECT {out} FROM served")
def online_features(c):
    """Lag, rolling and delta features of streamed readings: those of training over the readings served."""
    return _wall(c.spark.read.parquet(_run(c)[0]), "ts")


@register("online_late", KEYS + [("occ", "q"), ("served_ts", "t")],
          with_(*BASE, _ORDER) + "SELECT {out} FROM (SELECT *, newest.ts AS served_ts FROM split WHERE late) x")
def online_late(c):
    """Streamed readings that came after a newer one of their station had been served, with that one's time."""
    return _wall(c.spark.read.parquet(_run(c)[1]), "ts", "served_ts")
