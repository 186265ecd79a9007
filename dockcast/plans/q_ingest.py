"""Queries of the ingestion side: GBFS merge, alias harmonisation, snapshots -> panel, UTC parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockcast.functions.columns import utc_normalise
from dockcast.plans.catalog import register
from dockcast.plans.sqltext import with_
from dockcast.sources import fixtures as fx
from dockcast.session import table_folder
from dockcast.sources import gbfs, versions
from dockcast.sources.tables import read_table
from dockcast.streaming.gbfs_polls import start_polls
from dockcast.streaming.landing import by_time, land
from dockcast.streaming.snapshots import SNAPSHOT_SCHEMA, start_latest, start_panel, to_panel

INFO_SQL = """info AS (SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name,
    CAST(48.80 AS DOUBLE) + s_nationkey / CAST(100 AS DOUBLE) AS lat,
    CAST(2.25 AS DOUBLE) + s_acctbal / CAST(100000 AS DOUBLE) AS lon,
    CAST(20 + s_suppkey % 40 AS DOUBLE) AS capacity FROM supplier)"""
STATUS_SQL = """status AS (SELECT CAST(l_suppkey AS VARCHAR) AS station_id, 1 AS is_installed,
    CASE WHEN n % 7 = 0 THEN 0 ELSE 1 END AS is_renting, 1 AS is_returning,
    CAST(epoch_us(last) // 1000000 AS BIGINT) AS last_reported,
    CASE WHEN l_suppkey % 3 <> 1 THEN CAST(n % 30 AS INTEGER) END AS num_bikes_available,
    CASE WHEN l_suppkey % 3 <> 0 THEN CAST(n % 30 AS INTEGER) + 1 END AS numBikesAvailable,
    CASE WHEN l_suppkey % 3 <> 1 THEN CAST(CAST(q AS BIGINT) % 25 AS INTEGER) END AS num_docks_available,
    CASE WHEN l_suppkey % 3 <> 0 THEN CAST(CAST(q AS BIGINT) % 25 AS INTEGER) + 2 END AS numDocksAvailable
  FROM (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS q, max(l_shipdate) AS last FROM lineitem GROUP BY l_suppkey) g)"""
HARM_SQL = """harm AS (SELECT station_id, is_installed, is_renting, is_returning, last_reported,
    COALESCE(num_bikes_available, numBikesAvailable) AS num_bikes_available,
    COALESCE(num_docks_available, numDocksAvailable) AS num_docks_available FROM status)"""
SNAP_SPEC = [("station_id", "s"), ("name", "s"), ("lat", "q"), ("lon", "q"), ("capacity", "q"), ("is_installed", "i"),
             ("is_renting", "i"), ("is_returning", "i"), ("last_reported", "l"), ("num_bikes_available", "i"),
             ("num_docks_available", "i")]


@register("alias_coalesce", [("station_id", "s"), ("num_bikes_available", "i"), ("num_docks_available", "i")],
          with_(STATUS_SQL, HARM_SQL) + "SELECT {out} FROM harm")
def alias_coalesce(c):
    """snake_case field, else its camelCase alias, per station status row."""
    return gbfs.harmonise(fx.station_status(c.spark, c.sf))


@register("gbfs_merge", SNAP_SPEC,
          with_(STATUS_SQL, HARM_SQL, INFO_SQL) + """SELECT {out} FROM (SELECT h.station_id, i.name, i.lat, i.lon, i.capacity,
             h.is_installed, h.is_renting, h.is_returning, h.last_reported, h.num_bikes_available, h.num_docks_available
             FROM harm h JOIN info i ON h.station_id = i.station_id) x""")
def gbfs_merge(c):
    """status ⋈ info on station_id, harmonised and projected to the kept columns."""
    status = fx.station_status(c.spark, c.sf)
    info = fx.station_info(c.spark, c.sf)
    return gbfs.keep_existing(gbfs.merge(gbfs.harmonise(status), info))


_PANEL_SQL = """WITH snaps AS (SELECT CAST(user_id AS VARCHAR) AS station_id, ts AS snapshot_ts,
                    CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS num_bikes_available,
                    CASE WHEN event_type = 'signup' THEN CAST(20 + user_id % 40 AS DOUBLE) END AS capacity FROM events)
             SELECT {out} FROM (SELECT station_id, make_timestamp(epoch_us(snapshot_ts) - epoch_us(snapshot_ts) % 300000000) AS ts,
                    arg_max({'b': CAST(num_bikes_available AS REAL), 'c': CAST(capacity AS REAL)}, snapshot_ts) AS r,
                    count(*) AS n_snapshots FROM snaps GROUP BY ALL) x, LATERAL (SELECT x.r.b AS bikes_available, x.r.c AS capacity) y"""


@register("snapshot_panel", [("station_id", "s"), ("ts", "t"), ("bikes_available", "q"), ("capacity", "q"), ("n_snapshots", "l")], _PANEL_SQL)
def snapshot_panel(c):
    """Snapshots -> 5-minute panel (latest reading per station and tick); the batch twin of the stream."""
    return to_panel(_snapshots(c))


@register("utc_normalise", [("event_id", "l"), ("ts_text", "s"), ("ts_utc", "t")],
          """WITH t AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                                                  WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
                                                  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' END AS ts_text FROM events)
             SELECT {out} FROM (SELECT event_id, ts_text, CASE WHEN event_id % 3 = 0 THEN CAST(ts_text AS TIMESTAMP)
                    ELSE CAST(CAST(ts_text AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) END AS ts_utc FROM t) x""")
def utc_normalise_q(c):
    """ISO text with and without zone suffix -> UTC wall clock (naive text is UTC)."""
    e = read_table(c.spark, c.sf, "events", ["event_id", "ts"])
    base = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    k = F.col("event_id") % 3
    text = F.when(k == 0, base).when(k == 1, F.concat(iso, F.lit("Z"))).otherwise(F.concat(iso, F.lit("+02:00")))
    return e.select("event_id", text.alias("ts_text")).withColumn("ts_utc", utc_normalise(F.col("ts_text")))


def _snapshots(c):
    e = read_table(c.spark, c.sf, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select(F.col("user_id").cast("string").alias("station_id"), F.col("ts").alias("snapshot_ts"),
                    F.when(F.col("event_id") % 37 == 0, F.lit(None)).otherwise(F.col("value")).alias("num_bikes_available"),
                    F.when(F.col("event_type") == "signup", (F.lit(20) + F.col("user_id") % 40).cast("double")).alias("capacity"))


# ticks the watermark has closed: they end ten minutes before the newest reading
_CLOSED = """ WHERE x.ts + INTERVAL 5 MINUTES <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES"""


# deliveries a stream reads one after another, and the most files of each
DROPS, FILES = 8, 4


def _land_snapshots(c, folder):
    s = _snapshots(c)
    full = s.select(*[(F.col(f.name) if f.name in s.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in SNAPSHOT_SCHEMA.fields])
    land(full, by_time(full, "snapshot_ts", DROPS), DROPS, folder, files=FILES)


@register("snapshot_stream", [("station_id", "s"), ("ts", "t"), ("bikes_available", "q"), ("capacity", "q"), ("n_snapshots", "l")],
          _PANEL_SQL + _CLOSED)
def snapshot_stream(c):
    """The 5-minute panel built by Structured Streaming: snapshots land in time order in ``DROPS`` deliveries,
    the file-source stream takes them in as many micro-batches (watermark 10 min, availableNow), and
    the closed ticks it emitted are returned (the still-open last ticks are not)."""
    root = table_folder(c.spark)
    _land_snapshots(c, f"{root}/landing")
    q = start_panel(c.spark, f"{root}/landing", f"{root}/panel", f"{root}/ckpt", available_now=True, max_files=FILES)
    q.awaitTermination()
    return c.spark.read.parquet(f"{root}/panel")


@register("latest_stream", [("station_id", "s"), ("snapshot_ts", "t"), ("num_bikes_available", "q"), ("capacity", "q")],
          """SELECT {out} FROM (SELECT CAST(user_id AS VARCHAR) AS station_id, ts AS snapshot_ts,
               CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS num_bikes_available,
               CASE WHEN event_type = 'signup' THEN CAST(20 + user_id % 40 AS DOUBLE) END AS capacity
             FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) x""")
def latest_stream(c):
    """The newest snapshot of each station, kept by a stream that commits a version per micro-batch (``DROPS`` of them)."""
    root = table_folder(c.spark)
    _land_snapshots(c, f"{root}/landing")
    q = start_latest(c.spark, f"{root}/landing", f"{root}/latest", f"{root}/ckpt", available_now=True, max_files=FILES)
    q.awaitTermination()
    return versions.read(c.spark, f"{root}/latest")


# --- documents of several polls, made from the station tables -----------------
POLLS, PER_DOCUMENT, FIRST_POLL = 8, 40, "2024-01-01 00:00:00"


def _poll_time(poll):
    return F.unix_micros(F.lit(FIRST_POLL + "+00:00").cast("timestamp")) / 1_000_000 + poll * 300


def _documents(stations, drop):
    """One line of JSON per poll and ``PER_DOCUMENT`` stations (a feed's document), with the delivery it comes in."""
    names = [x for x in stations.columns if x not in ("poll", "feed", "last_updated")]
    docs = stations.groupBy("poll", "feed", "last_updated").agg(F.collect_list(F.struct(*names)).alias("stations"))
    text = F.to_json(F.struct(F.col("last_updated").cast("long").alias("last_updated"), F.struct("stations").alias("data")))
    return docs.select("poll", "feed", text.alias("value")).withColumn("_at", drop)


def _land_documents(docs, folder):
    docs = docs.where("_at IS NOT NULL")
    land(docs.select("value", "feed", "_at"), F.col("_at"), POLLS + 1, folder, key="feed", files=FILES,
         write=lambda d, path: d.select("value").write.mode("append").text(path))


@register("gbfs_stream", SNAP_SPEC + [("snapshot_ts", "t")],
          with_(STATUS_SQL, HARM_SQL, INFO_SQL) + f"""SELECT {{out}} FROM (SELECT h.station_id, i.name, i.lat, i.lon, i.capacity,
             h.is_installed, h.is_renting, h.is_returning, h.last_reported, h.num_bikes_available + 7 * poll AS num_bikes_available,
             h.num_docks_available, TIMESTAMP '{FIRST_POLL}' + to_minutes(5 * poll) AS snapshot_ts
             FROM harm h JOIN info i ON h.station_id = i.station_id CROSS JOIN (SELECT unnest(range({POLLS})) AS poll)
             WHERE NOT (poll = 3 AND CAST(h.station_id AS BIGINT) // {PER_DOCUMENT} % 3 = 1)
               AND NOT (poll = 1 AND CAST(h.station_id AS BIGINT) // {PER_DOCUMENT} % 3 = 2)) x""")
def gbfs_stream(c):
    """Station documents of eight polls, landed as raw JSON and joined by a stream.

    Of every third feed, the information document of poll 3 never comes (no rows); the status document of
    poll 1 comes after the last poll, beyond the watermark (no rows); that of poll 4 comes one poll late (joined).
    """
    feed = F.expr(f"CAST(station_id AS BIGINT) DIV {PER_DOCUMENT}")
    polls = F.explode(F.sequence(F.lit(0), F.lit(POLLS - 1)))
    poll, third = F.col("poll"), F.col("feed") % 3
    info = (fx.station_info(c.spark, c.sf).withColumn("feed", feed).withColumn("poll", polls)
            .withColumn("last_updated", _poll_time(poll) - 20))
    status = (fx.station_status(c.spark, c.sf).withColumn("feed", feed).withColumn("poll", polls)
              .withColumns({x: F.col(x) + 7 * poll for x in ("num_bikes_available", "numBikesAvailable")})
              .withColumn("last_updated", _poll_time(poll)))
    root = table_folder(c.spark)
    _land_documents(_documents(info, F.when(~((poll == 3) & (third == 1)), poll)), f"{root}/info")
    _land_documents(_documents(status, F.when((poll == 1) & (third == 2), F.lit(POLLS)).when((poll == 4) & (third == 0), poll + 1).otherwise(poll)),
                    f"{root}/status")
    q = start_polls(c.spark, f"{root}/info", f"{root}/status", f"{root}/snapshots", f"{root}/ckpt", max_files=FILES, available_now=True)
    q.awaitTermination()
    return c.spark.read.parquet(f"{root}/snapshots")
