"""Online lag features for serving from a stream of readings.

The service needs the last 36 readings of a station to build the same features as
training.  A stateful processor keeps them (``transformWithState``: a list state with a
row per station, its values and its last served reading; a service that runs on gives
them a time to live, so stations that fall silent leave the state).  Stations are dealt
to ``GROUPS`` groups, the keys of the state, and a micro-batch is computed at once per
group with arrays: calls and state reads do not grow with the number of stations.

A reading that is not newer than the last one served for its station is late: its
features can no longer be those of training, so it is not served but comes out
marked ``late``, with the served reading it came after.  Readings of one
micro-batch are put in order first, so only what arrives in a later batch is late.
Ties in time are ordered by ``event_id``; a repeated (time, id) is late.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from dockcast import config

KEEP = max(config.ROLL_STEPS)
LAGS = {f"occ_lag_{k * config.FREQ_MIN}": k for k in config.LAG_STEPS}
ROLLS = {f"occ_roll_{k * config.FREQ_MIN}": k for k in config.ROLL_STEPS}
DELTAS = {f"occ_delta_{k * config.FREQ_MIN}": k for k in config.DELTA_STEPS}
FEATURES = [*LAGS, *ROLLS, *DELTAS]
OUT_COLS = ["station_id", "ts", "event_id", "occ", *FEATURES, "late", "served_ts"]
OUTPUT_SCHEMA = ("station_id string, ts timestamp, event_id long, occ float, " + ", ".join(f"{c} float" for c in FEATURES)
                 + ", late boolean, served_ts timestamp")
TTL_MS = 30 * 86_400_000
GROUPS = 256                # keys of the state; a checkpoint belongs to one number of them
_NAT = np.iinfo(np.int64).min
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _features(line: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Training definitions for the values at the places ``at`` of ``line``, each after ``KEEP`` values of its station at least."""
    out = {c: line[at - k] for c, k in LAGS.items()}
    wide = line.astype(np.float64)
    for c, k in ROLLS.items():
        total = np.zeros(len(at))
        for j in range(1, k + 1):
            total += wide[at - j]
        out[c] = (total / k).astype(np.float32)
    for c, k in DELTAS.items():
        out[c] = line[at] - line[at - k]
    return out


def batch_features(history: np.ndarray, values: np.ndarray) -> dict[str, np.ndarray]:
    """Training definitions for ``values`` (float32) that follow ``history``; unknown readings are NaN."""
    line = np.concatenate([np.full(KEEP, np.nan, np.float32), history.astype(np.float32), values.astype(np.float32)])
    return _features(line, np.arange(len(line) - len(values), len(line)))


class LagFeatures(StatefulProcessor):
    """Features of new readings of a group of stations; late ones are passed on as they are."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        # ``values`` are the last KEEP readings as float32, NaN where unknown; ``seen`` is when they were put
        self.stations = handle.getListState("stations", "station_id string, ts long, event_id long, values binary, seen long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        now = 0 if self.ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        # a put renews the whole list, so a station's own time counts
        state = {r[0]: r for r in self.stations.get() if self.ttl_ms is None or r[4] + self.ttl_ms > now} if self.stations.exists() else {}
        batch["_s"], names = pd.factorize(batch["station_id"], use_na_sentinel=False)
        batch = batch.sort_values(["_s", "ts", "event_id"], kind="stable", ignore_index=True)
        names = [None if pd.isna(x) else x for x in names]
        known = [state.get(x) for x in names]
        own = batch["_s"].to_numpy()
        ts, ids = batch["ts"].to_numpy().astype("datetime64[us]"), batch["event_id"]
        at = np.array([_NAT if r is None else r[1] for r in known], np.int64).view("datetime64[us]")[own]
        at_id = np.array([0 if r is None or r[2] is None else r[2] for r in known], np.int64)[own]
        id_known = np.array([r is not None and r[2] is not None for r in known])[own] & ids.notna().to_numpy()
        repeated = batch.duplicated(["_s", "ts", "event_id"]).to_numpy()
        old = (ts < at) | ((ts == at) & id_known & (ids.fillna(0).to_numpy() <= at_id))
        late = repeated | old
        if late.any():
            out = batch[late][["station_id", "ts", "event_id", "occ"]].assign(late=True, served_ts=np.where(old, at, ts)[late].astype("datetime64[ns]"))
            yield out.reindex(columns=OUT_COLS)
        if not late.all():
            served, own = batch[~late], own[~late]
            values = served["occ"].to_numpy(np.float32)
            # each station's KEEP values before, then its new ones
            count = np.bincount(own, minlength=len(names))
            end = np.cumsum(count + np.where(count > 0, KEEP, 0))
            begin = end - count
            line = np.full(int(end[-1]), np.nan, np.float32)
            place = begin[own] + np.arange(len(own)) - (np.cumsum(count) - count)[own]
            line[place] = values
            for i in np.flatnonzero(count):
                if known[i] is not None:
                    line[begin[i] - KEEP:begin[i]] = np.frombuffer(known[i][3], np.float32)
            out = pd.DataFrame({"station_id": served["station_id"].to_numpy(), "ts": served["ts"].to_numpy(), "event_id": served["event_id"].to_numpy(),
                                "occ": values, **_features(line, place)}).assign(late=False, served_ts=pd.NaT)
            last = np.cumsum(count) - 1
            when, ids = ts[~late].astype(np.int64), served["event_id"].to_numpy()
            for i in np.flatnonzero(count):
                x = ids[last[i]]
                state[names[i]] = (names[i], int(when[last[i]]), None if pd.isna(x) else int(x), line[end[i] - KEEP:end[i]].tobytes(), now)
            self.stations.put([tuple(r) for r in state.values()])
            yield out[OUT_COLS]

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession):
    """The state store that ``transformWithState`` needs, for queries started inside."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def online_features(readings: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """readings: station_id, ts (timestamp), event_id, occ (float) -> one row per reading, served with features or ``late``.

    A time to live counts by the clock, so such a query goes on with empty batches and never ends by itself.
    """
    group = F.pmod(F.xxhash64("station_id"), F.lit(GROUPS)).alias("station_group")
    r = readings.select(group, "station_id", "ts", "event_id", F.col("occ").cast("float").alias("occ"))
    return r.groupBy("station_group").transformWithStateInPandas(LagFeatures(ttl_ms), OUTPUT_SCHEMA, "append", "none" if ttl_ms is None else "processingTime")


def start_online(spark: SparkSession, landing: str, served: str, late: str, checkpoint: str, max_files: int = 4, available_now: bool = False):
    """Serve landed readings: features into ``served``, late readings into ``late`` (both by batch number, so a repeated batch replaces itself)."""
    schema = "station_id string, ts timestamp, event_id long, occ float"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)

    def deliver(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()                                       # one run of the state update for both outputs
        batch.where("NOT late").drop("late", "served_ts").write.mode("overwrite").parquet(f"{served}/batch={epoch}")
        batch.where("late").select("station_id", "ts", "event_id", "occ", "served_ts").write.mode("overwrite").parquet(f"{late}/batch={epoch}")
        batch.unpersist()

    with state_store(spark):
        w = online_features(stream, None if available_now else TTL_MS).writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()
