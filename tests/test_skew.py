"""A hot station (most of the rows) is split into bounded window groups."""

from pyspark.sql import functions as F

from dockcast.operators import features, panel
from dockcast.operators.sequence import BLK, Sequencer
from tests.helpers import close, make_panel


def test_hot_station_blocks_are_bounded(spark):
    rows = [("hot", 5 * i, i % 17, 20) for i in range(3000)] + [(f"s{k}", 5 * i, i % 5, 10) for k in range(5) for i in range(40)]
    df = make_panel(spark, rows)
    seq = Sequencer(order=("ts", "event_id"), strategy="blocked", block_rows=128, chunk_seconds=3600)
    clean = panel.clean_panel(df, seq)
    halo = seq._halo(seq.index(clean), features.LOOK_BACK, features.LOOK_AHEAD)
    sizes = halo.groupBy("station_id", BLK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 128 + features.LOOK_BACK + features.LOOK_AHEAD
    assert sizes.where("station_id = 'hot'").count() == 3000 // 128 + 1          # hot station spread over blocks
    key = features.build_features(panel.clean_panel(df, seq.with_strategy("key")), seq.with_strategy("key"))
    blk = features.build_features(clean, seq)
    a = key.orderBy("station_id", "ts").toPandas()
    b = blk.orderBy("station_id", "ts").toPandas()
    for c in ("occ_lag_60", "occ_roll_180", "occ_delta_60", "occ_60"):
        assert close(a[c], b[c]), c


def test_dense_chunks_narrow_the_chunk_width(spark):
    rows = [("dense", i // 10, i % 13, 20) for i in range(600)] + [("other", 5 * i, i % 7, 10) for i in range(30)]
    df = make_panel(spark, rows)                     # ~10 readings per minute on one station
    seq = Sequencer(order=("ts", "event_id"), strategy="blocked", block_rows=64, max_chunk_rows=50)
    clean = panel.clean_panel(df, seq)
    assert seq.chunk_width() < 86_400
    blk = features.build_features(clean, seq).orderBy("station_id", "ts", "event_id").toPandas()
    key_seq = Sequencer(order=("ts", "event_id"), strategy="key")
    key = features.build_features(panel.clean_panel(df, key_seq), key_seq).orderBy("station_id", "ts", "event_id").toPandas()
    for c in ("occ_lag_60", "occ_roll_180", "occ_60", "capacity"):
        assert close(key[c], blk[c]), c


def test_auto_strategy_checks_sizes(spark):
    rows = [("big", 5 * i, 1, 10) for i in range(50)] + [("small", 5 * i, 1, 10) for i in range(5)]
    df = make_panel(spark, rows)
    assert Sequencer(order=("ts", "event_id")).resolve(df) == "key"                       # tiny input: no job
    forced = Sequencer(order=("ts", "event_id"), max_key_bytes=0, max_key_rows=40)       # count path
    assert forced.resolve(df) == "blocked"
    assert Sequencer(order=("ts", "event_id"), max_key_bytes=0, max_key_rows=60).resolve(df) == "key"
