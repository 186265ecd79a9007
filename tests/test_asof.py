import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dockcast.operators import asof
from dockcast.operators.asof import asof_join

BASE = dt.datetime(2024, 1, 1)


def _rows(seed, dense):
    rng = random.Random(seed)
    span = 3 if dense else 60 * 60 * 24 * 9
    left = [(rng.choice("aab"), BASE + dt.timedelta(seconds=rng.randrange(span)), i) for i in range(400)]
    right = [(rng.choice("aac"), BASE + dt.timedelta(seconds=rng.randrange(span), microseconds=rng.choice([0, 0, 7])), i, rng.choice([None, i * 0.5]))
             for i in range(150)]
    left += [(None, BASE, 900), ("a", None, 901), (None, None, 902), ("a", BASE - dt.timedelta(days=400), 903), ("a", BASE + dt.timedelta(days=400), 904)]
    right += [(None, BASE, 900, 1.0), ("a", None, 901, 1.0)]
    return left, right


def _frames(spark, left, right):
    return (spark.createDataFrame(left, "k string, ts timestamp_ntz, id long").repartition(3),
            spark.createDataFrame(right, "k string, at timestamp_ntz, rid long, v double").repartition(3))


def _plain(left, right, by, forward, exact, within):
    out = set()
    for k, ts, i in left:
        best = None
        for rk, at, rid, v in right:
            if ts is None or at is None or (by and (k is None or rk != k)):
                continue
            gap = (at - ts) if forward else (ts - at)
            if gap < dt.timedelta(0) or (gap == dt.timedelta(0) and not exact):
                continue
            if best is None or (-gap, rid) > best[0]:
                best = ((-gap, rid), rid, v, at)
        if best and within is not None and abs((best[3] - ts).total_seconds()) > within:
            best = None
        out.add((k, ts, i) + (best[1:] if best else (None, None, None)))
    return out


@pytest.mark.parametrize("by,forward,exact,within,dense,max_rows", [
    (["k"], False, True, None, False, 10_000), (["k"], False, True, None, False, 9), (["k"], False, True, None, True, 9),
    ([], True, False, 4000.0, False, 9), (["k"], True, False, 1.0, True, 9), ([], False, False, None, True, 9)])
def test_equals_plain_loops(spark, by, forward, exact, within, dense, max_rows):
    """Wide chunks, chunks cut down to seconds, and instants that hold more rows than a chunk may."""
    left, right = _rows(7, dense)
    a, b = _frames(spark, left, right)
    got = asof_join(a, b if by else b.drop("k"), ["rid", "v"], right_ts="at", by=by, ties=["rid"], forward=forward, exact=exact,
                    within_seconds=within, max_rows=max_rows, matched_ts="m")
    assert got.columns == ["k", "ts", "id", "rid", "v", "m"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(left) and set(rows) == _plain(left, right, by, forward, exact, within)


def test_a_dense_key_is_cut_where_it_is_dense(spark):
    """One station with a reading every second of a day and another with one a day: only the crowded chunks get narrow."""
    rows = [("hot", BASE + dt.timedelta(seconds=i)) for i in range(20_000)] + [("cold", BASE + dt.timedelta(days=i)) for i in range(50)]
    line = spark.createDataFrame(rows, "k string, ts timestamp_ntz").withColumn("_at", asof.micros("ts"))
    parts, instants = asof.cut(line, ["k"], 4_000)
    sizes = {(r.k, r._width): r.n for r in parts.groupBy("k", "_chunk", "_width").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert not instants and max(sizes.values()) <= 4_000
    assert {k for k in sizes} == {("hot", 3_600_000_000), ("cold", 86_400_000_000)}
    assert parts.where("k = 'hot'").select("_chunk").distinct().count() == 6


def test_empty_sides_and_equal_rows(spark):
    left, right = _frames(spark, [("a", BASE, 1), ("a", BASE, 1)], [("a", BASE, 5, 1.0), ("a", BASE, 5, 1.0)])
    got = asof_join(left, right, ["rid"], right_ts="at", by=["k"])
    assert [tuple(r) for r in got.collect()] == [("a", BASE, 1, 5)] * 2
    assert [r.rid for r in asof_join(left, right.limit(0), ["rid"], right_ts="at", by=["k"]).collect()] == [None, None]
    assert asof_join(left.limit(0), right, ["rid"], right_ts="at", by=["k"]).collect() == []
