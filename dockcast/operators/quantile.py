"""Exact quantiles without sending the data through one task.

``percentile`` keeps a map of every distinct value and merges it in one final
task — fine on a small grid, not on billions of raw timestamps.  Here the
k-th value is selected in two bounded steps, all lazy:

1. a histogram of ``bins`` equal-width buckets (partial aggregation; at most
   ``bins`` rows reach the single-partition prefix sum);
2. the ≤ 2 buckets holding ranks ``floor(p)`` and ``ceil(p)`` are read again
   and reduced to their distinct values (bounded by the bucket width), whose
   prefix counts give the exact order statistics.

The result interpolates linearly at ``p = q (n - 1)``, like pandas,
``percentile`` and DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantile(df: DataFrame, value: Column, q: float, bins: int = 1 << 20, out: str = "q",
                   width: float | None = None, by: list[str] | tuple = ()) -> DataFrame:
    """Exact q-quantile of ``value``: one row ``(n, <out>)``, or one row per ``by`` group.

    With ``width`` the buckets have that fixed width (``floor(v / width)``):
    no min/max pass is needed, so the input is read twice (histogram,
    candidates); otherwise a first pass finds min and max.  Groups share the
    passes; the broadcast target table has at most 2 rows per group.
    """
    by = list(by)
    d = df.select(*by, value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if width is None:
        mm = d.groupBy(*by).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        span = F.col("_hi") - F.col("_lo")
        bucket = F.when(span > 0, F.least(F.floor((F.col("_v") - F.col("_lo")) / span * bins), F.lit(bins - 1))).otherwise(F.lit(0))
        base = d.crossJoin(F.broadcast(mm)) if not by else d.join(F.broadcast(mm), by)   # one row per group
        binned = base.select(*by, "_v", bucket.alias("_b"))
    else:
        binned = d.select(*by, "_v", F.floor(F.col("_v") / float(width)).alias("_b"))
    hist = binned.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))            # partial aggregation
    # one pass over the histogram rows (one partition per group): total, rank position, rows before each bucket
    wg = Window.partitionBy(*by)
    h = hist.select(*by, "_b", "_c",
                    F.coalesce(F.sum("_c").over(wg.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                    F.sum("_c").over(wg).alias("_n"))
    h = h.withColumn("_p", F.lit(float(q)) * (F.col("_n") - 1).cast("double"))
    h = h.withColumns({"_rlo": F.floor("_p"), "_rhi": F.ceil("_p")})
    hit = lambda r: (F.col(r) >= F.col("_before")) & (F.col(r) < F.col("_before") + F.col("_c"))
    targets = h.where(hit("_rlo") | hit("_rhi")).select(*by, "_b", "_before", "_n", "_p", "_rlo", "_rhi")  # ≤ 2 per group
    cand = binned.join(F.broadcast(targets), by + ["_b"])                            # ≤ 2 buckets per group
    vals = cand.groupBy(*by, "_b", "_before", "_n", "_p", "_rlo", "_rhi", "_v").agg(F.count(F.lit(1)).alias("_c"))
    start = F.col("_before") + F.coalesce(
        F.sum("_c").over(Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = vals.select("*", start.alias("_s"))
    at = lambda r: (F.col(r) >= F.col("_s")) & (F.col(r) < F.col("_s") + F.col("_c"))
    aggs = [F.first("_n").alias("_n"), F.first("_p").alias("_p"), F.first("_rlo").alias("_rlo"),
            F.max(F.when(at("_rlo"), F.col("_v"))).alias("_vlo"), F.max(F.when(at("_rhi"), F.col("_v"))).alias("_vhi")]
    picked = ranked.groupBy(*by).agg(*aggs) if by else ranked.agg(*aggs)
    res = F.col("_vlo") + (F.col("_p") - F.col("_rlo").cast("double")) * (F.col("_vhi") - F.col("_vlo"))
    return picked.select(*by, F.coalesce(F.col("_n"), F.lit(0)).alias("n"), res.alias(out))


# Distinct values of one group that a single task may sort; groups beyond it are narrowed by ranges.
MAX_DISTINCT = 1 << 20
RANGES = 4096


def grouped_quantile(df: DataFrame, by: list[str], value: str, q: float = 0.5, out: str = "q",
                     max_distinct: int = MAX_DISTINCT) -> DataFrame:
    """Exact q-quantile of ``value`` per group (nulls skipped, linear interpolation), also for continuous values.

    The rows become counts per (group, value), with partial aggregation and dealt by
    both, so a group that holds most rows is spread.  If no group has more than
    ``max_distinct`` different values, prefix counts in each group give the result.
    Otherwise groups are narrowed by ranges (``_narrowed``).  A group without a value
    gives null.  Nulls in ``by`` form groups of their own.
    """
    from dockcast.operators.dims import materialise
    keys = [f"_g{i}" for i in range(len(by))]
    named = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(value).cast("double").alias("_v"))
    counts = materialise(named.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    known = counts.where("_v IS NOT NULL")
    most = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0] or 0
    if most <= max_distinct:
        group = Window.partitionBy(*keys)
        upto = F.sum("_c").over(group.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
        ranked = known.withColumns({"_n": F.sum("_c").over(group), "_upto": upto})
        place = F.lit(float(q)) * (F.col("_n") - 1)
        low = F.when(F.col("_upto") > F.floor(place), F.col("_v"))
        high = F.when(F.col("_upto") > F.ceil(place), F.col("_v"))
        found = ranked.groupBy(*keys).agg(F.max(place).alias("_p"), F.min(low).alias("_lo"), F.min(high).alias("_hi"))
    else:
        found = _narrowed(known, keys, q)
    answer = F.col("_lo") + (F.col("_p") - F.floor("_p")) * (F.col("_hi") - F.col("_lo"))
    solved = found.select(*keys, answer.alias(out))
    groups = counts.select(*keys).distinct()
    same = [F.col(f"g.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return groups.alias("g").join(solved.alias("s"), same, "left").select(*[F.col(f"g.{k}").alias(b) for b, k in zip(by, keys)], f"s.{out}")


def _narrowed(counts: DataFrame, keys: list[str], q: float) -> DataFrame:
    """(keys, _p, _lo, _hi) by radix refinement: each round cuts a group's range in ``RANGES`` and keeps the one holding the rank.

    A round counts values per (group, range) with partial aggregation, so no task holds
    more of a group than its ranges; it knows each range's least and greatest value, so a
    round either ends a group or narrows it at least by the factor ``RANGES``.
    """
    from dockcast.operators.dims import materialise
    span = counts.groupBy(*keys).agg(F.min("_v").alias("_from"), F.max("_v").alias("_to"), F.sum("_c").alias("_n"))
    open_ = materialise(span.select(*keys, "_from", "_to", F.lit(0).cast("long").alias("_before"),
                                    (F.lit(float(q)) * (F.col("_n") - 1)).alias("_p")))
    done = None
    while not open_.isEmpty():
        same = [F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
        inside = (counts.alias("c").join(open_.alias("o"), same).where("_v >= _from AND _v <= _to")
                  .select(*[f"c.{k}" for k in keys], "_v", "_c", "_from", "_to", "_before", "_p"))
        part = F.when(F.col("_to") > F.col("_from"),
                      F.least(F.floor((F.col("_v") - F.col("_from")) / (F.col("_to") - F.col("_from")) * RANGES), F.lit(RANGES - 1))).otherwise(F.lit(0))
        ranges = inside.groupBy(*keys, "_before", "_p", part.alias("_r")).agg(
            F.sum("_c").alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        w = Window.partitionBy(*keys).orderBy("_r")
        upto = F.col("_before") + F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0))
        placed = ranges.withColumns({"_upto": upto, "_next": F.lead("_least").over(w)}).withColumn("_start", F.col("_upto") - F.col("_c"))
        # the range with the lower rank; the upper rank is in it too, or is the next range's least value
        hit = placed.where((F.floor("_p") >= F.col("_start")) & (F.floor("_p") < F.col("_upto")))
        apart = F.ceil("_p") >= F.col("_upto")
        state = materialise(hit.select(*keys, "_p", "_least", "_most", "_start", "_next", apart.alias("_apart"),
                                       (apart | (F.col("_least") == F.col("_most"))).alias("_done")))
        ended = state.where("_done").select(*keys, "_p", F.col("_most").alias("_lo"),
                                            F.when(F.col("_apart"), F.col("_next")).otherwise(F.col("_most")).alias("_hi"))
        done = ended if done is None else done.unionByName(ended)
        open_ = state.where("NOT _done").select(*keys, F.col("_least").alias("_from"), F.col("_most").alias("_to"), F.col("_start").alias("_before"), "_p")
    return done
