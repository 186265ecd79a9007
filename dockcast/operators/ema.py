"""Exponential moving averages of the previous occupancies (EMA features) as an affine scan.

pandas' ``adjust=False`` rule is a recursion over the known values: a value carries
over nulls while the old weight keeps decaying, so with ``gap`` rows since the value
before, ``y' = (old y + a x) / (old + a)`` with ``old = (1 - a) ** gap``.  That is an
affine step of ``y``, and steps compose, so no task needs a station's whole history:

1. the known values of a station are numbered and cut into blocks of ``BLOCK``;
   each block is one array with the step of every value;
2. ``aggregate`` composes a block's steps into one; its first value then follows
   from the steps of the ``LOOK_BACK`` blocks before (a full block shrinks what came
   before it by ``(1 - a) ** BLOCK`` at least, so older blocks are below the last
   bit of a double; the station's first value has no past and is exact);
3. a second ``aggregate`` replays the block from its start;
4. a row takes the average after the last value known before it: it knows that
   value's number, hence its block and its place in it.

All of it is DataFrame functions.  Only the value column is in the arrays; the wide
rows meet the finished averages once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast import config

ALPHAS = {"occ_ema_fast": config.EMA_FAST_ALPHA, "occ_ema_slow": config.EMA_SLOW_ALPHA}
EMA_COLUMNS = (*ALPHAS, "occ_momentum")
BLOCK = 256
LOOK_BACK = 3
# row number of a row in its station, and values known before it
ROW, BEFORE = "_row", "_before"


def numbered(w: Window, value: str = "occ") -> dict[str, Column]:
    """``ROW`` and ``BEFORE`` over a window that holds a station's rows in order."""
    return {ROW: F.row_number().over(w).cast("long"), BEFORE: F.count(value).over(w.rowsBetween(Window.unboundedPreceding, -1))}


def _step(s: Column, alpha: float) -> tuple[Column, Column]:
    """(A, B) of the step ``y' = A y + B`` for a value ``s.x`` that is ``s.gap`` rows after the one before (null: there is none)."""
    old = F.pow(F.lit(1.0 - alpha), s["gap"])
    return (F.when(s["gap"].isNull(), F.lit(0.0)).otherwise(old / (old + alpha)),
            F.when(s["gap"].isNull(), s["x"]).otherwise(F.lit(alpha) * s["x"] / (old + alpha)))


def averages(rows: DataFrame, keys: list[str], value: str = "occ") -> DataFrame:
    """(keys, _block, _averages): the averages after each known value, in arrays of up to ``BLOCK``.

    ``rows`` has the keys, ``ROW``, ``BEFORE`` and the value.
    """
    known = rows.where(F.col(value).isNotNull()).select(*keys, F.expr(f"{BEFORE} DIV {BLOCK}").alias("_block"),
                                                        F.struct(F.col(ROW).alias("row"), F.col(value).cast("double").alias("x")).alias("_v"))
    blocks = known.groupBy(*keys, "_block").agg(F.sort_array(F.collect_list("_v")).alias("_v"))        # at most BLOCK values
    station = Window.partitionBy(*keys).orderBy("_block")                                             # a row per block
    blocks = blocks.withColumn("_prior", F.lag(F.element_at("_v", -1)["row"]).over(station))
    steps = F.transform("_v", lambda v, i: F.struct(v["x"].alias("x"), (v["row"] - F.when(i == 0, F.col("_prior")).otherwise(
        F.get("_v", i - 1)["row"])).cast("double").alias("gap")))
    blocks = blocks.select(*keys, "_block", steps.alias("_steps"))

    def composed(alpha: float) -> Column:
        def merge(acc, s):
            a, b = _step(s, alpha)
            return F.struct((a * acc["p"]).alias("p"), (a * acc["q"] + b).alias("q"))
        return F.aggregate("_steps", F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("q")), merge)

    whole = blocks.withColumn("_whole", F.struct(*[composed(a).alias(c) for c, a in ALPHAS.items()]))
    past = F.collect_list("_whole").over(station.rowsBetween(-LOOK_BACK, -1))

    def start(c: str) -> Column:
        return F.aggregate("_past", F.lit(0.0), lambda y, w: w[c]["p"] * y + w[c]["q"])

    def replay(y, s):
        now = F.struct(*[sum(_affine(s, a, y["y"][c]), F.lit(0.0)).alias(c) for c, a in ALPHAS.items()])
        return F.struct(now.alias("y"), F.concat(y["out"], F.array(now)).alias("out"))

    pair = "struct<" + ", ".join(f"{c}: double" for c in ALPHAS) + ">"
    begin = F.struct(F.struct(*[start(c).alias(c) for c in ALPHAS]).alias("y"), F.array().cast(f"array<{pair}>").alias("out"))
    return whole.withColumn("_past", past).select(*keys, "_block", F.aggregate("_steps", begin, replay, lambda y: y["out"]).alias("_averages"))


def _affine(s: Column, alpha: float, y: Column) -> tuple[Column, Column]:
    a, b = _step(s, alpha)
    return a * y, b


def with_ema(frame: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """EMA columns on ``frame``, which has ``BEFORE``; ``rows`` are the same rows, narrow (see ``averages``)."""
    names = [f"_key{i}" for i in range(len(keys))]
    table = averages(rows, keys).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "_block", "_averages")
    at = F.col(BEFORE) - 1
    d = frame.withColumn("_at", F.when(at >= 0, F.expr(f"({BEFORE} - 1) DIV {BLOCK}")))
    same = F.col("_at") == F.col("_block")
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    d = d.join(table, same, "left")                       # broadcast by Spark itself where the finished table is small
    y = F.get("_averages", F.pmod(at, F.lit(BLOCK)).cast("int"))
    d = d.withColumns({c: y[c].cast("float") for c in ALPHAS})
    d = d.withColumn("occ_momentum", (F.col("occ_ema_fast") - F.col("occ_ema_slow")).cast("float"))
    return d.drop(*names, "_block", "_averages", "_at", BEFORE, ROW)
