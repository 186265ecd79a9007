"""As-of join of two streams of rows, for any timestamps on either side.

The rows of both sides are put on one time line and cut into chunks of time per
key.  A small chunk table holds the last right row of every chunk; a running
``last`` over it says which right row each chunk starts with.  Inside a chunk one
window finds the last right row before each left row, and rows before the chunk's
first right row take the one carried in.  So a key's history is never in one task:
a chunk with more than ``max_rows`` rows is cut into narrower ones (only that
chunk, not all of them), down to a single instant; the left rows of one crowded
instant all take the same right row, so they need no window and are joined to the
chunk table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.functions.columns import micros
from dockcast.operators.dims import materialise, sized_join

# Chunk widths in microseconds, each tried where the one before leaves too many rows: a day, an hour, a minute, a second, ...
WIDTHS = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)
MAX_ROWS = 1_000_000

_T, _RIGHT, _CHUNK, _WIDTH, _TIE, _FOUND = "_at", "_right", "_chunk", "_width", "_tie", "_found"


def _chunk(width) -> Column:
    w = F.lit(width) if isinstance(width, int) else width
    return F.col(_T) - F.pmod(F.col(_T), w)


def cut(rows: DataFrame, by: list[str], max_rows: int, widths: Sequence[int] = WIDTHS) -> tuple[DataFrame, bool]:
    """``rows`` with the start and width of their chunk, and whether single instants had to be cut out."""
    rows = rows.withColumn(_WIDTH, F.lit(widths[0])).withColumn(_CHUNK, _chunk(widths[0]))
    for width, narrower in zip(widths, widths[1:]):
        full = rows.where(F.col(_WIDTH) == width).groupBy(*by, _CHUNK).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
        crowded = materialise(full.select(*by, _CHUNK, F.lit(True).alias("_crowded")))      # at most rows / max_rows chunks
        if crowded.isEmpty():
            return rows, False
        # chunks of several widths never share a start within a key: a narrower one lies where a wider one was cut
        rows = sized_join(rows, crowded, [*by, _CHUNK], "left", materialize=False)
        here = F.col("_crowded").isNotNull() & (F.col(_WIDTH) == width)
        rows = rows.withColumn(_WIDTH, F.when(here, F.lit(narrower)).otherwise(F.col(_WIDTH))).drop("_crowded")
        rows = rows.withColumn(_CHUNK, _chunk(F.col(_WIDTH)))
    return rows, True


def asof_join(left: DataFrame, right: DataFrame, cols: Sequence[str], left_ts: str = "ts", right_ts: str = "ts",
              by: Sequence[str] = (), ties: Sequence[str] = (), forward: bool = False, exact: bool = True,
              within_seconds: float | None = None, max_rows: int = MAX_ROWS, matched_ts: str | None = None) -> DataFrame:
    """Every left row with ``cols`` of the last right row at or before its time and of the same ``by`` key.

    ``forward`` looks for the first right row at or after it instead.  ``exact=False`` leaves out right rows of the very
    same time, ``within_seconds`` those farther away.  Of right rows with equal time the one with the largest
    ``ties`` counts (with none given, the largest ``cols``).  Rows without a time or with a null in ``by`` match
    nothing; a left row without a match gets nulls.  Times are wall-clock ``timestamp_ntz`` or instants, alike on both
    sides.  ``matched_ts`` names an output column for the matching row's time.
    """
    by, cols, ties = list(by), list(cols), list(ties or cols)
    sign = F.lit(-1 if forward else 1)
    row = F.struct(*[F.col(f"`{c}`").alias(f"_l{i}") for i, c in enumerate(left.columns)])
    usable = F.col(f"`{left_ts}`").isNotNull()
    for b in by:
        usable = usable & F.col(f"`{b}`").isNotNull()
    value = F.struct(*[F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(cols)], F.col(f"`{right_ts}`").alias("_rts"))
    keys = [f"_k{i}" for i in range(len(by))]
    named = [F.col(f"`{b}`").alias(k) for b, k in zip(by, keys)]
    r = right.select(*named, (micros(right_ts) * sign).alias(_T), value.alias(_RIGHT),
                     F.struct(*[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(ties)]).alias(_TIE)).dropna(subset=[_T, *keys])
    lefts = left.select(*named, (micros(left_ts) * sign).alias(_T), row.alias("_left"), usable.alias("_usable"))
    on = lefts.where("_usable").drop("_usable")
    line = on.select("*", F.lit(None).cast(r.schema[_RIGHT].dataType).alias(_RIGHT), F.lit(None).cast(r.schema[_TIE].dataType).alias(_TIE)).unionByName(
        r.withColumn("_left", F.lit(None).cast(lefts.schema["_left"].dataType)))
    chunked, instants = cut(line, keys, max_rows)

    # the last right row of every chunk, and the one each chunk starts with
    known = F.when(F.col(_RIGHT).isNotNull(), F.struct(_T, _TIE))
    table = chunked.groupBy(*keys, _CHUNK).agg(F.max_by(_RIGHT, known).alias("_own"))
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    table = table.select(*keys, _CHUNK, "_own", F.last("_own", ignorenulls=True).over(before).alias("_carried"))
    joined = sized_join(chunked, table, [*keys, _CHUNK], "inner")

    side = F.when(F.col(_RIGHT).isNull() == F.lit(exact), 1).otherwise(0)        # right rows first where equal times match
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(_T, side, _TIE).rowsBetween(Window.unboundedPreceding, 0)
    found = F.coalesce(F.last(_RIGHT, ignorenulls=True).over(inside), F.col("_carried"))
    wide = joined.where(F.col(_WIDTH) > 1) if instants else joined
    result = wide.withColumn(_FOUND, found).where("_left IS NOT NULL").select("_left", _FOUND)
    if instants:
        own = F.coalesce("_own", "_carried") if exact else F.col("_carried")
        crowd = joined.where((F.col(_WIDTH) == 1) & F.col("_left").isNotNull())
        result = result.unionByName(crowd.select("_left", own.alias(_FOUND)))
    rest = lefts.where(~F.col("_usable")).select("_left", F.lit(None).cast(r.schema[_RIGHT].dataType).alias(_FOUND))
    result = result.unionByName(rest)
    if within_seconds is not None:
        ts = F.col(f"_left._l{left.columns.index(left_ts)}")
        far = F.abs(micros(ts) - micros(F.col(f"{_FOUND}._rts"))) > int(within_seconds * 1_000_000)
        result = result.withColumn(_FOUND, F.when(~far, F.col(_FOUND)))
    out = [F.col(f"_left._l{i}").alias(c) for i, c in enumerate(left.columns)]
    out += [F.col(f"{_FOUND}._r{i}").alias(c) for i, c in enumerate(cols)]
    return result.select(*out, *([F.col(f"{_FOUND}._rts").alias(matched_ts)] if matched_ts else []))
