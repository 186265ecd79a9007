"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.operators.dims import materialise

# A stored side below this many bytes is broadcast, a larger one is shuffle-joined.
BROADCAST_MAX_BYTES = 64 << 20

# Words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a name inside an expression, so that it is computed once per row.

    A lambda that mentions an outer expression evaluates it again for every
    element; a lambda variable is evaluated once.
    """
    return F.transform(F.array(value), body)[0]


def collapse(df: DataFrame, n: str = "__n") -> DataFrame:
    """Rows equal in every column become one row with their count.

    The partial aggregate does this before the shuffle, so a row that makes
    up a third of the table leaves each map task once.
    """
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(n))


def checked_join(big: DataFrame, small: DataFrame, on, how: str, row: int = 64, measure: Column | None = None) -> DataFrame:
    """Join with a stored table: broadcast it only when its measured size fits ``BROADCAST_MAX_BYTES``.

    The size is ``row`` bytes for every counted row, plus the sum of ``measure``
    where rows hold arrays.  Above the limit the join is a shuffle join, whose
    skewed partitions Spark splits.
    """
    rows, more = small.agg(F.count(F.lit(1)), F.sum(F.lit(0) if measure is None else measure)).first()
    if rows * row + (more or 0) <= BROADCAST_MAX_BYTES:
        small = F.broadcast(small)
    return big.join(small, on, how)


__all__ = ["BROADCAST_MAX_BYTES", "WORD", "checked_join", "collapse", "let", "materialise", "table"]
