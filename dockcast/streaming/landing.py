"""Rows of a table landed as files in time order, as a feed would deliver them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.functions.columns import micros
from dockcast.operators.dims import materialise


def by_time(df: DataFrame, ts: str, drops: int) -> Column:
    """Number of the delivery (0..drops-1) a row belongs to: equal stretches of the table's time span."""
    lo, hi = df.agg(F.min(micros(ts)), F.max(micros(ts))).first()
    return F.least(F.floor((micros(ts) - F.lit(lo or 0)) * drops / F.lit(max((hi or 0) - (lo or 0), 1))), F.lit(drops - 1)).cast("int")


def land(df: DataFrame, drop: Column, drops: int, folder: str, key: str = "station_id", files: int = 4,
         write: Callable[[DataFrame, str], None] | None = None) -> None:
    """Write ``df`` in ``drops`` deliveries one after another, each as up to ``files`` files dealt by ``key``.

    A file source takes files by age, so deliveries are read in order, and a key's
    rows of one delivery are in one file.
    """
    staged = materialise(df.withColumn("_drop", drop))
    for i in range(drops):
        part = staged.where(F.col("_drop") == i).drop("_drop").repartition(files, key)
        (write or (lambda d, path: d.write.mode("append").parquet(path)))(part, folder)
