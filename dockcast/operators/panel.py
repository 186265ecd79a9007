"""Panel cleaning: capacity fill, positive-capacity filter, occupancy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.columns import occupancy
from dockcast.operators.sequence import Sequencer

PANEL_COLUMNS = ("ts", "station_id", "bikes_available", "capacity")


def fill_capacity(df: DataFrame, seq: Sequencer) -> DataFrame:
    """Per station: forward fill, then back fill what is still missing.

    A station whose capacity is never known stays null (the extra
    ``fillna(max)`` of the original can only fire in that case, where the
    max is null too, so it is a no-op and is omitted).
    """
    return seq.fill(df, "capacity").withColumn("capacity", F.col("capacity").cast("float"))


def keep_positive_capacity(df: DataFrame) -> DataFrame:
    """Rows with capacity > 0; null capacity is dropped as well."""
    return df.where(F.col("capacity") > 0)


def with_occupancy(df: DataFrame) -> DataFrame:
    return df.withColumn("occ", occupancy(F.col("bikes_available"), F.col("capacity")))


def clean_panel(df: DataFrame, seq: Sequencer) -> DataFrame:
    """The loader's semantics on a DataFrame: fill, filter, occupancy.

    The filter sits on a window result, so Catalyst keeps it above the
    window (it may not be pushed below it).
    """
    return with_occupancy(keep_positive_capacity(fill_capacity(df, seq)))
