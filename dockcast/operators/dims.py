"""Joins with small derived tables, broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.session import table_folder

# A dimension above this many rows is joined by shuffle instead.
BROADCAST_MAX_ROWS = 2_000_000


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job (``Dataset.checkpoint`` would compute the plan twice and store
    Java-serialised rows); the result has a fresh lineage, so a lost executor
    re-reads files instead of recomputing the plan, and counts come from
    Parquet metadata.
    """
    path = table_folder(df.sparkSession)
    df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized_join(big: DataFrame, dim: DataFrame, on, how: str = "left",
               max_rows: int = BROADCAST_MAX_ROWS, materialize: bool = True) -> DataFrame:
    """``big ⋈ dim``: broadcast ``dim`` if its measured row count is small, else shuffle join."""
    d = materialise(dim) if materialize else dim
    n = d.count()
    return big.join(F.broadcast(d) if n <= max_rows else d, on=on, how=how)
