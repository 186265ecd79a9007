"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB oracle each.

Every query reads the driver tables through ``Ctx`` and returns a lazy
DataFrame.  ``spec`` fixes the output columns and their types on both sides;
float results are rounded to 2**-20 on both sides so the comparison is not
at the mercy of summation order.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions.columns import quantize
from dockcast.plans.context import Ctx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SPECS: dict[str, list[tuple[str, str]]] = {}

_SPARK_KIND = {"i": "int", "l": "bigint", "s": "string", "t": "timestamp_ntz", "b": "boolean"}
_SQL_KIND = {"i": "INTEGER", "l": "BIGINT", "s": "VARCHAR", "t": "TIMESTAMP", "b": "BOOLEAN"}
_SCALE = "CAST(1048576 AS DOUBLE)"


def spark_out(df: DataFrame, spec) -> DataFrame:
    cols = []
    for name, kind in spec:
        c = F.col(name)
        cols.append((quantize(c) if kind == "q" else c.cast(_SPARK_KIND[kind])).alias(name))
    return df.select(*cols)


def sql_out(spec, prefix: str = "") -> str:
    parts = []
    for name, kind in spec:
        x = f"{prefix}{name}"
        if kind == "q":
            parts.append(f"floor(CAST({x} AS DOUBLE) * {_SCALE} + CAST(0.5 AS DOUBLE)) / {_SCALE} AS {name}")
        else:
            parts.append(f"CAST({x} AS {_SQL_KIND[kind]}) AS {name}")
    return ", ".join(parts)


def register(name: str, spec, sql: str | None = None):
    """``sql`` may contain ``{out}`` where the typed output projection goes."""
    def deco(fn: Callable[[Ctx], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return spark_out(fn(Ctx(spark, sf_dir)), spec)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        SPECS[name] = list(spec)
        if sql is not None:
            ORACLE[name] = sql.replace("{out}", sql_out(spec))
        return fn
    return deco


KEYS = [("station_id", "s"), ("ts", "t"), ("event_id", "l")]
