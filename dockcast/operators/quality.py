"""Data-quality summaries, top-k reports and deterministic samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.operators.dims import materialise, sized_join
from dockcast.operators.quantile import exact_quantile


def station_variance(panel: DataFrame, value: str = "bikes_available") -> DataFrame:
    """Sample variance per station (null for a single row)."""
    return panel.groupBy("station_id").agg(F.var_samp(value).alias("var_bikes"))


def top_variance(panel: DataFrame, n: int = 200, value: str = "bikes_available") -> DataFrame:
    """The n most variable stations (nulls last, ties by id): a top-k, bounded by n."""
    v = station_variance(panel, value)
    return v.orderBy(F.desc_nulls_last("var_bikes"), F.asc("station_id")).limit(n)


def dev_sample(panel: DataFrame, n: int = 200, share: float | None = None) -> DataFrame:
    """Rows of the n most variable stations, or of that ``share`` of them (left semi join with their keys)."""
    if share is None:
        return panel.join(F.broadcast(top_variance(panel, n).select("station_id")), "station_id", "left_semi")   # n rows, bounded by n
    v = materialise(station_variance(panel))
    top = v.orderBy(F.desc_nulls_last("var_bikes"), F.asc("station_id")).limit(int(v.count() * share)).select("station_id")
    return sized_join(panel, top, "station_id", "left_semi")


def panel_counts(panel: DataFrame, approx: bool = False) -> DataFrame:
    """Rows and distinct stations (exact; ``approx=True`` uses a HyperLogLog sketch)."""
    n = F.approx_count_distinct("station_id") if approx else F.countDistinct("station_id")
    return panel.agg(F.count(F.lit(1)).alias("n_rows"), n.alias("n_stations"))


def occ_summary(panel: DataFrame, col: str = "occ") -> DataFrame:
    """min / mean / exact median / max; the median is selected without a
    single-task value map (see ``exact_quantile``).  The one column is stored
    once, so the panel's plan runs once, not for every pass of the median."""
    narrow = materialise(panel.select(col))
    basic = narrow.agg(F.min(col).cast("double").alias("occ_min"), F.avg(col).alias("occ_mean"),
                       F.max(col).cast("double").alias("occ_max"))
    med = exact_quantile(narrow, F.col(col), 0.5, out="occ_median").select("occ_median")
    return basic.crossJoin(med).select("occ_min", "occ_mean", "occ_median", "occ_max")


def null_rates(frame: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, null_rate, n_null)`` for each column, from one aggregate."""
    aggs = []
    for c in cols:
        isnull = F.col(c).isNull().cast("int")
        aggs += [F.avg(isnull).alias(f"r__{c}"), F.sum(isnull).cast("long").alias(f"n__{c}")]
    row = frame.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"r__{c}").alias("null_rate"),
                        F.col(f"n__{c}").alias("n_null")) for c in cols]
    return row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def top_null_features(frame: DataFrame, cols: list[str], n: int = 5) -> DataFrame:
    return null_rates(frame, cols).orderBy(F.desc("null_rate"), F.asc("feature")).limit(n)


def quality_check(frame: DataFrame, required: list[str]) -> DataFrame:
    """Per required column: present in the schema, null count; plus range
    violations of occ and capacity — one aggregate pass."""
    present = [c for c in required if c in frame.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"n__{c}") for c in present]
    if "occ" in frame.columns:
        aggs.append(F.sum(((F.col("occ") < 0) | (F.col("occ") > 1)).cast("long")).alias("_occ_bad"))
    if "capacity" in frame.columns:
        aggs.append(F.sum((F.col("capacity") <= 0).cast("long")).alias("_cap_bad"))
    row = frame.agg(*aggs)
    structs = []
    for c in required:
        ok = c in present
        # an absent column counts as entirely missing
        nulls = (F.coalesce(F.col(f"n__{c}"), F.lit(0)) if ok else F.col("_rows")).cast("long")
        bad = (F.coalesce(F.col("_occ_bad"), F.lit(0)) if (c == "occ" and "_occ_bad" in row.columns)
               else F.coalesce(F.col("_cap_bad"), F.lit(0)) if (c == "capacity" and "_cap_bad" in row.columns)
               else F.lit(0)).cast("long")
        structs.append(F.struct(F.lit(c).alias("column_name"), F.lit(ok).alias("present"),
                                F.col("_rows").cast("long").alias("n_rows"), nulls.alias("n_null"),
                                bad.alias("n_out_of_range")))
    return row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def first_rows(frame: DataFrame, n: int, order=("station_id", "ts"), tiebreak=()) -> DataFrame:
    """Deterministic head(n) by (station, ts): a top-k, never a global sort."""
    return frame.orderBy(*order, *tiebreak).limit(n)
