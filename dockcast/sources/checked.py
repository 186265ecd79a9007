"""File readers that set broken records aside instead of failing or turning them into nulls.

A checked frame has the declared columns, ``reject`` (why a record cannot be used,
null for good ones) and ``raw`` (the record's text, only of rejected ones).  Nothing
is dropped: ``good`` and ``rejects`` split it, ``reject_counts`` sums it up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast import config
from dockcast.functions.columns import try_utc
from dockcast.sources.weather_json import HOURLY_SCHEMA

REJECT, RAW, _BAD = "reject", "raw", "_corrupt_record"


def _first_reason(reasons: Sequence[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(wrong, F.lit(text)) for wrong, text in reasons], F.lit(None).cast("string"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """CSV file(s) with a header, columns by name in any order (others are not read), checked record by record.

    Rejected are, in this order: records with another number of fields than the header, times and numbers that are not
    empty and cannot be read, records without a value in a ``required`` column.  Times become UTC.
    """
    header = spark.read.option("header", True).csv(path).columns
    lines = T.StructType([*[T.StructField(c, T.StringType()) for c in header], T.StructField(_BAD, T.StringType())])
    # whole records are parsed, else their number of fields is not known
    text = (spark.read.schema(lines).option("header", True).option("enforceSchema", False).option("columnPruning", False)
            .option("columnNameOfCorruptRecord", _BAD).csv(path))
    values, reasons = {}, [(F.col(_BAD).isNotNull(), "fields differ from the header")]
    for f in schema.fields:
        c = F.nullif(F.trim(F.col(f"`{f.name}`")), F.lit(""))
        if isinstance(f.dataType, T.TimestampNTZType):
            v = try_utc(c)
        elif isinstance(f.dataType, T.StringType):
            v = c
        else:
            v = c.try_cast(f.dataType)
        values[f.name] = v
        reasons.append((c.isNotNull() & v.isNull(), f"unreadable {f.name}"))
    reasons += [(values[c].isNull(), f"no {c}") for c in required]
    reject = _first_reason(reasons)
    raw = F.when(reject.isNotNull(), F.coalesce(F.col(_BAD), F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in header])))
    return text.select(*[v.alias(c) for c, v in values.items()], reject.alias(REJECT), raw.alias(RAW))


def read_hourly_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Hourly rows of columnar weather documents, one per line (or per file), checked.

    A document that is no JSON, has no times, or arrays of other lengths than its times is rejected whole; in the
    others each row whose time cannot be read.  A variable that a document lacks is null.
    """
    schema = T.StructType([*HOURLY_SCHEMA.fields, T.StructField(_BAD, T.StringType())])
    docs = (spark.read.schema(schema).option("multiLine", multi_line).option("columnNameOfCorruptRecord", _BAD).json(path))
    h = F.col("hourly")
    uneven = F.lit(False)
    for c in config.WEATHER_COLS:
        uneven = uneven | F.coalesce(F.size(h[c]) != F.size(h["time"]), F.lit(False)) & h[c].isNotNull()
    why = _first_reason([(F.col(_BAD).isNotNull(), "not a document"), (h["time"].isNull(), "no times"), (uneven, "arrays of unequal length")])
    checked = docs.select(why.alias("_why"), F.coalesce(F.col(_BAD), F.to_json(F.struct("hourly"))).alias("_text"), "hourly")
    absent = F.array_repeat(F.lit(None).cast("double"), F.size(h["time"]))
    zipped = F.arrays_zip(h["time"].alias("time"), *[F.coalesce(h[c], absent).alias(c) for c in config.WEATHER_COLS])
    one = F.array(F.struct(F.lit(None).cast("string").alias("time"), *[F.lit(None).cast("double").alias(c) for c in config.WEATHER_COLS]))
    rows = checked.select("_why", "_text", F.inline(F.when(F.col("_why").isNull(), zipped).otherwise(one)))
    ts = try_utc(F.col("time"))
    reject = F.coalesce(F.col("_why"), F.when(ts.isNull(), F.lit("unreadable time")))
    raw = F.when(F.col("_why").isNotNull(), F.col("_text")).otherwise(F.when(ts.isNull(), F.coalesce("time", F.lit(""))))
    return rows.select(ts.alias("ts"), *config.WEATHER_COLS, reject.alias(REJECT), raw.alias(RAW))


def good(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REJECT).isNull()).drop(REJECT, RAW)


def rejects(checked: DataFrame) -> DataFrame:
    """(reject, raw) of the records set aside."""
    return checked.where(F.col(REJECT).isNotNull()).select(REJECT, RAW)


def reject_counts(checked: DataFrame) -> DataFrame:
    return rejects(checked).groupBy(REJECT).agg(F.count(F.lit(1)).alias("n"))
