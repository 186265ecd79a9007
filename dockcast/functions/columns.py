"""Column expressions shared by the operators (all JVM-side, codegen-able)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockcast import config

__all__ = [
    "EPOCH", "micros", "from_micros", "floor_ts", "clip01", "clip", "occupancy",
    "occupancy_serving", "hour_of", "weekday_of", "calendar_columns", "rain_flag",
    "quantize", "utc_normalise", "try_utc", "gamma_for", "delta_to_bikes", "utc_stamp",
]

def EPOCH() -> Column:
    """The epoch as timestamp_ntz (a function: columns need an active session)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

_US_PER_S = 1_000_000
# ISO-8601 text that ends in a zone
_ZONED = r"[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a wall-clock (UTC) timestamp.

    Works on ``timestamp_ntz`` without touching the session time zone.
    """
    return F.timestamp_diff("MICROSECOND", EPOCH(), F.col(ts) if isinstance(ts, str) else ts)


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, EPOCH())


def floor_ts(ts: Column | str, seconds: int) -> Column:
    """Floor a timestamp_ntz to a multiple of ``seconds`` (time-zone free)."""
    m = micros(ts)
    step = seconds * _US_PER_S
    return from_micros(m - F.pmod(m, F.lit(step)))


def clip(x: Column, lo: Column | float, hi: Column | float) -> Column:
    """clip(x, lo, hi) that keeps null, like pandas (Spark's least/greatest skip nulls)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    return F.when(x.isNotNull(), F.least(F.greatest(x, lo_c), hi_c))


def clip01(x: Column) -> Column:
    return clip(x, 0.0, 1.0)


def occupancy(bikes: Column, capacity: Column) -> Column:
    """occ = clip(bikes / capacity, 0, 1) as float; null bikes stay null.

    ``try_divide`` keeps the expression safe under ANSI mode even if a plan
    evaluates it before the positive-capacity filter.
    """
    ratio = F.try_divide(bikes.cast("double"), capacity.cast("double"))
    return clip01(ratio).cast("float")


def occupancy_serving(bikes: Column, capacity: Column) -> Column:
    """Serving twin: missing or non-positive capacity gives 0.0."""
    cap = capacity.cast("double")
    return F.when(cap > 0, F.coalesce(clip01(bikes.cast("double") / cap), F.lit(0.0))).otherwise(F.lit(0.0))


def hour_of(ts: Column) -> Column:
    return F.hour(ts)


def weekday_of(ts: Column) -> Column:
    """Day of week with Monday = 0 (Spark ``weekday``)."""
    return F.weekday(ts)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """hour, dow, is_weekend and the 24 h / 12 h harmonics, as stored types."""
    h = hour_of(ts)
    hd = h.cast("double")
    return {
        "hour": h.cast("byte"),
        "dow": weekday_of(ts).cast("byte"),
        "is_weekend": (weekday_of(ts) >= 5).cast("byte"),
        "hour_sin": F.sin(F.lit(2 * math.pi) * hd / 24).cast("float"),
        "hour_cos": F.cos(F.lit(2 * math.pi) * hd / 24).cast("float"),
        "hour_sin2": F.sin(F.lit(4 * math.pi) * hd / 24).cast("float"),
        "hour_cos2": F.cos(F.lit(4 * math.pi) * hd / 24).cast("float"),
    }


def rain_flag(precipitation: Column) -> Column:
    """1 when precipitation > threshold, null counts as dry."""
    return F.coalesce(precipitation > F.lit(config.RAIN_THRESHOLD_MM), F.lit(False)).cast("int")


def quantize(x: Column, bits: int = 20) -> Column:
    """Round to a multiple of 2**-bits (exact scaling; used for result checks)."""
    s = float(2 ** bits)
    return (F.floor(x.cast("double") * s + 0.5) / s).cast("double")


def utc_normalise(s: Column) -> Column:
    """ISO-8601 text -> UTC wall-clock timestamp_ntz, independent of the session zone.

    Naive text is taken as UTC; text with a zone suffix (Z, +02:00) names an
    instant, which is converted to its UTC wall clock.
    """
    return F.when(s.rlike(_ZONED), from_micros(F.unix_micros(F.to_timestamp(s)))).otherwise(F.to_timestamp_ntz(s))


def try_utc(s: Column) -> Column:
    """``utc_normalise`` with null for text that is no time, under any ANSI setting."""
    return F.when(s.rlike(_ZONED), from_micros(F.unix_micros(s.try_cast("timestamp")))).otherwise(s.try_cast("timestamp_ntz"))


def gamma_for(gammas: Column, horizon: Column) -> Column:
    """gamma[h] from a map<string,double>; missing, null or 0 -> 1.0."""
    g = F.try_element_at(gammas, horizon.cast("string"))
    return F.coalesce(F.nullif(g, F.lit(0.0)), F.lit(1.0))


def delta_to_bikes(delta: Column, capacity: Column, target_kind: Column | str = "delta_occ") -> Column:
    kind = F.lit(target_kind) if isinstance(target_kind, str) else target_kind
    return F.when(kind == "delta_occ", delta * capacity).otherwise(delta)


def utc_stamp(ts: Column) -> Column:
    """Compact UTC stamp used in snapshot file names, e.g. 20240101T000000Z."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")
