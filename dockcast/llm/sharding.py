"""Sharding (operator 8): a Feistel permutation with cycle walking over global row numbers.

Every row gets a number 0..N-1 that depends on the rows alone (not on files,
partitions or task order): rows are ordered by a hash bucket of all their
columns and then by the columns.  A keyed Feistel network permutes the
numbers; values that fall outside 0..N-1 walk the cycle until they return.
Position p of the shuffle is slot ``p // shards`` of shard ``p % shards``, so
shard sizes differ by one row at most, slots have no gaps, and both directions
(row number -> place, place -> row number) are plain arithmetic.

Defined cases: a null in any column is a value like any other; equal rows are
interchangeable and each gets a place of its own; an empty table gives an empty
result; a column of the input named like an output column is replaced.  Equal
texts are not held together: the law is ``rows``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import collapse

SHARDS = 8
SEED = 20240229
ROUNDS = 6
# Rows are numbered bucket by bucket; the table of bucket counts never has more rows than this.
BUCKETS = 8192

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijective 64-bit mixing of each value."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Permutation:
    """Keyed bijection of 0..n-1 (vectorised over numpy arrays)."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = _mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                         + np.uint64(seed % (1 << 64)))

    def _round(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        return _mix(right + key) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ self._round(left, key), left
            else:
                left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        x = np.array(x, dtype=np.uint64)
        if not len(x):
            return x.astype(np.int64)
        x = self._once(x, back)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def forward(self, x) -> np.ndarray:
        """Shuffled position of each row number."""
        return self._walk(x, False)

    def inverse(self, p) -> np.ndarray:
        """Row number at each shuffled position."""
        return self._walk(p, True)


def number_rows(df: DataFrame, out: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with a global row number 0..N-1 in ``out``, and N.

    One pass counts the buckets (a bounded table, prefix-summed), one shuffle
    orders each bucket.  Equal rows travel as one row with a count.
    """
    df = df.drop(out)
    names = [F.col(f"`{c}`") for c in df.columns]
    bucket = F.pmod(F.xxhash64(F.lit(SEED), *names), F.lit(BUCKETS)).cast("int")
    starts = (df.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows"))
              .withColumn("__start", F.sum("__rows").over(Window.orderBy("__bucket")) - F.col("__rows")))
    n = starts.agg(F.sum("__rows")).first()[0] or 0
    within = Window.partitionBy("__bucket").orderBy(*names)
    rows = (collapse(df).withColumn("__bucket", bucket)
            .withColumn("__first", F.sum("__n").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n"))
            .join(F.broadcast(starts.drop("__rows")), "__bucket")       # at most BUCKETS rows
            .withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))))
    return rows.select(*names, (F.col("__start") + F.col("__first") + F.col("__copy")).alias(out)), n


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` plus ``shard`` (int, 0..shards-1) and ``slot`` (long, 0.. without gaps in each shard)."""
    numbered, n = number_rows(df.drop("shard", "slot"), "__row")
    permutation = Permutation(n, seed)

    @F.pandas_udf("long")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(permutation.forward(x.to_numpy()))

    return (numbered.withColumn("__at", place("__row"))
            .withColumn("shard", F.pmod(F.col("__at"), F.lit(shards)).cast("int"))
            .withColumn("slot", F.expr(f"__at div {int(shards)}"))
            .drop("__row", "__at"))


def shard_query(docs: DataFrame) -> DataFrame:
    """The documents' places by the contract of op8; a null text has size 1 and the checksum of no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return (shard_rows(rows).withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
