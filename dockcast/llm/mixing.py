"""Mixing sources to target weights (operator 6): systematic sampling, DataFrame functions only.

Every document of a source is expected ``rate = target / source_size`` times.
The documents of a source are put in a fixed order, their expected copies are
prefix-summed, one random offset per source is added, and a document is emitted
once per whole number its stretch of the sum crosses.  The order groups documents
of nearly equal size (octave and leading bits of the size), so the words taken
come near the target, not only the number of documents.

The prefix sum never needs a whole source in one task: a source is cut into
blocks (size class, hash part), a small table of block counts gives each block's
start, and a window sums inside one block.

Targets: sources in code-point order, null last, take the weights in turn and
share ``ratio`` times all sizes; a target stops at ``cap`` times its source's size
and the excess is shared again by weight.  That fixed point is found in closed
form: by rising cap per weight, the first so many sources are capped.

Defined cases: a null text has size 0; null sources form one source; equal rows
are interchangeable; sources of size 0 have target 0; empty tables give empty
results; output columns replace input columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import WORD, collapse, materialise

WEIGHTS = (3, 1, 2)
RATIO = 1.5
CAP = 2
SEED = "mix-1"
# Documents per (source, size class, hash part) stay around this number at any scale.
BLOCK_ROWS = 250_000
MIN_PARTS = 8


def text_size(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hex32(text: Column) -> Column:
    """The first 32 bits of the MD5 of a string, as a long."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, ratio: float = RATIO, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Add ``target`` to a frame (source, source_size) with one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    filled = Window.orderBy((F.col("__cap") / F.col("__w")).asc(), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    # level at which sources from this one on are filled if all before it are capped
    level = ((F.sum("source_size").over(everything) * F.lit(float(ratio)) - F.coalesce(F.sum("__cap").over(before), F.lit(0)))
             / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0))))
    return (sizes.withColumn("__rank", F.row_number().over(order) - 1)
            .withColumn("__w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                            (F.col("__rank") % len(weights) + 1).cast("int")))
            .withColumn("__cap", F.col("source_size") * cap)
            .withColumn("__level", level)
            .withColumn("__free", F.col("__level") * F.col("__w") <= F.col("__cap"))
            # the first source that is not capped sets the level of all after it
            .withColumn("__i", F.row_number().over(filled))
            .withColumn("__at", F.min(F.when(F.col("__free"), F.struct("__i", F.col("__level").alias("l")))).over(everything))
            .withColumn("target", F.when(F.col("__at").isNull() | (F.col("__i") < F.col("__at.__i")),
                                         F.col("__cap").cast("double"))
                        .otherwise(F.least(F.col("__at.l") * F.col("__w"), F.col("__cap").cast("double"))))
            .drop("__rank", "__w", "__cap", "__level", "__free", "__i", "__at"))


def mix(df: DataFrame, ratio: float = RATIO, weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``df`` (columns doc_id, source and a long column ``size``) plus source_size, target and ``copies``.

    One row per input row; ``copies`` says how often the mix takes it.
    """
    df = df.drop("source_size", "target", "copies")
    totals = materialise(df.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__docs")))
    parts = F.greatest(F.lit(MIN_PARTS), F.floor(F.sum("__docs").over(Window.partitionBy()) / BLOCK_ROWS)).cast("long")
    targets = materialise(source_targets(totals.withColumn("__parts", parts), ratio, weights, cap)
                          .withColumn("__rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
                          .withColumn("__offset", _hex32(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("source"), F.lit("")))) / F.lit(float(1 << 32)))
                          .withColumn("__src", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
                          .drop("source", "__docs"))
    columns = [c for c in df.columns if c != "size"]
    block = ["__src", "__octave", "__lead", "__part"]
    binary = F.bin(F.col("size"))
    n_parts = targets.agg(F.max("__parts")).first()[0] or MIN_PARTS
    place = {"__src": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")), "__octave": F.length(binary),
             "__lead": F.substring(binary, 1, 4),
             "__part": F.pmod(_hex32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(n_parts))}
    keyed = collapse(df).withColumns(place)
    # counted over the input itself, so that only the few columns that place a row are read
    starts = (df.select("source", "doc_id", "size").withColumns(place).groupBy(*block).agg(F.count(F.lit(1)).alias("__rows"))
              .withColumn("__start", F.sum("__rows").over(Window.partitionBy("__src").orderBy(*block[1:])) - F.col("__rows")).drop("__rows"))
    inside = Window.partitionBy(*block).orderBy("size", *[F.col(f"`{c}`") for c in columns]).rowsBetween(Window.unboundedPreceding, 0)
    rows = (keyed.withColumn("__upto", F.sum("__n").over(inside)).join(starts, block).join(targets, "__src")
            .withColumn("__k", F.explode(F.sequence(F.col("__start") + F.col("__upto") - F.col("__n"), F.col("__start") + F.col("__upto") - 1))))

    def crossed(k):
        return F.floor(F.col("__rate") * k + F.col("__offset"))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], "source_size", "target",
                       (crossed(F.col("__k") + 1) - crossed(F.col("__k"))).alias("copies"))


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``df`` repeated ``copies`` times (``df`` has doc_id, text, source)."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__doc")
    sized = df.select(whole, "doc_id", "source", text_size(F.col("text")).alias("size"))
    return (mix(sized, **options).filter("copies > 0")
            .withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("__doc.*"))


def mix_query(docs: DataFrame) -> DataFrame:
    """Words taken of every document by the contract of op6."""
    sized = docs.select("doc_id", "source", text_size(F.col("text")).alias("size"))
    return mix(sized).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


# The same rule in SQL: sizes, closed-form targets, block order, prefix sum and crossings.
MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), t AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM d GROUP BY source
), w AS (
  SELECT *, ([{WEIGHTS[0]}, {WEIGHTS[1]}, {WEIGHTS[2]}])[(rk % 3 + 1)::INT] AS wt, source_size * {CAP} AS cap FROM t
), l AS (
  SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / wt, source NULLS LAST) AS i, ((sum(source_size) OVER ())::DOUBLE * {RATIO}::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / wt, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(wt) OVER () - coalesce(sum(wt) OVER (ORDER BY cap::DOUBLE / wt, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS lev
  FROM w
), f AS (
  SELECT *, first_value(CASE WHEN lev * wt <= cap THEN lev END IGNORE NULLS) OVER o AS lv,
    first_value(CASE WHEN lev * wt <= cap THEN i END IGNORE NULLS) OVER o AS first_free
  FROM l WINDOW o AS (ORDER BY cap::DOUBLE / wt, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), g AS (
  SELECT source, source_size, CASE WHEN first_free IS NULL OR i < first_free THEN cap::DOUBLE ELSE least(lv * wt, cap::DOUBLE) END AS target,
    ('0x' || substr(md5('{SEED}|' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM f
), r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.u,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size::DOUBLE ELSE 0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY length(bin(d.size)), substr(bin(d.size), 1, 4),
      ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT % greatest({MIN_PARTS}, (SELECT count(*) FROM documents) // {BLOCK_ROWS}),
      d.size, d.doc_id NULLS FIRST) - 1 AS k
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  ((floor(rate * (k + 1) + u) - floor(rate * k + u)) * size)::BIGINT AS taken
FROM r"""
