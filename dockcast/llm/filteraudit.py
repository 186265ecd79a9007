"""Filter interaction audit (operator 11): Lehmer-rank difference arrays over all filter orders.

Every document is reduced to a mask of the filters it fails.  An order of the
filters is a permutation, named by its lexicographic (Lehmer) rank.  What happens
to a mask at step ``k`` depends on the first ``k`` letters only, and the
permutations that begin with given letters are one interval of ranks.  So a mask
adds its document counts at the start of each such interval and takes them off
after its end; a prefix sum over the ranks then gives every order's totals.  The
work on documents is one pass; the audit itself works on masks.

Filters (a null text is empty; words are runs of anything but ASCII white space):
A fewer than ``MIN_WORDS`` words; B distinct words under ``MIN_DISTINCT`` percent;
C capitals A-Z over ``MAX_CAPITALS`` percent of the code points; D any of ``SYMBOLS``;
E the same text as a document of smaller doc_id, anywhere in the table.

Equal texts are found by their SHA-256.  A text is never grouped whole: rows are
pre-aggregated per (text, part, mask, label), so a text that makes up a third of
the table is one row per such group.

Defined cases: a null lang is the part ``''``; a null doc_id has no labels, and is
neither smaller nor larger than any other; rows of one doc_id and text do not make
each other fail E; several label rows of one doc_id count when any says 1, a null
label is not 1; a null in n_chars or source plays no part; an empty table gives an
empty result; extra columns, clashing names included, are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockcast.llm.common import WORD, collapse, materialise

LETTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_CAPITALS = 3
SYMBOLS = "[#$%&*|]"
# Rows without a doc_id are spread over this many keys when labels are joined.
NULL_KEYS = 1024

COUNTS = ["removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def orders() -> list[str]:
    """All orders of the filters; the index is the Lehmer rank."""
    return ["".join(p) for p in permutations(LETTERS)]


def intervals() -> list[tuple[int, int, int, int, int, int, int]]:
    """(mask, step, first rank, end rank, removes, redundant, unique) of every mask and order prefix that ends in a letter it fails.

    A fixed table: 32 masks times the 325 prefixes, about half of which apply.
    """
    rank = {}
    for i, p in enumerate(orders()):
        for k in range(1, len(LETTERS) + 1):
            rank.setdefault(p[:k], i)
    out = []
    for mask in range(1 << len(LETTERS)):
        for prefix, lo in rank.items():
            if mask & _bit(prefix[-1]):
                earlier = any(mask & _bit(c) for c in prefix[:-1])
                out.append((mask, len(prefix), lo, lo + factorial(len(LETTERS) - len(prefix)),
                            int(not earlier), int(earlier), int(mask == _bit(prefix[-1]))))
    return out


def _interval_table(spark: SparkSession) -> DataFrame:
    names = ["mask", "step", "lo", "hi", "removes", "redundant", "unique"]
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*intervals()))))))


def text_mask(words: Column, text: Column) -> Column:
    """Bits of the filters A to D that a text with these words fails."""
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < MIN_WORDS, F.size(F.array_distinct(words)) * 100 < n * MIN_DISTINCT,
             capitals.cast("long") * 100 > F.length(text).cast("long") * MAX_CAPITALS, text.rlike(SYMBOLS)]
    mask = F.lit(0)
    for letter, f in zip(LETTERS, fails):
        mask = mask + F.when(f, F.lit(_bit(letter))).otherwise(F.lit(0))
    return mask


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): document counts of every mask in every part."""
    rows = (docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
            .select("doc_id", "part", "text", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"))
            .select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("h"), text_mask(F.col("words"), F.col("text")).alias("mask")))
    says = (labels.groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
                                         F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
            .withColumn("key", F.lit(0).cast("long")))
    known = (collapse(rows, "n").withColumn("key", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("h"), F.lit(NULL_KEYS)) + 1)
                                            .otherwise(F.lit(0).cast("long")))
             .join(says, ["doc_id", "key"], "left").fillna(0, ["good", "toxic"]))
    # per text and kind of row: all rows, rows without an id, and those of the smallest id
    kinds = (known.groupBy("h", "part", "mask", "good", "toxic")
             .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(F.lit(0))).alias("nameless"),
                  F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least")))
    first = F.min("least.doc_id").over(Window.partitionBy("h"))
    firsts = kinds.withColumn("firsts", F.col("nameless") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(F.lit(0)))
    parts = F.array(F.struct(F.col("mask").alias("mask"), F.col("firsts").alias("n")),
                    F.struct((F.col("mask") + _bit("E")).alias("mask"), (F.col("n") - F.col("firsts")).alias("n")))
    return (firsts.select("part", "good", "toxic", F.explode(parts).alias("x"))
            .groupBy("part", F.col("x.mask").alias("mask"))
            .agg(F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic")))


def audit(masks: DataFrame) -> DataFrame:
    """The totals of every part, order and step from mask counts (part, mask, n, good, toxic).

    ``masks`` is read twice; a stored table is best.
    """
    spark = masks.sparkSession
    n_orders = factorial(len(LETTERS))
    table = F.broadcast(_interval_table(spark))                       # fixed size: some 5,200 rows
    hits = masks.join(table, "mask")
    weight = {"removed": F.col("n") * F.col("removes"), "redundant": F.col("n") * F.col("redundant"), "unique_fails": F.col("n") * F.col("unique"),
              "good_lost": F.col("good") * F.col("removes"), "toxic_lost": F.col("toxic") * F.col("removes")}
    ends = F.explode(F.array(F.struct(F.col("lo").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("hi").alias("rank"), F.lit(-1).alias("sign"))))
    steps = (hits.select("part", "step", *[weight[c].alias(c) for c in COUNTS], ends.alias("end"))
             .select("part", "step", "end.rank", *[(F.col(c) * F.col("end.sign")).alias(c) for c in COUNTS])
             .filter(F.col("rank") < n_orders))
    whole = masks.groupBy("part").agg(F.sum("n").alias("total"))
    grid = (whole.select("part", "total", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
            .select("part", "total", "step", F.explode(F.sequence(F.lit(0), F.lit(n_orders - 1))).alias("rank")))
    differences = (steps.withColumn("total", F.lit(0).cast("long"))
                   .unionByName(grid.select("*", *[F.lit(0).cast("long").alias(c) for c in COUNTS]))
                   .groupBy("part", "step", "rank").agg(F.sum("total").alias("total"), *[F.sum(c).alias(c) for c in COUNTS]))
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = differences.select("part", "step", "rank", "total", *[F.sum(c).over(along).alias(c) for c in COUNTS])
    gone = F.sum("removed").over(Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    order = F.element_at(F.array(*[F.lit(p) for p in orders()]), (F.col("rank") + 1).cast("int"))
    named = (summed.withColumn("kept", F.col("total") - gone).withColumn("filter_order", order)
             .withColumn("letter", F.expr("substring(filter_order, int(step), 1)")))
    return named.select("part", "filter_order", F.col("step").cast("int").alias("step"), "kept", *COUNTS,
                        F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley"))


def audit_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit by the contract of op11."""
    return audit(materialise(document_masks(docs, labels)))


# The same totals by applying every order to every mask, without intervals.
AUDIT_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '{WORD.replace(chr(92) * 2, chr(92))}') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d
), m AS (
  SELECT doc_id, part, (len(ws) < {MIN_WORDS})::INT * 1 + (100 * len(list_distinct(ws)) < {MIN_DISTINCT} * len(ws))::INT * 2
    + (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_CAPITALS} * length(t))::INT * 4
    + regexp_matches(t, '{SYMBOLS}')::INT * 8 + coalesce(doc_id > least, false)::INT * 16 AS mask FROM w
), l AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id
), g AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b
), p AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a JOIN f b ON b.x <> a.x JOIN f c ON c.x NOT IN (a.x, b.x) JOIN f d ON d.x NOT IN (a.x, b.x, c.x)
  JOIN f e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), s AS (
  SELECT filter_order, step, bits[step] AS b, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS earlier
  FROM p, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
), r AS (
  SELECT part, filter_order, step, b, sum(CASE WHEN mask & (earlier | b) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & b > 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & b > 0 AND mask & earlier > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = b THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & b > 0 AND mask & earlier = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & b > 0 AND mask & earlier = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, b
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley FROM r
"""
