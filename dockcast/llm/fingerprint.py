"""Document fingerprints (operator 4): winnowing, DataFrame functions only.

A text is cut into tokens: runs of non-white-space of at most ``TOKEN`` characters, and of
longer runs (texts without spaces, code, encoded data) every character, so that equal passages have
equal tokens wherever they stand in such a run.  Every run of ``K`` tokens gets a
rolling cyclic-polynomial hash, built by doubling: hashes of 2 tokens from those of
1, of 4 from those of 2.  In every window of ``W`` consecutive hashes the smallest is
chosen, the rightmost of equal ones, again by doubling; what is chosen is kept once,
with its position.  Two texts that share ``K + W - 1`` tokens in a row therefore share a
chosen hash: in an unspaced run that many characters, elsewhere that many words of at most ``TOKEN``
characters (``(K + W - 1) * (TOKEN + 1)`` characters with single spaces, and a word cut off at either end).
No shared run shorter than ``K`` tokens is ever reported.

Short texts have a window of one: up to ``SHORT`` hashes all are kept, so that likeness has more than two values; what
a longer text chooses from a shared run is among them, so the guarantee holds between both.

Defined cases: a text of fewer than ``K`` tokens has one hash of all its tokens; a text without tokens, empty or null
has the empty fingerprint.  Two empty fingerprints are alike (1), an empty and another
are not (0).  Likeness is the Jaccard similarity of the sets of hashes.  Repeated rows each
get a row; a very long text is one row of arrays as long as its tokens; an empty table gives an
empty result; extra columns, clashing names included, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import let, materialise

TOKEN = 16
K = 4            # tokens per hash; a power of two
W = 8            # hashes per window; a power of two
SHORT = 24       # texts of at most so many hashes keep them all
POSITION_BITS = 28

# Rows per block of consecutive rows, and the most blocks wanted: the table of blocks stays small at any scale.
BLOCK_ROWS = 256
MAX_BLOCKS = 100_000
# A block of more than so many times the rows wanted is cut again.
CROWDED = 4


def _paired(a: Column, step: int, f) -> Column:
    """``f(a[i], a[i + step])`` for all i for which both exist."""
    keep = F.greatest(F.size(a) - step, F.lit(0))
    return F.slice(F.zip_with(a, F.slice(a, step + 1, keep), f), F.lit(1), keep)


def _rotate(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def _hashes(tokens: Column, k: int) -> Column:
    """Rolling hashes of all runs of ``k`` tokens, or one of all tokens when there are fewer."""
    def doubled(a, step):
        if step >= k:
            return a
        return let(_paired(a, step, lambda x, y: _rotate(x, step).bitwiseXOR(y)), lambda b: doubled(b, step * 2))
    full = let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: doubled(h, 1))
    return (F.when(F.size(tokens) >= k, full)
            .when(F.size(tokens) > 0, F.array(F.xxhash64(F.array_join(tokens, " "))))
            .otherwise(F.array().cast("array<long>")))


def _minima(hashes: Column, w: int) -> Column:
    """Hash and position of every window's rightmost minimum, each once, in order."""
    mask = (1 << POSITION_BITS) - 1
    packed = F.transform(hashes, lambda x, i: F.shiftleft(F.shiftrightunsigned(x, POSITION_BITS + 1), POSITION_BITS)
                         .bitwiseOR(F.lit(mask).cast("long") - i))

    def doubled(a, step):
        if step >= w:
            return a
        return let(_paired(a, step, lambda x, y: F.least(x, y)), lambda b: doubled(b, step * 2))
    chosen = let(packed, lambda p: F.when(F.size(p) > max(w, SHORT), doubled(p, 1)).otherwise(p))

    def entry(v):
        at = F.lit(mask).cast("long") - v.bitwiseAND(F.lit(mask).cast("long"))
        return F.struct(F.get(hashes, at.cast("int")).alias("hash"), at.cast("int").alias("pos"))
    return F.transform(F.array_distinct(chosen), entry)


def fingerprint(text: Column, k: int = K, w: int = W, token: int = TOKEN) -> Column:
    """Array of struct (hash long, pos int): the chosen hashes of a text and the token each starts at."""
    word = r"[^\x20\x09-\x0D]"
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(?<!{word}){word}{{1,{token}}}+(?!{word})|{word}"), F.lit(0))
    return let(tokens, lambda t: let(_hashes(t, k), lambda h: _minima(h, w)))


def as_text(fp: Column) -> Column:
    """``hash:position`` entries joined by commas."""
    return F.array_join(F.transform(fp, lambda e: F.concat(F.lower(F.hex(e["hash"])), F.lit(":"), e["pos"].cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes."""
    x, y = F.transform(a, lambda e: e["hash"]), F.transform(b, lambda e: e["hash"])
    return let(F.size(F.array_union(x, y)).cast("double"),
               lambda n: F.when(n == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / n))


def _cut(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``__hash`` of the text and ``__block``: ranges of (key, hash) of about equally many rows.

    Blocks are first equal ranges of the key.  Blocks with many more rows than wanted, as keys stand
    close together, are cut again between their own smallest and largest key, those of a single key
    (ties, nulls) between their smallest and largest hash, until no such block can be cut: only
    rows equal in both stay together, however many.  Every round is one grouped count; the table of blocks to cut has at
    most ``MAX_BLOCKS / CROWDED`` rows.
    """
    hashed = docs.withColumn("__hash", F.xxhash64("text"))
    low, high, rows = docs.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    blocks = max(1, min(MAX_BLOCKS, rows // BLOCK_ROWS))
    wanted = max(1, rows // blocks)
    pieces = max(4, blocks)
    low, width = (0, 1) if low is None else (low, (high - low) // pieces + 1)
    # quotients before differences: keys may lie anywhere in 64 bits
    placed = hashed.withColumn("__block", F.coalesce(F.expr(f"`{key}` div {width}L - cast('{low}' AS bigint) div {width}L"), F.lit(-1).cast("long")))
    free = pieces + 3
    while True:
        counts = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("k0"), F.max(key).alias("k1"),
                                               F.min("__hash").alias("h0"), F.max("__hash").alias("h1"))
        by_key = F.coalesce(F.col("k0") < F.col("k1"), F.lit(False))
        crowded = counts.filter((F.col("n") > CROWDED * wanted) & (by_key | (F.col("h0") < F.col("h1"))))
        parts = F.greatest(F.expr(f"n div {wanted}L"), F.lit(4).cast("long"))
        ends = F.when(by_key, F.struct(F.col("k0").alias("a"), F.col("k1").alias("b"))).otherwise(F.struct(F.col("h0").alias("a"), F.col("h1").alias("b")))
        before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        again = materialise(crowded.withColumn("parts", parts).withColumn("ends", ends).withColumn("by_key", by_key)
                            .withColumn("step", F.expr("cast((cast(ends.b AS decimal(20)) - cast(ends.a AS decimal(20))) div parts AS bigint) + 1"))
                            .withColumn("last", F.sum(F.col("parts") + 3).over(before))
                            .select("__block", "by_key", "step", F.expr("ends.a div step").alias("from"),
                                    (F.col("last") - F.col("parts") - 3 + free).alias("base"), (F.col("last") + free).alias("top")))
        top = again.agg(F.max("top")).first()[0]
        if top is None:
            return placed
        free = top
        place = F.expr(f"CASE WHEN by_key THEN `{key}` ELSE __hash END div step - `from` + base")
        placed = (placed.join(F.broadcast(again), "__block", "left")
                  .withColumn("__block", F.coalesce(place, F.col("__block"))).drop("by_key", "step", "from", "base", "top"))


def with_next(docs: DataFrame, key: str, add: dict[str, Column]) -> DataFrame:
    """Every row with the columns ``add`` computed from it, and ``next_<name>`` from the row after it.

    ``docs`` has two columns, ``key`` and ``text``; the order is ascending key (null
    first), equal keys by the text's hash; after the last row comes the first.  Rows are cut
    into blocks of consecutive rows; the first row of each block is copied to the
    end of the block before, so that no task orders more than a block.
    """
    placed = _cut(docs, key)
    # a null key comes before all others
    place = F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"), F.col("__hash").alias("hash"))
    order = Window.orderBy("__first")
    edges = placed.groupBy("__block").agg(F.min(place).alias("__first"))
    edges = edges.withColumn("__before", F.coalesce(F.lag("__block").over(order), F.max_by("__block", "__first").over(Window.partitionBy())))
    # a few times MAX_BLOCKS rows at most
    joined = placed.join(F.broadcast(edges), "__block")
    spread = F.when(place == F.col("__first"),
                    F.array(F.struct(F.col("__block").alias("b"), F.lit(False).alias("copy")),
                            F.struct(F.col("__before").alias("b"), F.lit(True).alias("copy")))
                    ).otherwise(F.array(F.struct(F.col("__block").alias("b"), F.lit(False).alias("copy"))))
    dealt = (joined.withColumn("__to", F.explode(spread)).select(key, "text", "__hash", F.col("__to.b").alias("__block"), F.col("__to.copy").alias("__copy"))
             .repartition("__block").withColumns(add))
    inside = Window.partitionBy("__block").orderBy("__copy", F.col(key).asc_nulls_first(), "__hash", "text")
    names = ["text", *add]
    return (dealt.withColumns({f"next_{c}": F.lead(c).over(inside) for c in names})
            .filter(~F.col("__copy")).drop("__block", "__copy", "__hash"))


def fingerprint_query(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and edited texts and their likeness by the contract of op4."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_next(rows, "doc_id", {"__fp": fingerprint(F.col("text"))})
    n = F.length("text")
    moved = F.expr("length(text) div 4").cast("int")
    edited = (pairs.withColumn("__n", n).withColumn("__q", moved)
              .withColumn("__edited", F.concat(F.substring("text", F.lit(1), F.col("__n") - F.col("__q")),
                                               F.substring("next_text", F.lit(1), F.col("__q"))))
              .withColumn("__efp", fingerprint(F.col("__edited"))))
    return edited.select("doc_id", F.col("__n").cast("long").alias("n_chars"), F.sha2("__edited", 256).alias("edited_sha256"),
                         as_text(F.col("__fp")).alias("fingerprint"), as_text(F.col("__efp")).alias("edited_fingerprint"),
                         likeness(F.col("__fp"), F.col("__efp")).alias("near_edited"),
                         likeness(F.col("__fp"), F.col("next___fp")).alias("near_next"))
