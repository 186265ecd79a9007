"""MinHash near-dedup (operator 5): SetSketch registers, banding, joint estimate, exact check.

A document's set is its distinct 5-word shingles.  Documents with equal sets are one
class, whose smallest doc_id is its node.  Every node has ``BANDS * ROWS`` SetSketch
registers: register i is ``floor(1 - log_BASE(x_i))`` for the smallest x_i of exponential
values that the shingles hash to, truncated to 0..LIMIT.  Registers of a union are the
maxima of registers (``merge``), and two sets share a register with a probability close to
their Jaccard similarity, so nodes that agree in all registers of a band become candidates.

Candidates are found per bucket in two rounds without emitting a bucket's pairs.  First every
member is paired with the bucket's centre only; those pairs are estimated from registers by
maximum likelihood (sizes known), those that may reach the threshold are checked on full
sets, and links form components.  Then buckets that still span several components are
joined with themselves across components only, and the new pairs go the same way.  Pairs
inside a component cannot change it, so they are never made; no partner is dropped.

A pair at exactly the threshold 0.75 meets in some band with probability
``1 - (1 - 0.75**ROWS)**BANDS`` = 0.9999 and passes the estimate unless it is off by five
standard errors.

Defined cases: null and empty texts have size 0 and are linked with nothing; texts of
fewer than five words have one shingle, the whole sequence; rows with the same doc_id are
one node; a null doc_id is linked with nothing and is its own group (component null, kept);
empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import checked_join, materialise
from dockcast.llm.components import components
from dockcast.llm.textarrays import lists, longs, mix, run_hashes, text_runs, word_hashes

SHINGLE = 5
BANDS = 48
ROWS = 6
M = BANDS * ROWS
THRESHOLD = (75, 100)        # links: 100 * intersection >= 75 * union
BASE = 1.001                 # spacing of the registers' levels
RATE = 20.0                  # rate of the exponential values
LIMIT = 65534
# Candidates whose estimate is below this are not checked: five standard errors under the threshold.
ESTIMATE = 0.75 - 5 * (0.75 * 0.25 / M) ** 0.5
BLOCK = 512                  # nodes of a bucket compared with as many others in one task
RUN_BYTES = 1 << 20          # text hashed at a time
CACHED = 1 << 15             # shingles whose registers are computed at a time

_XOR = mix(np.arange(1, M + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_MUL = mix(np.arange(1, M + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each lower-cased text."""
    words, bounds = word_hashes(texts)
    runs = run_hashes(words, SHINGLE)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        n = b - a
        if n >= SHINGLE:
            out.append(np.unique(runs[a:b - SHINGLE + 1]))
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    whole = whole * np.uint64(0x9E3779B97F4A7C15) + w
            out.append(mix(np.array([whole])))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest of M hash values of each non-empty set, as fractions of 2**64."""
    out = np.empty((M, len(sets)), np.uint64)
    i = 0
    while i < len(sets):
        j, held = i, 0
        while j < len(sets) and (j == i or held + len(sets[j]) <= CACHED):
            held += len(sets[j])
            j += 1
        values = np.concatenate(sets[i:j])
        starts = np.cumsum([0] + [len(s) for s in sets[i:j - 1]])
        for r in range(M):
            out[r, i:j] = np.minimum.reduceat((values ^ _XOR[r]) * _MUL[r], starts)
        i = j
    return out.T


def registers(least: np.ndarray) -> np.ndarray:
    """SetSketch registers of hash minima."""
    u = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    x = -np.log1p(-u) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(reg: np.ndarray) -> np.ndarray:
    """One 64-bit key per band from its registers and its number."""
    r = reg.reshape(len(reg), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(reg), BANDS)).copy()
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + r[:, :, i])
    return key


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, grid: int = 128) -> np.ndarray:
    """Jaccard similarity of each pair of register rows by maximum likelihood.

    With sizes known, a register of a is larger, smaller or equal with
    probabilities ``p(u - vJ)``, ``p(v - uJ)`` and the rest, for
    ``p(x) = -log_BASE(1 - x (BASE - 1) / BASE)`` and u, v the shares of the sizes.
    """
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, grid + 1)[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    tiny = 1e-12
    up, down = p(u - v * j), p(v - u * j)
    score = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, 0) + tiny)
    return np.take_along_axis(j, score.argmax(1)[:, None], 1)[:, 0]


_SKETCH = "doc_id long, n_shingles long, sig1 long, sig2 long, registers binary, bands array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """Per document: size and 128-bit digest of its set, registers and band keys (null and none for empty sets)."""
    def sketch(batches):
        for ids, texts in text_runs(batches, True, RUN_BYTES):
            sets = shingle_sets(texts)
            size = np.array([len(s) for s in sets])
            full = np.flatnonzero(size)
            reg = registers(minima([sets[i] for i in full])) if len(full) else np.empty((0, M), np.uint16)
            blobs = [None] * len(sets)
            for i, r in zip(full.tolist(), reg):
                blobs[i] = r.tobytes()
            sig1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            sig2 = np.array([mix(s ^ _XOR[0]).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(size, pa.int64()), longs(sig1), longs(sig2), pa.array(blobs, pa.binary()),
                 lists(longs(band_keys(reg).ravel()), np.where(size > 0, BANDS, 0))],
                names=["doc_id", "n_shingles", "sig1", "sig2", "registers", "bands"])
    return docs.select("doc_id", "text").mapInArrow(sketch, _SKETCH)


def _near_size(a: Column, b: Column) -> Column:
    """Sets whose sizes differ more than this cannot reach the threshold."""
    return F.least(a, b) * THRESHOLD[1] >= F.greatest(a, b) * THRESHOLD[0]


def _confirmed(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that reach the threshold on full sets, of candidate pairs (a, b)."""
    side = nodes.select(F.col("doc_id"), F.col("registers"), F.col("n_shingles"))
    both = (pairs.join(side.toDF("a", "ra", "na"), "a").join(side.toDF("b", "rb", "nb"), "b"))

    def likely(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            ra, rb = (np.frombuffer(b"".join(c[n].to_pylist()), np.uint16).reshape(-1, M) for n in ("ra", "rb"))
            na, nb = (c[n].to_numpy().astype(np.float64) for n in ("na", "nb"))
            keep = pa.array(estimate(ra, rb, na, nb) >= ESTIMATE)
            yield pa.RecordBatch.from_arrays([c["a"].filter(keep), c["b"].filter(keep)], names=["a", "b"])
    kept = materialise(both.select("a", "b", "ra", "rb", "na", "nb").mapInArrow(likely, "a long, b long"))

    def full_sets(batches):
        for ids, texts in text_runs(batches, True, RUN_BYTES):
            sets = shingle_sets(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), lists(longs(np.concatenate(sets)), [len(s) for s in sets])], names=["doc_id", "shingles"])
    asked = materialise(kept.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    sets = (checked_join(docs.select("doc_id", "text"), asked, "doc_id", "left_semi")
            .mapInArrow(full_sets, "doc_id long, shingles array<long>"))
    sets = materialise(sets)
    shared = F.size(F.array_intersect("sa", "sb"))
    return (kept.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
            .filter(shared * THRESHOLD[1] >= (F.size("sa") + F.size("sb") - shared) * THRESHOLD[0]).select("a", "b"))


def _across(docs: DataFrame, rest: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share a bucket of ``rest``, not a component, and reach the threshold.

    ``rest`` has (band, at, node, component, n), n the bucket's members.  A bucket is
    cut into blocks of about ``BLOCK`` nodes and compared block against block, so
    a task holds two blocks at most.  Registers rule out most pairs (they agree at
    least as often as the sets are similar), full sets of shingles settle the others;
    nothing is emitted but pairs that reach the threshold, and only as long as
    they join components that the task has not seen joined.
    """
    asked = materialise(rest.select(F.col("node").alias("doc_id")).distinct())

    def small_sets(batches):
        for ids, texts in text_runs(batches, True, RUN_BYTES):
            blobs = [np.unique(s).tobytes() for s in shingle_sets(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], names=["node", "shingles"])
    sets = materialise(checked_join(docs.select("doc_id", "text"), asked, "doc_id", "left_semi")
                       .mapInArrow(small_sets, "node long, shingles binary"))
    carried = (checked_join(nodes, asked, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "n_shingles", "registers")
               .join(sets, "node"))
    blocks = F.ceil(F.col("n") / BLOCK)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = (rest.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", other)
             .select("band", "at", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "component")
             .join(carried, "node").repartition("band", "x", "y").sortWithinPartitions("band", "x", "y", "node"))

    def compare(batches):
        key, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                here = (row["band"], row["x"], row["y"])
                if here != key and held:
                    yield from _links(held)
                    held = []
                key = here
                held.append(row)
        if held:
            yield from _links(held)
    return dealt.mapInArrow(compare, "a long, b long")


def _links(rows: list[dict]):
    """Links across components among the rows of one pair of blocks."""
    reg = np.frombuffer(b"".join(r["registers"] for r in rows), np.uint16).reshape(-1, M)
    size = np.array([r["n_shingles"] for r in rows])
    node = np.array([r["node"] for r in rows])
    own = np.array([r["own"] for r in rows])
    x, y, at = rows[0]["x"], rows[0]["y"], rows[0]["at"]
    component = np.array([r["component"] for r in rows])
    sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
    found = []
    for i in np.flatnonzero(own == x):
        partners = np.flatnonzero((own == y) & (component != component[i]) & (np.minimum(size, size[i]) * THRESHOLD[1] >= np.maximum(size, size[i]) * THRESHOLD[0])
                                  & ((node > node[i]) if x == y else True))
        equal = reg[partners] == reg[i]
        keep = equal.mean(1) >= ESTIMATE
        # a pair is settled in the first band it shares
        first = equal[keep].reshape(-1, BANDS, ROWS).all(2).argmax(1) == at
        for j in partners[keep][first]:
            if component[i] == component[j]:
                continue
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if shared * THRESHOLD[1] >= (size[i] + size[j] - shared) * THRESHOLD[0]:
                found.append((min(node[i], node[j]), max(node[i], node[j])))
                component[component == component[j]] = component[i]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sketched = materialise(sketches(docs))
    full = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = materialise(full.groupBy("sig1", "sig2", "n_shingles").agg(F.min("doc_id").alias("node")))
    reps = materialise(classes.select(F.col("node").alias("doc_id")).distinct())
    nodes = materialise(checked_join(full, reps, "doc_id", "left_semi").select("doc_id", "n_shingles", "registers", "bands"))
    banded = nodes.select(F.col("doc_id").alias("node"), "n_shingles", F.posexplode("bands").alias("at", "band"))
    # each bucket has a centre of its own, so that a large group has many
    centre = F.min(F.struct(F.xxhash64("node", "band").alias("h"), "node", "n_shingles"))
    buckets = materialise(banded.groupBy("band").agg(centre.alias("centre"), F.count(F.lit(1)).alias("n"))
                          .filter("n > 1").select("band", F.col("centre.node").alias("centre"), F.col("centre.n_shingles").alias("centre_size")))
    members = materialise(checked_join(banded, buckets, "band", "inner"))
    stars = materialise(members.filter((F.col("node") != F.col("centre")) & _near_size(F.col("n_shingles"), F.col("centre_size")))
                        .select(F.least("centre", "node").alias("a"), F.greatest("centre", "node").alias("b")).distinct())
    first = materialise(_confirmed(docs, stars, nodes))
    # the documents of a class and its node; a doc_id with several texts joins their classes
    copies = (full.select("doc_id", "sig1", "sig2", "n_shingles").join(classes, ["sig1", "sig2", "n_shingles"])
              .select(F.col("node").alias("a"), F.col("doc_id").alias("b")).filter("a <> b"))
    labels = materialise(components(first))
    # buckets that still span several components: links across them only
    split = materialise(members.select("band", "at", "node").join(labels, "node", "left")
                        .withColumn("component", F.coalesce("component", "node")))
    open_ = split.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n")).filter("x <> y")
    rest = materialise(split.join(open_.select("band", "n"), "band"))
    second = _confirmed(docs, materialise(_across(docs, rest, nodes).distinct().join(stars, ["a", "b"], "left_anti")), nodes)
    edges = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(second).unionByName(copies)
    groups = materialise(components(edges))
    lone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return (sketched.select("doc_id", "n_shingles").join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.when(lone, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each group, all columns.

    Of several rows with the doc_id that stays, the smallest (column by column) stays;
    rows without a doc_id all stay.
    """
    near = materialise(near_duplicates(docs))
    known = near.filter("doc_id IS NOT NULL")
    ids = materialise(known.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct())
    several = materialise(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"))
    kept = checked_join(docs.filter("doc_id IS NOT NULL"), ids, "doc_id", "left_semi")
    once = checked_join(kept, several, "doc_id", "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    chosen = checked_join(kept, several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(whole).alias("__row")).select("__row.*")
    return once.select(*docs.columns).unionByName(chosen).unionByName(docs.filter("doc_id IS NULL"))


def neardup_query(docs: DataFrame) -> DataFrame:
    """Components of every document by the contract of op5."""
    return near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
