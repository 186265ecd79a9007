"""SimHash near-duplicates (operator 13): an exact Hamming join by vantage-point trees.

A fingerprint bit is set when more than half of the hashes of a text's word
shingles have it set.  Documents whose fingerprints differ in at most ``RADIUS``
bits are linked; the result is the class of every document.

The distinct fingerprints are dealt to shards by a vantage-point tree: every inner
node holds a vantage point and a distance, nearer points go one way, the others the
other way.  By the triangle inequality a link can cross a node only if its near end
lies within the radius of the node's boundary; such points also visit the far side,
as queries.  (The shard order makes one visit of each pair enough.)  Each shard is
then searched by a tree of the same kind, fitted on its own points, down to small
leaves that are compared outright.  The search is exact: the trees decide where
points meet, never whether.

The shard tree is fitted on at most ``SAMPLE`` distinct fingerprints, those with the
smallest hashes, or fewer if the shards wanted need fewer; all fingerprints are dealt.
A point has at most 1 + 64 + 2016 neighbours, so links are bounded by the number of
points; a shard hands on only a spanning forest of its links.

Defined cases: a null text, or one without words, has fingerprint 0 and is linked
like any other; texts of fewer words than a shingle are one shingle; a null doc_id is
never the smallest of a class unless there is no other (then component_id is null);
nulls in other columns play no part; repeated rows each get a row; texts are read in
pieces, so a very long one needs no more memory than its bytes; an empty table gives an
empty result; extra columns, clashing names included, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import materialise
from dockcast.llm.components import components
from dockcast.llm.textarrays import longs

WORDS = 3
SEED = 42
RADIUS = 2
# Distinct fingerprints a shard should hold, and the most that the shard tree is fitted on.
SHARD = 16_384
SAMPLE = 1 << 20
# Sampled fingerprints per shard at least; with SAMPLE this bounds the number of shards.
PER_SHARD = 8
# Points compared outright, and vantage points tried per node.
LEAF = 192
TRIED = 6
# Links held before they are reduced to a spanning forest.
HELD = 1 << 22
# Bytes of a text split at a time.
PIECE = 1 << 20
# Fingerprints with more than this share of the rows are joined by broadcast.
HOT = 1000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _word_runs(text: bytes, words: int) -> Iterator[list[bytes]]:
    """The words of a text in pieces that overlap by ``words`` - 1 words."""
    at, kept = 0, []
    while at < len(text):
        cut = _SPACE.search(text, min(len(text), at + PIECE))
        end = cut.start() if cut else len(text)
        run = kept + text[at:end].split()
        yield run
        kept, at = run[max(0, len(run) - words + 1):], end
    if not text:
        yield kept


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a lower-cased text, piece by piece, repeats included."""
    h, seen = xxhash.xxh64_intdigest, False
    run: list[bytes] = []
    for run in _word_runs(text, words):
        if len(run) < words:
            continue
        seen = True
        line = b" ".join(run)
        ends = np.cumsum([len(w) + 1 for w in run])
        starts = np.concatenate([[0], ends[:-1]]).tolist()
        stops = (ends - 1).tolist()
        yield np.array([h(line[a:b], seed) for a, b in zip(starts, stops[words - 1:])], np.uint64)
    if not seen and run:
        yield np.array([h(b" ".join(run), seed)], np.uint64)


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words, seed):
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(_POWERS[counts * 2 > n].sum()) if n else 0


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a long of the same bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.fromiter((fingerprint((t.as_py() or "").encode().lower(), words, seed) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), longs(values)], names=["doc_id", "fp"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def boundary(points: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int]:
    """A vantage point among ``points`` (at least two, distinct) and the distance up to which points are near.

    Of a few points tried, the cut with the fewest points near it that leaves a
    quarter of them on either side; if none does, the most even cut.
    """
    best = None
    some = points if len(points) <= 4096 else points[rng.integers(0, len(points), 4096)]
    for v in points[rng.integers(0, len(points), TRIED)]:
        d = distance(points if len(points) <= 4096 else some, v)
        hist = np.bincount(d, minlength=66)
        upto = np.cumsum(hist)
        for mu in range(64):
            side = min(upto[mu], len(d) - upto[mu])
            if not side:
                continue
            near = upto[min(65, mu + radius)] - (upto[mu - radius] if mu >= radius else 0)
            rank = (side * 4 < len(d), -side if side * 4 < len(d) else near, -side)
            if best is None or rank < best[0]:
                best = rank, v, mu
    return (best[1], best[2]) if best else (points[0], 0)


class ShardTree:
    """Vantage-point tree whose leaves are shards, numbered from near to far."""

    def __init__(self, sample: np.ndarray, shards: int, radius: int = RADIUS):
        self.radius, self.points, self.cuts, self.children = radius, [], [], []
        self.shards = 0
        self.root = self._grow(sample, max(1, -(-len(sample) // max(1, shards))), np.random.default_rng(SEED))
        self.points = np.array(self.points, np.uint64)

    def _grow(self, sample: np.ndarray, size: int, rng) -> int:
        """Node number, or -1 - shard for a leaf; an explicit stack, near side first."""
        root: list[int] = [0]
        todo = [(sample, root, 0)]
        while todo:
            points, parent, side = todo.pop()
            if len(points) <= size or len(points) < 2:
                parent[side] = -1 - self.shards
                self.shards += 1
                continue
            v, mu = boundary(points, self.radius, rng)
            near = distance(points, v) <= mu
            parent[side] = len(self.points)
            self.points.append(v)
            self.cuts.append(mu)
            self.children.append([0, 0])
            todo.append((points[~near], self.children[-1], 1))
            todo.append((points[near], self.children[-1], 0))
        return root[0]

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, indexes, at home) for every shard that points belong to or have to visit."""
        todo = [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node < 0:
                yield -1 - node, at, home
                continue
            d, mu = distance(points[at], self.points[node]), self.cuts[node]
            near = np.where(home, d <= mu, d <= mu + self.radius)
            far = d > mu - self.radius
            todo.append((self.children[node][0], at[near], home[near]))
            todo.append((self.children[node][1], at[far], home[far] & (d[far] > mu)))


def links(home: np.ndarray, visit: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of indexes within the radius among ``home`` points, and between them and ``visit`` points (numbered after them)."""
    points = np.concatenate([home, visit])
    rng = np.random.default_rng(SEED)
    todo = [(np.arange(len(home)), np.arange(len(home), len(points)))]
    while todo:
        own, guests = todo.pop()
        if not len(own):
            continue
        if len(own) <= LEAF:
            yield from _compare(points, own, own, radius)
            for i in range(0, len(guests), 1 << 14):
                yield from _compare(points, guests[i:i + (1 << 14)], own, radius)
            continue
        v, mu = boundary(points[own], radius, rng)
        d, dg = distance(points[own], v), distance(points[guests], v)
        near = d <= mu
        if near.all() or not near.any():
            # only points that are all equally far from every vantage point tried
            near = np.arange(len(own)) < len(own) // 2
            todo.append((own[near], guests))
            todo.append((own[~near], np.concatenate([guests, own[near]])))
            continue
        todo.append((own[near], guests[dg <= mu + radius]))
        todo.append((own[~near], np.concatenate([guests[dg > mu - radius], own[near & (d > mu - radius)]])))


def _compare(points: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    i, j = np.nonzero(np.bitwise_count(points[a][:, None] ^ points[b][None, :]) <= radius)
    keep = a[i] != b[j]
    if keep.any():
        yield a[i[keep]], b[j[keep]]


def forest(n: int, pairs) -> np.ndarray:
    """Label of each of ``n`` points: the smallest index its pairs connect it with; ``pairs`` is consumed piecewise."""
    label = np.arange(n)
    held, a, b = 0, [], []

    def settle():
        nonlocal label, held, a, b
        if held:
            x, y = np.concatenate(a), np.concatenate(b)
            while True:
                lx, ly = label[x], label[y]
                if (lx == ly).all():
                    break
                np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
                while (label[label] != label).any():
                    label = label[label]
        held, a, b = 0, [], []

    for x, y in pairs:
        a.append(x)
        b.append(y)
        held += len(x)
        if held >= HELD:
            settle()
    settle()
    return label


def _search(radius: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["home", "fp"], ascending=[False, True])
        fp, n = g.fp.to_numpy(), int(g.home.sum())
        bits = fp.view(np.uint64)
        label = forest(len(fp), links(bits[:n], bits[n:], radius))
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return pd.DataFrame({"a": fp[moved], "b": fp[label[moved]]})
    return run


def fit_shards(points: DataFrame, n: int, radius: int = RADIUS) -> ShardTree:
    """The shard tree for ``n`` stored distinct fingerprints (column fp), from a bounded sample of them."""
    shards = min(-(-n // SHARD), SAMPLE // PER_SHARD)
    wanted = min(n, SAMPLE, shards * 1024)
    # hashes are spread evenly, so a cut by value takes about the rows wanted; the limit only makes the bound hard
    cut = -(1 << 63) + ((1 << 64) * wanted) // max(n, 1)
    chosen = points if wanted == n else points.filter(F.xxhash64(F.lit(SEED), "fp") < F.lit(min(cut, (1 << 63) - 1)))
    sample = chosen.select("fp").limit(2 * SAMPLE).toPandas().fp.to_numpy(np.int64)
    return ShardTree(np.sort(sample.view(np.uint64)), shards, radius)


def hamming_links(points: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that connect the same points (stored column fp, ``n`` distinct values) as all pairs within the radius."""
    tree = fit_shards(points, n, radius)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for shard, at, home in tree.route(fp.view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), shard), pa.int64()), pa.array(fp[at]), pa.array(home)],
                                                 names=["shard", "fp", "home"])

    dealt = points.select("fp").mapInArrow(deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(_search(radius), "a long, b long")


def classes(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``rows`` (doc_id, fp; stored) with component_id, the smallest doc_id its fingerprint reaches."""
    points = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")))
    n, total = points.agg(F.count(F.lit(1)), F.sum("rows")).first()
    if not n:
        return rows.withColumn("component_id", F.lit(None).cast("long"))
    found = components(hamming_links(points, n, radius)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = materialise(points.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialise(rooted.join(least, "root").select("fp", "rows", "component_id"))
    # at most HOT fingerprints hold more than one row in HOT; their rows never meet in one task
    hot = F.broadcast(named.filter(F.col("rows") * HOT > total).drop("rows"))
    cold = named.filter(F.col("rows") * HOT <= total).drop("rows")
    return (rows.join(hot, "fp").unionByName(rows.join(hot, "fp", "left_anti").join(cold, "fp")).select(*rows.columns, "component_id"))


def simhash_query(docs: DataFrame) -> DataFrame:
    """Fingerprints and classes of the documents by the contract of op13."""
    return (classes(materialise(fingerprints(docs)))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
