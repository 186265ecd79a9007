"""Substring dedup (operator 9): seed and extend over winnowed anchors.

Words are runs of non-white-space, unchanged.  Seeds: in every ``LENGTH - K + 1``
consecutive hashes of ``K`` words the smallest (rightmost of equal ones) is an anchor, so
any two copies of ``LENGTH`` words hold the same anchor at the same place.  Documents meet
on anchors: only anchors that occur twice or more are seeds.  Extension: around a seed,
the words are extended left and right in all ways that make ``LENGTH`` words; an
extension stands if the same words stand around another occurrence of the seed.  In a
group of thousands of occurrences this is decided by equal keys, not by making the
group's pairs.  Extensions that stand and overlap or touch in a document are joined to
maximal repeats, given as spans of words (``repeats``), and ``clean`` removes them.

A task settles anchors and extensions that it has seen twice by itself and passes on one
of them, so a passage that a third of all documents hold is one row per task in the
shuffle.  Texts that are equal as a whole are one text with a count.

Keys are 64-bit hashes of the words.  Defined cases: null and empty texts have no words;
texts shorter than ``LENGTH`` lose nothing; every copy of a repeat is removed, the
first one too; repeated rows are repeats of each other; rows of equal text and id have
equal results; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import checked_join, materialise
from dockcast.llm.textarrays import longs, run_hashes, text_runs, word_hashes

LENGTH = 35
K = 16
RUN_BYTES = 2 << 20
# Seen keys of one task are combined in batches of about this many.
COMBINE = 1 << 20


def anchors(grams: np.ndarray, w: int = LENGTH - K + 1) -> np.ndarray:
    """Positions of the rightmost minimum of every ``w`` consecutive hashes."""
    n = len(grams) - w + 1
    if n < 1:
        return np.empty(0, np.int64)
    least, at, span = grams, np.arange(len(grams)), 1
    while span < w:                                # windows of 1, 2, 4, ... and last of w hashes
        step = min(span, w - span)
        m = len(least) - step
        right = least[step:] <= least[:m]
        least, at = np.where(right, least[step:], least[:m]), np.where(right, at[step:], at[:m])
        span += step
    return np.unique(at)


def _text_words(batches):
    """(keys, texts, word hashes, bounds) of runs of texts."""
    for keys, texts in text_runs(batches, False, RUN_BYTES):
        hashes, bounds = word_hashes(texts)
        yield keys, texts, hashes, bounds


def _combined(parts, schema_names):
    """Rows (hash, doc, pos, twice, lead): whether a hash was seen more than once here, and the first row of each hash."""
    h, d, p = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(h, kind="stable")
    h, d, p = h[order], d[order], p[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    group = np.cumsum(new) - 1
    twice = np.bincount(group)[group] > 1
    return pa.RecordBatch.from_arrays([longs(h), pa.array(d, pa.int64()), pa.array(p, pa.int32()), pa.array(twice), pa.array(new)], names=schema_names)


_KEYS = "key long, doc long, pos int, twice boolean, lead boolean"
_NAMES = ["key", "doc", "pos", "twice", "lead"]


def _emit(source):
    """Batches of (hash, doc, pos) arrays, combined within the task."""
    parts, held = [], 0
    for part in source:
        if len(part[0]):
            parts.append(part)
            held += len(part[0])
        if held >= COMBINE:
            yield _combined(parts, _NAMES)
            parts, held = [], 0
    if parts:
        yield _combined(parts, _NAMES)


def _repeated(keys: DataFrame) -> DataFrame:
    """(doc, pos) of the rows whose key occurs twice or more: one shuffle.

    One lead row per key and batch of a task meets the leads of the others, so a
    key has no more rows than there are batches; the rows that a task has
    settled itself are dealt by place, not by key.
    """
    meet = F.when(F.col("lead"), F.col("key")).otherwise(F.xxhash64("doc", "pos"))
    together = Window.partitionBy("meet", "lead")
    return (keys.withColumn("meet", meet).withColumn("n", F.count(F.lit(1)).over(together))
            .filter(F.col("twice") | (F.col("lead") & (F.col("n") > 1))).select("doc", "pos"))


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, text, positions) of the texts that have rows in ``wanted`` (doc, positions)."""
    return checked_join(texts, wanted, "doc", "inner", 64, F.size("positions") * 4).select("doc", "text", "positions")


def _position_lists(rows: DataFrame) -> DataFrame:
    return materialise(rows.groupBy("doc").agg(F.sort_array(F.collect_list("pos")).alias("positions")))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(doc, text, copies): every different text once; ``doc`` is a 64-bit hash of the text."""
    text = F.coalesce("text", F.lit(""))
    counted = materialise(docs.select(F.xxhash64(text).alias("doc")).groupBy("doc").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    return counted


def repeats(docs: DataFrame, length: int = LENGTH, k: int = K) -> tuple[DataFrame, DataFrame]:
    """Maximal repeats of ``docs`` (text) and the counts of equal texts.

    The first frame has (doc, spans): ``doc`` is the hash of a text, spans an array of
    (start, stop) in words.  Texts that occur more than once as a whole are in the
    second frame (doc, copies) and repeat from end to end; they are in the first
    only for what others share with them.
    """
    window = length - k + 1
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("doc", F.xxhash64("text")).select("doc", "text")
    copied = distinct_texts(docs)
    # one row of every copied text is enough to meet the others
    single = checked_join(texts, copied, "doc", "left_anti", 32)
    some = checked_join(texts, copied, "doc", "left_semi", 32).groupBy("doc").agg(F.first("text").alias("text"))
    pool = single.unionByName(some)

    def seeds(batches):
        def source():
            for keys, texts_, hashes, bounds in _text_words(batches):
                grams = run_hashes(hashes, k)
                for key, a, b in zip(keys, bounds[:-1], bounds[1:]):
                    if b - a >= length:
                        at = anchors(grams[a:b - k + 1], window)
                        yield grams[a + at], np.full(len(at), key, np.int64), at
        yield from _emit(source())
    seeded = _position_lists(_repeated(pool.mapInArrow(seeds, _KEYS)))

    def extensions(batches):
        def source():
            for batch in batches:
                positions = {k_: p.values.to_numpy() for k_, p in zip(batch.column(0).to_pylist(), batch.column(2))}
                for keys, texts_, hashes, bounds in _text_words([batch.select(["doc", "text"])]):
                    whole = run_hashes(hashes, length)
                    for key, a, b in zip(keys, bounds[:-1], bounds[1:]):
                        at = positions[key]
                        # every window of ``length`` words around a seed, each once
                        starts = np.unique((at[:, None] - np.arange(window)[None, :]).ravel())
                        starts = starts[(starts >= 0) & (starts <= b - a - length)]
                        yield whole[a + starts], np.full(len(starts), key, np.int64), starts
        yield from _emit(source())
    stand = _position_lists(_repeated(_texts_of(pool, seeded).mapInArrow(extensions, _KEYS)))
    return stand.select("doc", _spans(F.col("positions"), length).alias("spans")), copied


def _spans(starts, length: int):
    """Sorted window starts as maximal spans (start, stop)."""
    firsts = F.filter(starts, lambda s, i: (i == 0) | (s > F.get(starts, i - 1) + length))
    lasts = F.filter(starts, lambda s, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > s + length))
    return F.transform(F.arrays_zip(firsts.alias("a"), lasts.alias("b")),
                       lambda x: F.struct(x["a"].alias("start"), (x["b"] + length).alias("stop")))


_CLEAN = "doc_id long, n_words long, n_removed long, kept string"


def clean(docs: DataFrame, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the kept words joined by single spaces (``digest``: their SHA-256)."""
    spans, copied = repeats(docs, length)
    spans, copied = materialise(spans), copied.select("doc", F.lit(True).alias("copied"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("doc", F.xxhash64("text"))
    rows = checked_join(checked_join(rows, copied, "doc", "left", 32), spans, "doc", "left", 64, F.size("spans") * 40)
    rows = rows.select("doc_id", "text", "copied", F.col("spans.start").alias("starts"), F.col("spans.stop").alias("stops"))

    def cut(batches):
        for batch in batches:
            out = []
            for i, text, copied_, starts, stops in zip(*(batch.column(c).to_pylist() for c in range(5))):
                w = text.encode().split()
                n = len(w)
                if copied_ and n >= length:
                    w = []
                for a, b in zip(reversed(starts or []), reversed(stops or [])):
                    del w[a:b]
                kept = b" ".join(w)
                out.append((i, n, n - len(w), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                                 names=["doc_id", "n_words", "n_removed", "kept"])
    return rows.mapInArrow(cut, _CLEAN)


def substring_query(docs: DataFrame) -> DataFrame:
    """Words removed and kept by the contract of op9."""
    return clean(docs, digest=True).withColumnRenamed("kept", "kept_sha256")
