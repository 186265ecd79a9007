"""Benchmark decontamination (operator 1): a distributed positional inverted index.

The training documents are indexed in segments: one row holds the postings (term,
document, positions) of a batch of documents, stored as a table, so a lost executor
costs one segment.  A test phrase is looked up from its rarest term (by counts
over the whole corpus): the rarest term's positions, moved back by the term's
offset in the phrase, are the candidate starts; the list of each next-rarest term
is intersected with them, moved by its own offset.  What survives all terms is an
exact phrase match.  ``near_matches`` finds documents where all terms of a query
stand within a span of words instead.

Postings of terms that no test item holds can never take part in a match, so
``build_index`` is given the test vocabulary (``vocabulary=None`` keeps all terms).
Test items are sent to the tasks in blocks of at most ``BLOCK_PHRASES`` phrases; a
larger benchmark makes more passes over the stored index, not larger tasks.

Defined cases: null texts have no words; items without words have no phrases and
match nothing; an item shorter than the phrase length is one phrase; documents
with equal ids are kept apart; items without an id cannot be named and are not looked for;
empty tables give empty results or no matches; other
columns of the inputs are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.llm.common import checked_join, materialise

PHRASE = 13                  # words of a phrase
BLOCK_PHRASES = 400_000      # test phrases sent to a task at once
MAX_VOCABULARY = 2_000_000   # above this many distinct test terms the index keeps all terms instead
SEGMENT_BYTES = 4 << 20      # text of one index segment; a longer document is a segment of its own
CANDIDATES = 1 << 20         # candidate starts checked at a time inside a task

# Words after lower-casing A-Z: bytes 0-9, a-z and every byte of a non-ASCII character.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_INDEX = ("segment long, doc_ids array<long>, n_words array<long>, terms array<binary>, "
          "counts array<long>, positions binary, docs binary")


def words(text: str | None) -> list[bytes]:
    return _WORDS.findall(text.encode().lower()) if text else []


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Runs of (doc_ids, lower-cased texts) of at most ``SEGMENT_BYTES``."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
        b = (t.as_py() or "").encode().lower()
        if ids and size + len(b) > SEGMENT_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(b)
        size += len(b)
    if ids:
        yield ids, texts


def build_index(docs: DataFrame, vocabulary: list[bytes] | None) -> DataFrame:
    """Index segments of (doc_id, text), stored.

    ``positions`` are word positions that run on through the segment, with one gap
    between documents, sorted within each term and stored as differences;
    ``docs`` are the segment positions at which its documents start.
    """
    known = None if vocabulary is None else {w: i for i, w in enumerate(vocabulary)}

    def segments(batches):
        for batch in batches:
            for ids, texts in _texts(batch):
                seen = {} if known is None else known
                starts, lengths, codes, at = [], [], [], 0
                for b in texts:
                    found = _WORDS.findall(b)
                    if known is None:
                        code = np.fromiter((seen.setdefault(w, len(seen)) for w in found), np.int64, len(found))
                    else:
                        code = np.fromiter((seen.get(w, -1) for w in found), np.int64, len(found))
                    starts.append(at)
                    lengths.append(len(found))
                    codes.append(code)
                    at += len(found) + 1
                    codes.append(np.full(1, -1))
                code = np.concatenate(codes)
                held = np.flatnonzero(code >= 0)
                held = held[np.argsort(code[held], kind="stable")]
                term, first, count = np.unique(code[held], return_index=True, return_counts=True)
                step = np.diff(held, prepend=0)
                step[first] = held[first]
                names = vocabulary if known is not None else list(seen)
                yield pa.RecordBatch.from_arrays([
                    pa.array([0], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([[names[t] for t in term.tolist()]], pa.list_(pa.binary())), pa.array([count], pa.list_(pa.int64())),
                    pa.array([step.astype(np.int32).tobytes()], pa.binary()), pa.array([np.array(starts, np.int64).tobytes()], pa.binary()),
                ], names=["segment", "doc_ids", "n_words", "terms", "counts", "positions", "docs"])
    index = docs.select("doc_id", "text").mapInArrow(segments, _INDEX)
    return materialise(index.withColumn("segment", F.monotonically_increasing_id()))


def term_counts(index: DataFrame) -> DataFrame:
    """(term, n): occurrences of each indexed term in the whole corpus."""
    return (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
            .groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n")))


class Segment:
    """One index row, opened: sorted postings of each term as one array of (term, position) keys."""

    def __init__(self, row: dict):
        self.doc_ids, self.n_words = row["doc_ids"], row["n_words"]
        self.starts = np.frombuffer(row["docs"], np.int64)
        self.counts = np.array(row["counts"], np.int64)
        self.terms = {t: i for i, t in enumerate(row["terms"])}
        ends = np.cumsum(self.counts)
        self.first = ends - self.counts
        step = np.frombuffer(row["positions"], np.int32).astype(np.int64)
        run = np.cumsum(step)
        base = np.where(self.first > 0, run[self.first - 1], 0) if len(step) else self.first
        self.positions = run - np.repeat(base, self.counts)
        self.keys = (np.repeat(np.arange(len(self.counts)), self.counts) << np.int64(32)) | self.positions

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each term (its number here) stands at each position."""
        if not len(self.keys):
            return np.zeros(len(term), bool)
        key = (term << np.int64(32)) | position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.keys[at] == key

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, position, side="right") - 1


class Phrases:
    """Distinct phrases with their items, terms ordered from the rarest."""

    def __init__(self, items: list[tuple[int, list[bytes]]], n: int, counts: dict[bytes, int]):
        owners: dict[tuple, set] = {}
        for item, w in items:
            for i in range(max(1, len(w) - n + 1) if w else 0):
                owners.setdefault(tuple(w[i:i + n]), set()).add(item)
        # a phrase with a term that the corpus never uses cannot occur
        owners = {p: o for p, o in owners.items() if all(counts.get(t) for t in p)}
        self.items = [sorted(o) for o in owners.values()]
        self.vocabulary = sorted({t for p in owners for t in p})
        number = {t: i for i, t in enumerate(self.vocabulary)}
        self.length = np.array([len(p) for p in owners], np.int64)
        width = int(self.length.max()) if len(owners) else 0
        self.term = np.full((len(owners), width), -1, np.int64)
        self.offset = np.zeros((len(owners), width), np.int64)
        for r, p in enumerate(owners):
            order = sorted(range(len(p)), key=lambda j: (counts[p[j]], j))
            self.term[r, :len(p)] = [number[p[j]] for j in order]
            self.offset[r, :len(p)] = order

    def search(self, s: Segment) -> tuple[np.ndarray, np.ndarray]:
        """All (start position, phrase number) at which a phrase stands in the segment."""
        local = np.array([s.terms.get(t, -1) for t in self.vocabulary], np.int64)
        if not len(local) or not len(s.positions):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        term = np.where(self.term >= 0, local[self.term], -2)
        alive = np.flatnonzero((term != -1).all(axis=1))
        load = s.counts[term[alive, 0]]
        out, i = [], 0
        while i < len(alive):                                        # bounded numbers of candidates at a time
            j = max(i + 1, i + int(np.searchsorted(np.cumsum(load[i:]), CANDIDATES, side="right")))
            which = np.repeat(alive[i:j], load[i:j])
            begin = np.repeat(s.first[term[alive[i:j], 0]], load[i:j])
            nth = np.arange(len(which)) - np.repeat(np.cumsum(load[i:j]) - load[i:j], load[i:j])
            start = s.positions[begin + nth] - self.offset[which, 0]
            for c in range(1, term.shape[1]):
                if not len(which):
                    break
                t = term[which, c]
                keep = (t == -2) | s.has(np.maximum(t, 0), start + self.offset[which, c])
                which, start = which[keep], start[keep]
            out.append((start, which))
            i = j
        return np.concatenate([x for x, _ in out] or [np.empty(0, np.int64)]), np.concatenate([x for _, x in out] or [np.empty(0, np.int64)])


_MATCHES = "segment long, ordinal int, item_id long, start long, stop long"


def _blocks(benchmark: DataFrame, n: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Test items with their words, in blocks of at most ``BLOCK_PHRASES`` phrases."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").filter("item_id IS NOT NULL").toLocalIterator():
        w = words(r.text)
        if w:
            block.append((r.item_id, w))
            size += max(1, len(w) - n + 1)
        if size >= BLOCK_PHRASES:
            yield block
            block, size = [], 0
    if block:
        yield block


def vocabulary_of(benchmark: DataFrame, n: int = PHRASE) -> list[bytes] | None:
    """The test terms in order, or None when there are more than ``MAX_VOCABULARY``."""
    found: set[bytes] = set()
    for block in _blocks(benchmark, n):
        found.update(t for _, w in block for t in w)
        if len(found) > MAX_VOCABULARY:
            return None
    return sorted(found)


def phrase_matches(index: DataFrame, benchmark: DataFrame, n: int = PHRASE) -> DataFrame:
    """(segment, ordinal, item_id, start, stop): word spans of every document where a phrase of an item stands.

    Spans of one item that overlap or touch in a document are merged.
    """
    found = None
    counts_table = materialise(term_counts(index))
    for block in _blocks(benchmark, n):
        terms = sorted({t for _, w in block for t in w})
        asked = index.sparkSession.createDataFrame([(bytearray(t),) for t in terms], "term binary")
        counts = {bytes(r.term): r.n for r in counts_table.join(F.broadcast(asked), "term", "left_semi").collect()}
        phrases = Phrases(block, n, counts)

        def search(batches, phrases=phrases):
            for batch in batches:
                for row in batch.to_pylist():
                    s = Segment(row)
                    start, which = phrases.search(s)
                    if len(start):
                        yield _merged(row["segment"], s, start, which, phrases)
        part = index.mapInArrow(search, _MATCHES)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else index.sparkSession.createDataFrame([], _MATCHES)


def _merged(segment: int, s: Segment, start: np.ndarray, which: np.ndarray, phrases: Phrases) -> pa.RecordBatch:
    doc = s.doc_of(start)
    begin = start - s.starts[doc]
    end = begin + phrases.length[which]
    rows = sorted((int(d), item, int(b), int(e)) for d, w, b, e in zip(doc, which, begin, end) for item in phrases.items[w])
    out: list[list[int]] = []
    for d, item, b, e in rows:
        if out and out[-1][0] == d and out[-1][1] == item and b <= out[-1][3]:
            out[-1][3] = max(out[-1][3], e)
        else:
            out.append([d, item, b, e])
    columns = list(zip(*out))
    return pa.RecordBatch.from_arrays(
        [pa.array([segment] * len(out), pa.int64()), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]],
        names=["segment", "ordinal", "item_id", "start", "stop"])


def near_matches(index: DataFrame, query: str, span: int) -> DataFrame:
    """(doc_id, position): places of the query's rarest term with every other term at most ``span`` words away."""
    terms = sorted(set(words(query)))
    if not terms:
        return index.sparkSession.createDataFrame([], "doc_id long, position long")
    asked = index.sparkSession.createDataFrame([(bytearray(t),) for t in terms], "term binary")
    counts = {bytes(r.term): r.n for r in term_counts(index).join(F.broadcast(asked), "term", "left_semi").collect()}
    order = sorted(terms, key=lambda t: (counts.get(t, 0), t))

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                s = Segment(row)
                if any(t not in s.terms for t in order):
                    continue
                lists = [s.positions[s.first[i]:s.first[i] + s.counts[i]] for i in (s.terms[t] for t in order)]
                at = lists[0]
                doc = s.doc_of(at)
                for other in lists[1:]:
                    low = np.maximum(at - span, s.starts[doc])
                    high = np.minimum(at + span, s.starts[doc] + np.array(s.n_words)[doc] - 1)
                    keep = np.searchsorted(other, high, side="right") > np.searchsorted(other, low)
                    at, doc = at[keep], doc[keep]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([s.doc_ids[d] for d in doc], pa.int64()), pa.array(at - s.starts[doc], pa.int64())],
                                                     names=["doc_id", "position"])
    return index.mapInArrow(search, "doc_id long, position long")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = PHRASE) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted strings), contaminated."""
    index = build_index(docs, vocabulary_of(benchmark, n))
    found = phrase_matches(index, benchmark, n)
    spans = F.array_sort(F.collect_list(F.struct("start", "stop")))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    covered = F.aggregate("spans", zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0).cast("long"), x["stop"] - F.greatest(x["start"], a["upto"]))).alias("n"),
        F.greatest(a["upto"], x["stop"]).alias("upto")), lambda a: a["n"])
    hit = materialise(found.groupBy("segment", "ordinal").agg(spans.alias("spans"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
                      .select("segment", "ordinal", covered.alias("n_hit"), F.array_sort("items").alias("items")))
    every = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "d")).select(
        "segment", "ordinal", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    return (checked_join(every, hit, ["segment", "ordinal"], "left", 512)
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns; equal rows are judged alike."""
    keyed = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    judged = contamination(keyed.select(F.col("__key").alias("doc_id"), "text"), benchmark)
    bad = materialise(judged.filter("contaminated").select(F.col("doc_id").alias("__key")).distinct())
    return checked_join(keyed, bad, "__key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contamination of every document by the contract of op1."""
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
