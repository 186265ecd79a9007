"""Quality classifier (operator 2): a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, cut into overlapping chunks that cover all of it.  ``FILTERS``
learned filters of ``WIDTH`` bytes slide over every chunk; each filter's largest response in
a chunk is kept (max-pooling), rectified, averaged over the chunks, and a logistic unit
combines the averages into one probability.  As a filter sees bytes one-hot, its response
is a sum of table entries, one per byte, which is how both training and scoring compute it.

Training runs on the driver over a bounded sample: at most ``PER_CLASS`` labelled rows of each
label in a fixed hash order of their ids, texts up to ``TRAIN_BYTES``.  Only rows whose
``crc32(doc_id as text) % 3`` is not 1 are used; the others are held out.  Label, language,
source and id never enter a score.  Scoring runs over every whole text in the tasks.

Defined cases: null and empty texts are scored as one end-of-text window; null labels
and labels without a document are not used; without rows of both labels all scores are the
share of label 1 among them (0.5 without any); a null doc_id is not held out; repeated
rows are scored each; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockcast.llm.textarrays import text_runs

FILTERS = 16
WIDTH = 5
CHUNK = 1024            # positions of a chunk
STRIDE = 960            # chunks overlap by CHUNK - STRIDE positions
PER_CLASS = 1000
TRAIN_BYTES = 64 << 10
EPOCHS = 12
BATCH = 32
RATE = 0.02
SEED = 7
REJECT_BELOW = 0.3      # a filter drops only texts scored well below one half
SLICE = 1 << 13         # positions convolved at a time: their responses stay in the processor's cache
RUN_BYTES = 1 << 20     # text handled at a time


def chunks(n: int) -> list[tuple[int, int]]:
    """Overlapping stretches that cover positions 0..n-1 (n at least 1)."""
    return [(s, min(s + CHUNK, n)) for s in range(0, max(1, n - (CHUNK - STRIDE)), STRIDE)]


def joined(texts: list[bytes]) -> tuple[np.ndarray, list[tuple[int, int]], np.ndarray]:
    """One byte array (texts end in zeros), all chunks in it, and each text's number of chunks."""
    pad, parts, spans, counts, at = b"\0" * (WIDTH - 1), [], [], [], 0
    for t in texts:
        t = t or b"\0"
        own = chunks(len(t))
        spans += [(at + s, at + e) for s, e in own]
        counts.append(len(own))
        parts += (t, pad)
        at += len(t) + len(pad)
    return np.frombuffer(b"".join(parts), np.uint8), spans, np.array(counts, np.int64)


class Network:
    """Filter tables (WIDTH, 256, FILTERS), biases, and the weights of the logistic unit."""

    def __init__(self, rng: np.random.Generator):
        self.tables = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.weights = rng.normal(0, 0.3, FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    @property
    def params(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.weights, self.base]

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every position that has WIDTH bytes."""
        n = len(data) - WIDTH + 1
        out = self.bias + self.tables[0][data[:n]]
        for j in range(1, WIDTH):
            out += self.tables[j][data[j:j + n]]
        return out

    def pooled(self, data: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
        """Rectified maxima of each chunk, ``SLICE`` positions at a time."""
        out, i = [], 0
        while i < len(spans):
            j = i + 1
            while j < len(spans) and spans[j][1] - spans[i][0] <= SLICE:
                j += 1
            low = spans[i][0]
            r = self.responses(data[low:spans[j - 1][1] + WIDTH - 1])
            cuts = np.array(spans[i:j]).ravel() - low
            cuts = cuts[:-1]                       # the last chunk runs to the end
            out.append(np.maximum.reduceat(r, cuts, axis=0)[::2])
            i = j
        return np.maximum(np.concatenate(out), 0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        data, spans, counts = joined(texts)
        means = np.add.reduceat(self.pooled(data, spans), np.cumsum(counts) - counts, axis=0) / counts[:, None]
        return 1 / (1 + np.exp(-np.clip(means.astype(np.float64) @ self.weights + self.base, -30, 30)))

    def gradients(self, texts: list[bytes], label: np.ndarray, importance: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weighted log loss, summed over the texts."""
        data, spans, counts = joined(texts)
        r = self.responses(data)
        at = np.stack([s + r[s:e].argmax(0) for s, e in spans])
        top = r[at, np.arange(FILTERS)]
        pooled = np.maximum(top, 0)
        first = np.cumsum(counts) - counts
        means = np.add.reduceat(pooled, first, axis=0) / counts[:, None]
        p = 1 / (1 + np.exp(-np.clip(means @ self.weights + self.base, -30, 30)))
        off = ((p - label) * importance).astype(np.float32)
        back = np.repeat(off / counts, counts)[:, None] * self.weights * (top > 0)
        tables = np.zeros_like(self.tables)
        columns = np.broadcast_to(np.arange(FILTERS), at.shape)
        for j in range(WIDTH):
            np.add.at(tables[j], (data[at + j], columns), back)
        return [tables, back.sum(0), off @ means, off.sum(keepdims=True)]


def train(texts: list[bytes], labels: list[int], seed: int = SEED, epochs: int = EPOCHS) -> Network | float:
    """A network fitted with Adam; the share of label 1 if there are no rows of both labels."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    net = Network(rng)
    importance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    m = [np.zeros_like(p) for p in net.params]
    v = [np.zeros_like(p) for p in net.params]
    step, total = 0, epochs * -(-len(y) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            pick = order[i:i + BATCH]
            step += 1
            rate = RATE * (1 - 0.9 * step / total)
            for p, g, a, b in zip(net.params, net.gradients([texts[q] for q in pick], y[pick], importance[pick]), m, v):
                g = g / len(pick)
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-7)
    return net


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> list:
    """The bounded sample: rows (text, quality)."""
    usable = labels.select("doc_id", "quality").filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    short = docs.select("doc_id", "text").filter(F.octet_length("text") <= TRAIN_BYTES)
    out = []
    for q in (0, 1):
        order = F.xxhash64(F.lit(SEED), "doc_id")
        # ids first, so that only the sampled texts are fetched
        ids = usable.filter(F.col("quality") == q).select("doc_id").distinct().join(short.select("doc_id").distinct(), "doc_id").orderBy(order).limit(per_class)
        out += short.join(F.broadcast(ids), "doc_id").select("doc_id", "text", F.lit(q).alias("quality")).orderBy(order, "text").limit(per_class).collect()
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Network | float:
    rows = training_rows(docs, labels)
    return train([r.text.encode() for r in rows], [r.quality for r in rows])


def score(docs: DataFrame, model: Network | float, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row of ``docs`` (key, text); ``key`` may be a struct of the whole row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            done, n = [], 0
            for at, texts in text_runs([pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(1)], names=["i", "t"])],
                                       False, RUN_BYTES):
                done.append(np.full(len(texts), model) if isinstance(model, float) else model.scores(texts))
                n += len(texts)
            if n:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(done), pa.float64())], names=[key, "score"])
    return docs.select(key, "text").mapInArrow(run, f"`{key}` {kind}, score double")


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of every document by the contract of op2."""
    return (score(docs, fit(docs, labels))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """The rows of ``docs`` that score at least ``reject_below``, all columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scored = score(docs.select(whole.alias("__doc"), "text"), fit(docs, labels), "__doc")
    return scored.filter(F.col("score") >= reject_below).select("__doc.*")
