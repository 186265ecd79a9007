import random
import zlib

import numpy as np
import pytest

from dockcast.llm import quality as q


def rows():
    rng = random.Random(4)
    syllables = ["the", "on", "er", "at", "re", "in", "ing", "éa"]
    out, labels = [], []
    for i in range(400):
        w = ["".join(rng.choice(syllables) for _ in range(rng.choice([1, 2, 3]))) for _ in range(rng.choice([5, 40, 300]))]
        bad = i % 4 == 0
        out.append((i, " ".join(x + (rng.choice(["%%%", "###", "$$$"]) if bad else "") for x in w)))
        labels.append((i, int(not bad), 0))
    return out, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_edge_rows(spark, docs):
    data, labels = rows()
    data += [(1000, None), (1001, ""), (None, "the on"), (1002, "on " * 100_000), (5, data[5][1])]
    labels += [(1003, 1, 0), (1000, None, 0), (None, 1, 0), (7, None, None)]
    got = q.quality_query(docs(data), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(data)
    want = {i: y for i, y, _ in labels if i is not None and i < 400 and y is not None}
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert len(held) > 80 and np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    again = q.quality_query(docs(data[::-1], parts=5), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted((r.doc_id or -1, round(r.score, 6)) for r in again) == sorted((r.doc_id or -1, round(r.score, 6)) for r in got)


def test_no_labels_and_empty_tables(spark, docs):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in q.quality_query(docs([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert q.quality_query(docs([]), none).collect() == []
    data, labels = rows()
    df = docs(data).selectExpr("*", "9 AS score", "'x' AS quality")
    kept = q.keep_good(df, spark.createDataFrame(labels, LABELS))
    assert kept.columns == df.columns and {r.doc_id % 4 for r in kept.collect()} <= {1, 2, 3} and kept.count() > 280


@pytest.mark.parametrize("n", [0, 1, 4, 1023, 1024, 1025, 5000])
def test_scores_equal_a_plain_convolution(n):
    rng = np.random.default_rng(n)
    net = q.Network(rng)
    text = bytes(rng.integers(1, 255, n, dtype=np.uint8).tolist())
    data = (text or b"\0") + b"\0" * (q.WIDTH - 1)
    size = max(1, n)
    resp = np.array([net.bias + sum(net.tables[j][data[i + j]] for j in range(q.WIDTH)) for i in range(size)])
    spans = q.chunks(size)
    assert spans[0][0] == 0 and spans[-1][1] == size and all(b[0] < a[1] for a, b in zip(spans, spans[1:]))
    mean = np.mean([np.maximum(resp[a:b].max(0), 0) for a, b in spans], axis=0)
    want = 1 / (1 + np.exp(-(mean @ net.weights + net.base[0])))
    assert net.scores([b"other", text, b""])[1] == pytest.approx(want, rel=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = q.Network(rng)
    net.tables = net.tables.astype(np.float64)
    texts, y, w = [b"hello world", b"abc"], np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        p = net.scores(texts)
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
    grads = net.gradients(texts, y, w)
    for param, grad in zip(net.params, grads):
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in param.shape) if param is not net.tables else (rng.integers(5), rng.choice(list(b"hello wrdabc")), rng.integers(q.FILTERS))
            old = param[at]
            param[at] = old + 1e-3
            up = loss()
            param[at] = old - 1e-3
            down = loss()
            param[at] = old
            assert grad[at] == pytest.approx((up - down) / 2e-3, abs=2e-2)
