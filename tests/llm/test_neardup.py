import random
import re

import numpy as np
import pytest

from dockcast.llm import neardup as nd
from dockcast.llm.components import components
from dockcast.llm.textarrays import run_hashes, word_hashes

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORDS.findall((text or "").encode().lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """Component of every doc_id by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= 75 * len(x | y):
                a_, b_ = sorted((find(a), find(b)))
                parent[b_] = a_
    return {(i, len(s)): (find(i) if s else i) for i, s in sets}


def table():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([30, 80, 400]))]
        for _ in range(rng.choice([1, 2, 6, 15])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((n * 7 % 997, " ".join(t).title()))
            n += 1
    chain = [rng.choice(vocab) for _ in range(200)]          # each near the next only
    for k in range(12):
        rows.append((2000 - k, " ".join(chain)))
        p = 16 * k
        chain = chain[:p] + [rng.choice(vocab) for _ in range(14)] + chain[p + 14:]
    return rows + [(3000, "a b c"), (3001, "A B\tc"), (3002, "a b"), (3003, None), (3004, ""), (3005, " \n"), (None, "a b c"), (None, None),
                   (3006, "same " * 40_000), (3007, "same same same same same"), (3000, "a b c")]


def test_query_equals_brute_force(docs):
    rows = table()
    want = brute(rows)
    got = nd.neardup_query(docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want[(r.doc_id, r.n_shingles)], r
        assert r.kept == (r.doc_id == r.component_id)
    assert len({r.component_id for r in got}) < len(got) - 20


@pytest.mark.parametrize("block", [512, 7])
def test_large_group_is_linked_through_its_members(docs, monkeypatch, block):
    """Copies near a base but not near each other: links that a bucket's centre misses are found."""
    monkeypatch.setattr(nd, "BLOCK", block)
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(500)]
    base = [rng.choice(vocab) for _ in range(150)]
    rows = []
    for i in range(80):
        t = list(base)
        for p in rng.sample(range(150), 4):
            t[p] = f"x{i}-{p}"
        rows.append((i, " ".join(t)))
    rows.append((500, " ".join(base)))
    want = brute(rows)
    got = {r.doc_id: r.component_id for r in nd.neardup_query(docs(rows)).collect()}
    assert got == {i: want[(i, n)] for i, n in want}


def test_empty_table_and_clashing_columns(docs):
    assert nd.neardup_query(docs([])).collect() == []
    df = docs([(1, "a b c d e f"), (2, "a b c d e f")]).selectExpr("*", "1 AS component_id", "2 AS registers", "3 AS node")
    assert [tuple(r) for r in nd.neardup_query(df).orderBy("doc_id").collect()] == [(1, 2, 1, True), (2, 2, 1, False)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    for j in (0.2, 0.5, 0.75, 0.95):
        n = 2000
        common = int(n * 2 * j / (1 + j))
        pool = rng.integers(0, 2 ** 63, 2 * n - common, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(pool[n - common:])
        ra, rb, rab = nd.registers(nd.minima([a, b, np.union1d(a, b)]))
        assert (nd.merge(ra, rb) == rab).all()
        got = nd.estimate(ra[None], rb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
        assert got == pytest.approx(j, abs=0.11)


def test_word_and_run_hashes_do_not_depend_on_pieces(monkeypatch):
    from dockcast.llm import textarrays
    texts = [b"one two  three", b"", b"\n x\x85y \t", b"w" * 5000 + b" end", b"one two three"]
    h, bounds = word_hashes(texts)
    assert np.diff(bounds).tolist() == [len(WORDS.findall(t)) for t in texts]
    assert len({*h[bounds[0]:bounds[1]].tolist()}) == 3 and (h[bounds[0]:bounds[1]] == h[bounds[4]:bounds[5]]).all()
    monkeypatch.setattr(textarrays, "PIECE", 7)
    h2, b2 = word_hashes(texts)
    assert (h == h2).all() and (bounds == b2).all()
    assert len(run_hashes(h, 3)) == len(h) - 2 and len(run_hashes(h[:2], 3)) == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 299)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {300: 299, 299: 299}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_open_buckets_compare_whole_shingles():
    from dockcast.llm import neardup

    def links(high):
        rows = [{"registers": bytes(2 * neardup.M), "n_shingles": 8, "node": n, "own": 0, "x": 0, "y": 0, "at": 0, "component": n,
                 "shingles": (np.arange(8, dtype=np.uint64) + (np.uint64(h) << np.uint64(32))).tobytes()} for n, h in ((1, 1), (2, high))]
        return [b.to_pylist() for b in neardup._links(rows)]
    assert links(2) == []
    assert links(1) == [[{"a": 1, "b": 2}]]
