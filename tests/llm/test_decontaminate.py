import hashlib
import random
import re
from collections import Counter

import pytest

from dockcast.llm import decontaminate as dc

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items):
    out = Counter()
    phrases = {}
    for item, t in items:
        w = WORDS.findall(lower(t))
        if item is not None and w:
            for i in range(max(1, len(w) - 12)):
                phrases.setdefault(tuple(w[i:i + 13]), set()).add(item)
    for i, t in docs:
        w = WORDS.findall(lower(t))
        hit, found = set(), set()
        for p, owners in phrases.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j:j + len(p)]) == p:
                    hit |= set(range(j, j + len(p)))
                    found |= owners
        ids = ",".join(sorted(map(str, found)))
        out[(i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))] += 1
    return out


def tables():
    rng = random.Random(1)
    vocab = ["the", "of", "a"] * 6 + [f"w{i}" for i in range(40)] + ["É", "été"]
    def text(n):
        return " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 13, 14, 30]))) for i in range(30)] + [(30, None), (31, "the " * 20), (31, "second text same id one two"), (None, "w1 w2")]
    items[5] = (5, items[4][1])
    docs = []
    for i in range(300):
        t = text(rng.choice([0, 5, 40, 300]))
        if i % 3 == 0:
            s = items[rng.randrange(31)][1] or ""
            t = t + ". " + s.upper().replace(" ", ", ") + "; " + text(10)
        docs.append((i, t))
    docs += [(400, None), (401, ""), (402, "the " * 5000), (403, items[3][1]), (403, items[3][1]), (None, items[7][1]), (404, text(60_000))]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_query_equals_brute_force(spark, docs, monkeypatch, small):
    rows, items = tables()
    if small:                                    # several segments, several blocks of phrases, all terms indexed, few candidates at a time
        monkeypatch.setattr(dc, "BLOCK_PHRASES", 40)
        monkeypatch.setattr(dc, "MAX_VOCABULARY", 3)
    df = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS term")
    got = dc.decontaminate_query(docs(rows), df).collect()
    assert Counter(map(tuple, got)) == brute(rows, items)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.decontaminate_query(docs([]), some).collect() == []
    got = dc.decontaminate_query(docs([(1, "a b"), (2, None)]), none).collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in got] == [(0, 0, False)] * 2


def test_near_matches(docs):
    index = dc.build_index(docs([(1, "apple x x pear x x fig"), (2, "pear x x x x x x x apple fig"), (3, "fig apple pear"), (4, None)]), None)
    got = {(r.doc_id, r.position) for r in dc.near_matches(index, "Fig, apple pear", 6).collect()}
    assert {d for d, _ in got} == {1, 3}
    assert dc.near_matches(index, "", 3).collect() == []
