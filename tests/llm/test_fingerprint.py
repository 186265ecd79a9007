import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from dockcast.llm.fingerprint import K, SHORT, W, _cut, fingerprint, fingerprint_query

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
M64 = (1 << 64) - 1


def h(s):
    v = xxhash.xxh64_intdigest(s.encode(), seed=42)
    return v


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def rotl(v, b):
    return ((v << b) | (v >> (64 - b))) & M64


def brute(text):
    """Winnowing window by window, from the definition."""
    t = [x for word in WORDS.findall(text or "") for x in ([word] if len(word) <= 16 else word)]
    if not t:
        return []
    if len(t) < K:
        g = [h(" ".join(t))]
    else:
        g = []
        for i in range(len(t) - K + 1):
            v = 0
            for x in t[i:i + K]:
                v = rotl(v, 1) ^ h(x)
            g.append(v)
    if len(g) <= SHORT:
        return [(signed(v), i) for i, v in enumerate(g)]
    out = []
    for i in range(len(g) - W + 1):
        window = range(i, min(i + W, len(g)))
        least = min(g[j] >> 29 for j in window)
        at = max(j for j in window if g[j] >> 29 == least)
        if not out or out[-1][1] != at:
            out.append((signed(g[at]), at))
    return out


def text_of(fp):
    return ",".join(f"{v & M64:x}:{p}" for v, p in fp)


def like(a, b):
    a, b = {v for v, _ in a}, {v for v, _ in b}
    return 1.0 if not a | b else len(a & b) / len(a | b)


def rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["é\U0001f600x", "longer-than-sixteen-characters-word"]
    out = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 10, 11, 12, 40, 300])))) for i in range(700)]
    return out + [(2200, None), (2201, ""), (2202, " \n\t"), (2203, "same " * 50), (2204, "z" * 50_000), (None, "null id text one two three"),
                  (5, out[1][1]), (2205, " ".join(rng.choice(words) for _ in range(20_000)))]


def test_query_equals_brute_force(docs):
    data = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = {r.doc_id: r for r in fingerprint_query(docs(data)).collect()}
    assert len(got) == len(data)
    for (i, t), (_, after) in zip(data, data[1:] + data[:1]):
        t, after = t or "", after or ""
        q = len(t) // 4
        e = t[:len(t) - q] + after[:q]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert r.fingerprint == text_of(brute(t)) and r.edited_fingerprint == text_of(brute(e))
        assert r.near_edited == pytest.approx(like(brute(t), brute(e))) and r.near_next == pytest.approx(like(brute(t), brute(after)))


def test_single_repeated_and_empty(docs):
    one = fingerprint_query(docs([(1, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    twice = fingerprint_query(docs([(1, "a b"), (1, "a b"), (1, "c d")])).collect()
    assert sorted(r.n_chars for r in twice) == [3, 3, 3]
    assert fingerprint_query(docs([])).collect() == []


def test_match_guarantee(spark):
    rng = random.Random(9)
    for _ in range(20):
        shared = [str(rng.randrange(10 ** 6)) for _ in range(K + W - 1)]                  # a short text among them
        texts = [" ".join([str(rng.randrange(10 ** 6)) for _ in range(rng.randrange(20))] + shared + [str(rng.randrange(10 ** 6)) for _ in range(rng.randrange(20))]) for _ in range(2)]
        a, b = ({v for v, _ in brute(t)} for t in texts)
        assert a & b
    fp = spark.createDataFrame([(texts[0],)], "text string").select(fingerprint(F.col("text")).alias("f")).first().f
    assert [(e.hash, e.pos) for e in fp] == brute(texts[0])


def test_shift_in_unspaced_text_and_short_texts(spark):
    rng = random.Random(4)
    passage = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(40))
    for before in range(1, 18):
        a, b = ({v for v, _ in brute("".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(n)) + passage + "\u4e00" * 30)} for n in (0, before))
        assert len(a & b) >= 3
    near = spark.createDataFrame([("one two three four five six seven eight", "one two three four five six seven nine"), (passage, "x" + passage)], "a string, b string")
    got = [[{e.hash for e in f} for f in r] for r in near.select(fingerprint(F.col("a")), fingerprint(F.col("b"))).collect()]
    assert [len(a & b) / len(a | b) > 0.5 for a, b in got] == [True, True]


def brute_next(data):
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is not None, data[i][0] or 0, signed(h(data[i][1] or ""))))
    return {i: order[(n + 1) % len(order)] for n, i in enumerate(order)}


def test_blocks_hold_equally_many_rows_wherever_keys_lie(docs):
    rng = random.Random(6)
    ids = [*range(6000), 1 << 60, -(1 << 63), (1 << 63) - 1, *range(1 << 40, (1 << 40) + 3000), *[None] * 2500, *[77_777] * 2500]
    data = [(i, f"text {n} {rng.random()}") for n, i in enumerate(ids)]
    d = docs(data).select("doc_id", "text")
    sizes = [r["count"] for r in _cut(d, "doc_id").groupBy("__block").count().collect()]
    assert sum(sizes) == len(data) and max(sizes) <= 4 * 256 + 64
    got = {r.edited_sha256 for r in fingerprint_query(docs(data)).collect()}
    after = brute_next(data)
    for i, (_, t) in enumerate(data):
        q = len(t) // 4
        assert hashlib.sha256((t[:len(t) - q] + data[after[i]][1][:q]).encode()).hexdigest() in got


def test_equal_rows_stay_in_one_block(docs):
    same = [(5, "the same row")] * 3000 + [(i, f"row {i}") for i in range(4, 9)]
    got = fingerprint_query(docs(same)).collect()
    assert len(got) == len(same) and sum(r.near_next == 1.0 for r in got if r.doc_id == 5) >= 2999
