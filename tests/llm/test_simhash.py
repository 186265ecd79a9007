import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dockcast.llm import simhash as sh
from dockcast.llm.simhash import classes, links, shingle_hashes, simhash_query

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode())
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hs) > len(hs))


def plain_classes(rows):
    """rows: (doc_id, fingerprint as an int); classes by comparing all pairs."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for d, f in rows:
        r = find(f)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return Counter((d, f, least[find(f)]) for d, f in rows)


def table():
    rng = random.Random(5)
    vocab = [f"Wort{i}é" for i in range(400)]
    rows = []
    for g in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([40, 150, 600]))]
        for _ in range(rng.choice([1, 2, 5, 12])):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((len(rows) * 13 % 997, " ".join(t)))
    return rows + [(2000, "A b"), (2001, "a\tB "), (2002, None), (2003, ""), (None, " \n"), (None, "a b"), (1999, "x y z"), (2004, "one"),
                   (2005, "same " * 60_000), (2006, "same same same same"), (2000, "A b"), (2007, "w" * 200_000)]


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def test_query_equals_all_pairs(docs):
    rows = table()
    got = simhash_query(docs(rows)).collect()
    want = plain_classes([(d, plain_fingerprint(t)) for d, t in rows])
    assert Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got) == want
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in got)
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want}) < len(rows)


def test_hash_is_sparks(spark):
    texts = ["", "a", "a b c", "é ü x" * 9, "x" * 1000]
    got = [r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t").alias("h")).collect()]
    assert got == [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in texts]


def test_long_texts_in_pieces(monkeypatch):
    text = b" ".join(b"w%d" % (i % 50) for i in range(3000))
    whole = np.concatenate(list(shingle_hashes(text)))
    for piece in (1, 7, 100):
        monkeypatch.setattr(sh, "PIECE", piece)
        assert (np.concatenate(list(shingle_hashes(text))) == whole).all()
        assert [h.tolist() for h in shingle_hashes(b"  a  b ")] == [[xxhash.xxh64_intdigest(b"a b", 42)]]
        assert list(shingle_hashes(b" \n ")) == list(shingle_hashes(b"")) == []


def near_points(n, rng):
    """Distinct fingerprints: random ones, chains two bits apart, and a dense ball."""
    out = set(rng.integers(0, 1 << 63, n, dtype=np.uint64).tolist())
    for _ in range(n // 20):
        x = int(rng.integers(0, 1 << 63, dtype=np.uint64))
        for _ in range(10):
            out.add(x)
            x ^= (1 << int(rng.integers(0, 64))) | (1 << int(rng.integers(0, 64)))
    for _ in range(n):
        out.add(0xABCDEF0123456789 ^ sum(1 << int(b) for b in set(rng.integers(0, 64, 3).tolist())))
    return sorted(out)


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_local_search_finds_every_pair_once_or_more(monkeypatch, radius):
    monkeypatch.setattr(sh, "LEAF", 8)
    points = np.array(near_points(300, np.random.default_rng(1)), np.uint64)
    home, visit = points[::3], np.concatenate([points[1::3], points[2::3]])
    both = np.concatenate([home, visit])
    found = {tuple(sorted(p)) for a, b in links(home, visit, radius) for p in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(home)) for j in range(i + 1, len(both)) if int(both[i] ^ both[j]).bit_count() <= radius}
    assert found == want


@pytest.mark.parametrize("shard,leaf,held", [(50, 8, 100), (300, 30, 1 << 22), (1 << 14, 192, 1 << 22)])
def test_classes_over_many_shards(spark, monkeypatch, shard, leaf, held):
    """Boundary-crossing links are found however the shards fall; a fingerprint that holds most rows is one point."""
    monkeypatch.setattr(sh, "SHARD", shard)
    monkeypatch.setattr(sh, "LEAF", leaf)
    monkeypatch.setattr(sh, "HELD", held)
    points = near_points(400, np.random.default_rng(2))
    rows = [(i * 7919 % 100_003, f) for i, f in enumerate(points)] + [(200_000 + i, points[3]) for i in range(900)] + [(None, points[5]), (None, 1 << 63)]
    frame = sh.materialise(spark.createDataFrame([(d, signed(f)) for d, f in rows], "doc_id long, fp long").repartition(5))
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in classes(frame).collect())
    assert got == plain_classes(rows)


def test_every_shard_tree_point_has_one_home(monkeypatch):
    points = np.array(near_points(500, np.random.default_rng(3)), np.uint64)
    tree = sh.ShardTree(points[::4], 12)
    homes = Counter()
    for shard, at, home in tree.route(points):
        assert 0 <= shard < tree.shards
        homes.update(at[home].tolist())
    assert homes == Counter(range(len(points)))


def test_empty_table_and_clashing_columns(docs):
    assert simhash_query(docs([])).collect() == []
    df = docs([(1, "a b c d"), (2, "a b c d")]).selectExpr("*", "1 AS fp", "2 AS first", "3 AS component_id", "4 AS shard", "5 AS home")
    assert {(r.doc_id, r.component_id) for r in simhash_query(df).collect()} == {(1, 1), (2, 1)}
