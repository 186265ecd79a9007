import hashlib
import zlib
from collections import Counter

import pytest

from dockcast.llm import merkle
from dockcast.llm.merkle import MERKLE_SQL, merkle_query

DOC = "doc_id long, source string, lang string, n_chars long, text string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def grow(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h("".join(now[i:i + 16])) for i in range(0, len(now), 16)])
    return levels


def around(levels, i):
    """(left, right) siblings at every level above node i."""
    out = []
    for nodes in levels[:-1]:
        run = i // 16 * 16
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + 16])))
        i //= 16
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0], h("".join(map(enc, r))), h("".join(map(enc, (*r[:4], lower(r[4])))))))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = grow([x[1] for x in by[s]])
    top = grow([trees[s][-1][0] for s in names])
    root = top[-1][0]
    out = []
    for k, s in enumerate(names):
        for i, (doc, leaf, changed) in enumerate(by[s]):
            path = around(trees[s], i) + around(top, k)
            tampered = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
            now = changed if tampered else leaf
            for a, b in path:
                now = h(a + now + b)
            out.append((doc, leaf, trees[s][-1][0], root, h("".join(a + b for a, b in path)), now, now == root))
    return out


def make(spark, rows, parts=4):
    return spark.createDataFrame(rows, DOC).repartition(parts)


def table():
    rows = [(i * 3 % 1009, "hot", "en", i, f"Text {i} É") for i in range(700)]
    rows += [(5000 + i, f"s{i:02d}", None, None, None) for i in range(20)]                  # trees of one leaf
    rows += [(6000 + i, "Straße", "de", i, "low only") for i in range(17)]
    rows += [(None, None, None, None, None), (None, None, "en", 3, "Abc"), (7, None, "en", 0, ""), (8, "", "en", 1, "X" * 300_000)]
    rows += [(7000, "twice", "en", 1, "Same")] * 5 + [(7000, "twice", "en", 1, "Other")] * 2
    return rows


def test_equals_plain_trees(spark):
    rows = table()
    got = merkle_query(make(spark, rows)).collect()
    assert Counter(map(tuple, got)) == Counter(brute(rows))
    again = merkle_query(make(spark, rows[::-1], 7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


@pytest.mark.parametrize("deep", [1, 2])
def test_several_rounds_up_and_down(spark, monkeypatch, deep):
    """Superblocks of one or two levels, so that 700 leaves and 25 sources need several rounds."""
    monkeypatch.setattr(merkle, "DEEP", deep)
    monkeypatch.setattr(merkle, "BLOCK", 16 ** deep)
    rows = table()
    assert Counter(map(tuple, merkle_query(make(spark, rows)).collect())) == Counter(brute(rows))


def test_sql_gives_the_same(spark, sql_rows):
    rows = table()[:400] + table()[690:]
    docs = make(spark, rows)
    got = merkle_query(docs)
    assert Counter(map(tuple, got.select(sorted(got.columns)).collect())) == Counter(sql_rows(MERKLE_SQL, documents=docs))


def test_tampering_is_found_where_it_changes_the_text(spark):
    rows = [(i, "s", "en", 1, "ABC" if i % 2 else "abc") for i in range(300)]
    got = {r.doc_id: r for r in merkle_query(make(spark, rows)).collect()}
    for i, *_ in rows:
        assert got[i].verified == (not (i % 2 and zlib.crc32(str(i).encode()) % 5 == 0))
        assert got[i].verified == (got[i].folded_root == got[i].root)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 257])
def test_small_and_empty_tables_with_extra_columns(spark, n):
    rows = [(i, "only", "en", i, f"T{i}") for i in range(n)]
    docs = make(spark, rows).selectExpr("*", "1 AS pos", "2 AS tree", "3 AS digest", "4 AS n", "5 AS block", "6 AS root", "7 AS part")
    assert Counter(map(tuple, merkle_query(docs).collect())) == Counter(brute(rows) if rows else [])


def test_a_hot_source_is_cut_into_superblocks(spark):
    rows = [(i, "hot", None, None, "t") for i in range(3 * merkle.BLOCK + 5)]
    leaves = merkle.materialise(merkle.document_leaves(make(spark, rows)))
    placed = merkle.place(leaves, [merkle.F.col("doc_id")])
    assert sorted(r.pos for r in placed.select("pos").collect()) == list(range(len(rows)))
    rounds = merkle.climb(placed)
    assert [r.count() for r in rounds] == [len(rows), 4, 1]
    assert rounds[-1].first().digest == grow([h("".join(map(enc, r))) for r in rows])[-1][0]
