from collections import Counter
from itertools import permutations

from dockcast.llm.filteraudit import AUDIT_SQL, audit_query, intervals, orders

LABEL = "doc_id long, quality int, toxic int"


def _fails(rows):
    """Failed filters of every row, by plain loops."""
    out = []
    for i, text, _ in rows:
        t = text or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t):
            f.add("C")
        if any(c in "#$%&*|" for c in t):
            f.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows):
            f.add("E")
        out.append(f)
    return out


def _brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = _fails(rows)
    out = {}
    for part in {r[2] or "" for r in rows}:
        members = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = Counter()
        lines = []
        for p in permutations("ABCDE"):
            gone = [None] * len(members)
            for k, letter in enumerate(p, 1):
                here = [m for m, (_, f) in enumerate(members) if letter in f and gone[m] is None]
                again = sum(letter in f and gone[m] is not None for m, (_, f) in enumerate(members))
                for m in here:
                    gone[m] = k
                shapley[letter] += len(here)
                lines.append((part, "".join(p), k, sum(g is None for g in gone), len(here), again,
                              sum(f == {letter} for _, f in members), sum(members[m][0] in good for m in here),
                              sum(members[m][0] in toxic for m in here)))
        for line in lines:
            out[line[:3]] = line[3:] + (shapley[line[1][line[2] - 1]],)
    return out


def _frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return docs, spark.createDataFrame(labels, LABEL).repartition(2)


def _rows():
    long = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", "short text", "SHOUT", long, long + " $", long.upper(), "same " * 300, "a|b", long, "é" * 70 + "AB", " x y", "x " * 50_000]
    rows = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(texts * 4)]
    rows += [(None, long, "en"), (None, long, "en"), (3, "SHOUT", "en"), (3, "SHOUT", "en"), (3, "SHOUT", "de")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 50, 3)] + [(0, 1, None), (6, None, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, [(a, b, None if c is None else int(c)) for a, b, c in labels]


def test_equals_every_order_applied_in_turn(spark):
    rows, labels = _rows()
    got = audit_query(*_frames(spark, rows, labels)).collect()
    want = _brute(rows, labels)
    assert len(got) == len(want) == 120 * 5 * 3
    for r in got:
        assert tuple(r)[3:] == want[tuple(r)[:3]], r


def test_sql_gives_the_same(spark, sql_rows):
    rows, labels = _rows()
    docs, lab = _frames(spark, rows, labels)
    got = audit_query(docs, lab)
    assert Counter(map(tuple, got.select(sorted(got.columns)).collect())) == Counter(
        sql_rows(AUDIT_SQL, documents=docs, labels=lab))


def test_intervals_cover_every_order_once():
    names = orders()
    assert names == sorted(names) and len(names) == 120
    for mask in range(32):
        for step in range(1, 6):
            covered = Counter(i for m, k, lo, hi, *_ in intervals() if m == mask and k == step for i in range(lo, hi))
            assert all(v == 1 for v in covered.values())
            assert set(covered) == {i for i, p in enumerate(names) if mask >> "ABCDE".index(p[step - 1]) & 1}
        removed = Counter(i for m, _, lo, hi, out, _, _ in intervals() if m == mask and out for i in range(lo, hi))
        assert removed == Counter(range(120) if mask else [])


def test_empty_clashing_columns_and_a_text_on_most_rows(spark):
    docs, labels = _frames(spark, [], [])
    assert audit_query(docs, labels).collect() == []
    rows = [(i, "one text", "en") for i in range(500)] + [(1000 + i, f"other {i}", "en") for i in range(5)]
    docs, labels = _frames(spark, rows, [(7, 1, 1)])
    clash = docs.selectExpr("*", "1 AS n", "'x' AS part", "2 AS mask", "3 AS h", "4 AS words", "5 AS good", "6 AS rank", "7 AS key")
    got = {(r.filter_order, r.step): r for r in audit_query(clash, labels.selectExpr("*", "9 AS n", "9 AS part")).collect()}
    assert got["EABCD", 1].removed == 499 and got["EABCD", 1].good_lost == 1
    assert got["ABCDE", 5].redundant == 499 and got["ABCDE", 1].removed == 505
