import re
from collections import Counter, defaultdict

import duckdb
import pytest

from dockcast.llm.mixing import CAP, MIX_SQL, mix_query, mixed_rows, source_targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def iterated_targets(sizes):
    """Share by weight, cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] > CAP * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = CAP * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, "é": 70, None: 300, "Z": 0}, {"a": 7}, {"a": 100, "b": 100, "c": 100},
                                   {"x": 0, "y": 0}, {f"s{i}": (i * 37) % 11 * 50 + 1 for i in range(30)}])
def test_targets_equal_the_iteration(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(iterated_targets(sizes))


def rows():
    out = [(i, " ".join(["w"] * ((i * 7919) % 300)), "abcde"[i % 5]) for i in range(1500)]
    return out + [(None, None, None), (9000, "a b", None), (9001, "", "e"), (9001, "", "e"), (9002, "x " * 5000, "a")]


def test_query_comes_near_targets_and_agrees_with_sql(docs):
    df = docs(rows())
    got = mix_query(df).collect()
    assert len(got) == len(rows())
    sizes, taken, target = Counter(), Counter(), {}
    source = defaultdict(set)
    for i, t, s in rows():
        sizes[s] += len(WORDS.findall(t or ""))
        source[i].add(s)
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        s = next(iter(source[r.doc_id]))
        taken[s] += r.taken
        target[s] = r.target
        assert r.source_size == sizes[s]
    for s in "abcde":
        assert taken[s] == pytest.approx(target[s], rel=0.05)
    assert Counter(map(tuple, mix_query(docs(rows()[::-1], parts=9)).collect())) == Counter(map(tuple, got))
    documents = df.toArrow()  # noqa: F841
    want = duckdb.sql(MIX_SQL).fetchall()
    assert Counter(want) == Counter(map(tuple, got))


def test_mixed_rows_repeat_whole_rows_and_empty_table(docs):
    df = docs(rows()).selectExpr("*", "'kept' AS target")
    out = mixed_rows(df).collect()
    assert out[0].target == "kept" and len(out[0]) == 6
    assert sum(len(WORDS.findall(r.text or "")) for r in out) == sum(r.taken for r in mix_query(df).collect())
    assert mix_query(docs([])).collect() == [] and mixed_rows(docs([])).collect() == []
