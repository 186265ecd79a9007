import zlib
from collections import Counter

import numpy as np
import pytest

from dockcast.llm.sharding import Permutation, shard_query, shard_rows


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 255, 256, 1000, 4097])
def test_permutation_is_a_bijection_with_inverse(n):
    p = Permutation(n, seed=5)
    y = p.forward(np.arange(n))
    assert sorted(y.tolist()) == list(range(n))
    assert p.inverse(y).tolist() == list(range(n))
    if n > 100:
        assert (y != np.arange(n)).mean() > 0.9
        assert (Permutation(n, seed=6).forward(np.arange(n)) != y).mean() > 0.9


def test_query_on_nulls_repeats_and_long_texts(docs):
    rows = [(i, f"text {i} é") for i in range(50)] + [(None, None), (3, "text 3 é"), (3, "text 3 é"), (7, ""), (8, "x" * 200_000)]
    got = shard_query(docs(rows)).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(8))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = shard_query(docs(rows[::-1], parts=7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_empty_and_clashing_columns(docs):
    assert shard_query(docs([])).collect() == []
    df = docs([(i, "a") for i in range(5)]).selectExpr("*", "'old' AS shard", "7 AS slot", "doc_id AS size")
    out = shard_rows(df, shards=2)
    assert sorted(out.columns) == sorted(df.columns)
    assert Counter(r.shard for r in out.collect()) == {0: 3, 1: 2}
