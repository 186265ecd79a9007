"""The SQL of operators 1, 5 and 9 on rows with nulls, repeats, short and very long texts."""

from collections import Counter

import pytest

from dockcast.llm import oracles
from dockcast.llm.decontaminate import decontaminate_query
from dockcast.llm.neardup import neardup_query
from dockcast.llm.substring import substring_query

PASSAGE = " ".join(f"w{i}" for i in range(60))


def rows():
    texts = [None, "", " \n", "a b c", "A b\tC", PASSAGE, PASSAGE + " more words here", "x " + PASSAGE.upper(), "é " * 40 + PASSAGE, "one two",
             "loop " * 200, "w1 w2 w3, w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 tail " + " ".join(f"v{i}" for i in range(3000))]
    return [(i, t) for i, t in enumerate(texts)] + [(None, PASSAGE), (5, PASSAGE), (5, PASSAGE)]


def same(query, sql, sql_rows, **frames):
    got = query.select(sorted(query.columns))
    assert Counter(map(tuple, got.collect())) == Counter(sql_rows(sql, **frames))


def test_contamination(spark, docs, sql_rows):
    items = [(1, PASSAGE), (2, "one two"), (10, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (3, ""), (4, None), (5, "not there")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = docs(rows())
    same(decontaminate_query(d, bench), oracles.CONTAMINATION, sql_rows, documents=d, benchmark=bench)


@pytest.mark.parametrize("query,sql", [(neardup_query, oracles.NEAR_DUPLICATES), (substring_query, oracles.REPEATED_WINDOWS)])
def test_duplicates(docs, sql_rows, query, sql):
    d = docs([r for r in rows() if r[0] is not None] if query is neardup_query else rows())
    same(query(d), sql, sql_rows, documents=d)
