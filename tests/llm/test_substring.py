import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from dockcast.llm import substring as sub

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    texts = [WORDS.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + 35]) for w in texts for i in range(len(w) - 34))
    out = Counter()
    for (i, _), w in zip(rows, texts):
        gone = set()
        for j in range(len(w) - 34):
            if seen[tuple(w[j:j + 35])] > 1:
                gone |= set(range(j, j + 35))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


def table():
    rng = random.Random(5)
    vocab = [f"W{i}" for i in range(200)] + ["É\x85x", "the"]
    def text(n):
        return [rng.choice(vocab) for _ in range(n)]
    passages = [text(n) for n in (34, 35, 36, 60, 120, 35, 500)]
    rows = []
    for i in range(200):
        t = text(rng.choice([0, 3, 34, 80, 200]))
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages)
            a = rng.randrange(len(p)) if rng.random() < 0.4 else 0
            t += p[a:] + text(rng.choice([0, 1, 20]))
        rows.append((i, "  ".join(t)))
    rows += [(300, None), (301, ""), (302, "same " * 300), (303, "a b " * 20), (304, "a b " * 17 + "a"), (305, " ".join(text(40_000))),
             (306, " ".join(passages[4] + passages[4])), (None, " ".join(passages[3])), (0, rows[0][1]), (307, rows[5][1]), (308, rows[7][1].replace("  ", "\n"))]
    return rows


@pytest.mark.parametrize("parts", [1, 6])
def test_query_equals_brute_force(docs, parts):
    rows = table()
    got = Counter(map(tuple, sub.substring_query(docs(rows, parts=parts)).collect()))
    assert got == brute(rows)


def test_kept_text_empty_table_and_extra_columns(docs):
    p = " ".join(f"p{i}" for i in range(40))
    df = docs([(1, f"a {p} b"), (2, f"{p} c"), (3, "d")]).selectExpr("*", "1 AS doc", "2 AS copies", "3 AS kept")
    assert sorted((r.doc_id, r.n_removed, r.kept) for r in sub.clean(df).collect()) == [(1, 40, "a b"), (2, 40, "c"), (3, 0, "d")]
    assert sub.substring_query(docs([])).collect() == []


def test_anchors_are_rightmost_minima():
    rng = np.random.default_rng(1)
    for n in (0, 5, 19, 20, 21, 400):
        g = rng.integers(0, 6, n).astype(np.uint64)
        want = sorted({max(j for j in range(i, i + 20) if g[j] == g[i:i + 20].min()) for i in range(n - 19)})
        assert sub.anchors(g, 20).tolist() == want
