import hashlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from dockcast.llm.chat import CHAT_SQL, PLANTED, chat_query, format_chats, read_back

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["\\", "\\\\", "\\l", "\\\\l<", "<turn user>", "</turn>\n", "a\\<b\\>c\\\\\\g", "", None, "é\U0001f600\n\n", PLANTED, "x" * 100_000]


def rows():
    out = [(i, t, r, f"{x} {t}") for i in range(20) for t, (r, x) in enumerate([("user", "hi"), ("assistant", "yo")] * (1 + i % 3))]
    out += [(100 + i, t, r, NASTY[i]) for i in range(len(NASTY)) for t, r in enumerate(["system", "user", "assistant"])]
    out += [(200, 0, "user", "a"), (200, 0, "user", "a"), (201, 0, "assistant", "first"), (202, 1, None, "who"), (None, 0, "user", "n"),
            (None, None, "assistant", "m"), (203, 0, "tool>\n<x", "odd role"), (204, 0, "user", "q"), (204, 1, "assistant", "r"), (204, 2, "user", "s")]
    return out


def test_round_trip_digests_and_sql(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = {r.conv_id: r for r in chat_query(df).collect()}
    turns = defaultdict(list)
    for c, t, r, x in [*rows(), (-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)]:
        turns[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(turns)
    for c, ts in turns.items():
        ts = sorted(ts)
        assert got[c].n_turns == len(ts)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in ts).encode()).hexdigest()
        loss = "".join(x for *_, r, x in ts if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[0].valid and got[-7].valid and got[100].valid
    assert (got[200].bad_turn, got[201].bad_turn, got[204].valid, got[204].bad_turn) == (1, 0, False, None)
    conversations = df.toArrow()  # noqa: F841
    assert Counter(duckdb.sql(CHAT_SQL).fetchall()) == Counter(map(tuple, got.values()))


def test_segments_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "a<b"), (1, 1, "assistant", "c\\d")], SCHEMA).selectExpr("*", "1 AS segments", "2 AS m")
    r = format_chats(df).withColumn("b", read_back(F.col("segments"))).first()
    assert [(s.text, s.loss) for s in r.segments] == [
        ("<turn user>", False), ("a\\lb", False), ("</turn>\n", False), ("<turn assistant>", False), ("c\\\\d", True), ("</turn>\n", False)]
    assert [tuple(t) for t in r.b.turns] == [("user", "a<b"), ("assistant", "c\\d")] and r.b.losses == ["c\\d"]
    assert format_chats(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.conv_id for r in chat_query(spark.createDataFrame([], SCHEMA)).collect()] == [-7]
