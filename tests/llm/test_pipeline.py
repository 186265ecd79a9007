import random
from collections import Counter

from test_decontaminate import brute as contaminated
from test_neardup import brute as groups

import corpus_pipeline
from dockcast.llm import quality
from dockcast.llm.mixing import mix, text_size


def write(spark, folder, docs, labels, items):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def tables():
    rng = random.Random(6)
    vocab = ["".join(rng.choice(["the", "on", "er", "at", "re", "in", "ing"]) for _ in range(rng.choice([1, 2, 3]))) for _ in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(30))) for i in range(5)]
    rows, labels = [], []
    for i in range(160):
        w = [rng.choice(vocab) for _ in range(rng.choice([60, 90, 300]))]
        if i % 5 == 0:
            w = [x + rng.choice(["%%%", "###"]) for x in w]
        elif i % 5 == 1 and rows:
            base = rows[i - rng.choice([1, 2]) if i > 2 else 0][1]
            w = base.split() if base else w
            w[len(w) // 2] = "changed"
        elif i % 5 == 2:
            w[10:10] = items[i % 4][1].split()
        rows.append((i, " ".join(w), "abc"[i % 3]))
        if i % 3:
            labels.append((i, int("%%%" not in rows[i][1]), 0))
    rows += [(500, None, "a"), (501, "", None), (None, rows[3][1], "b"), (3, rows[3][1], "a"), (502, "short text", "c")]
    return rows, labels, items


def test_stages_equal_brute_force(spark, docs, tmp_path):
    rows, labels, items = tables()
    folder = str(tmp_path / "t")
    write(spark, folder, docs(rows), labels, items)
    now, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder)
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen.append([r for r in now.collect()])
        assert now.columns == columns or name == "sharding"
    good, once, clean, mixed, sharded = seen
    model = quality.fit(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scores = model.scores([(t or "").encode() for _, t, _ in rows])
    assert Counter((r.doc_id, r.text) for r in good) == Counter((i, t) for (i, t, _), s in zip(rows, scores) if s >= quality.REJECT_BELOW)
    assert not [r for r in good if "%%%" in (r.text or "")] and len(good) > 110
    group = {i: c for (i, _), c in groups([(r.doc_id, r.text) for r in good]).items()}
    assert sorted(r.doc_id for r in once if r.doc_id is not None) == sorted({c for i, c in group.items() if i is not None})
    assert [r for r in once if r.doc_id is None] and Counter(r.doc_id for r in once)[3] <= 1
    bad = {i for (i, *_, c) in contaminated([(r.doc_id, r.text) for r in once], items) if c}
    assert bad and Counter((r.doc_id, r.text) for r in clean) == Counter((r.doc_id, r.text) for r in once if r.doc_id not in bad)
    sized = spark.read.parquet(str(tmp_path / "decontamination"))
    copies = {r.doc_id: r.copies for r in mix(sized.withColumn("size", text_size(sized.text))).collect()}
    assert Counter(r.doc_id for r in mixed) == Counter({i: n for i, n in copies.items() if n})
    assert Counter((r.doc_id, r.text) for r in sharded) == Counter((r.doc_id, r.text) for r in mixed)
    assert sorted((r.slot, r.shard) for r in sharded) == [(i // 8, i % 8) for i in range(len(sharded))]
    assert Counter(map(tuple, corpus_pipeline.run(spark, folder).collect())) == Counter(map(tuple, sharded))


def test_empty_tables(spark, docs, tmp_path):
    write(spark, str(tmp_path / "e"), docs([]), [], [])
    out = corpus_pipeline.run(spark, str(tmp_path / "e"))
    assert out.count() == 0 and {"shard", "slot", "text"} <= set(out.columns)
