"""Merkle manifest of a data set (operator 12): superblocks, cogrouped with the outer nodes they need.

The leaves of a source are hashed row by row and numbered in order.  ``RUN``
consecutive nodes make one parent; a superblock is ``BLOCK`` = ``RUN ** DEEP``
consecutive nodes, a whole subtree of ``DEEP`` levels, so it can be reduced on
its own.  Going up, one ``applyInPandas`` per round reduces every superblock to
its top node, and the tops are the nodes of the next round; the subroots of the
sources go through the same rounds as one more tree.  Going down, each round
cogroups the nodes of a superblock with one row of outer nodes, the siblings
above it: the task finishes the local levels, joins the proof and, at the leaves,
folds it to a root.  No task holds more than one superblock, however large a
source is; the driver sees only the largest node count.

Numbering: rows are range-partitioned and sorted by (tree, key, digest, input row), numbered
inside each partition, and shifted by the counts of the partitions before.  The
digest and the input row break ties, so no key is too hot for the ranges; equal
rows are interchangeable.

Defined cases: null values hash as ``-``; a null source is a tree of its own and
comes first; null doc_ids come first in their source and are never tampered with;
rows with equal doc_id are ordered by leaf; a source of one row has its leaf as
subroot, and without siblings the proof is the hash of nothing; an empty table
gives an empty result; extra columns are neither read nor hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.llm.common import checked_join, materialise

RUN = 16
DEEP = 3
BLOCK = RUN ** DEEP
TAMPER = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(c: Column) -> Column:
    """A value as hash input: ``-`` if null, else its UTF-8 length, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def depth(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    d = 0
    while RUN ** d < n:
        d += 1
    return d


def _h(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def _levels(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock, level by level; the first list is the given one."""
    out = [digests]
    for _ in range(levels):
        now = out[-1]
        out.append([_h("".join(now[i:i + RUN])) for i in range(0, len(now), RUN)])
    return out


def _siblings(nodes: list[str]) -> tuple[list[str], list[str]]:
    """The concatenated siblings left and right of every node in its run."""
    left, right = [], []
    for i in range(0, len(nodes), RUN):
        run = nodes[i:i + RUN]
        left += ["".join(run[:j]) for j in range(len(run))]
        right += ["".join(run[j + 1:]) for j in range(len(run))]
    return left, right


def _paths(digests: list[str], levels: int) -> list[tuple[list[str], list[str]]]:
    """Left and right siblings of every node of a superblock, from its own level to the superblock's top."""
    sides = [_siblings(nodes) for nodes in _levels(digests, levels)[:-1]] if levels else []
    return [([s[0][i // RUN ** k] for k, s in enumerate(sides)], [s[1][i // RUN ** k] for k, s in enumerate(sides)])
            for i in range(len(digests))]


def _local(n: int, step: int) -> int:
    """Levels that round ``step`` adds in a tree of ``n`` leaves."""
    return max(0, min(DEEP, depth(int(n)) - DEEP * step))


def _number_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running number per tree over the sorted rows of one partition (columns tree, ...)."""
    last, seen = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        trees = b.column(0).to_numpy(zero_copy_only=False)
        start = np.flatnonzero(np.concatenate([[True], trees[1:] != trees[:-1]]))
        number = np.arange(len(trees)) - np.repeat(start, np.diff(np.append(start, len(trees))))
        if trees[0] == last:
            number[:start[1] if len(start) > 1 else None] += seen
        last, seen = trees[-1], int(number[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(number, pa.int64())], names=[*b.schema.names, "at"])


def place(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """``nodes`` (tree, digest, ...) with ``pos``, the place in its tree by ``order``, and ``n``, the tree's size.

    ``nodes`` should be a stored table: it is read once for the ranges and once to be sorted.
    """
    names = nodes.columns
    lead = ["tree", *[c for c in names if c != "tree"]]
    by = [F.col("tree"), *order, F.col("digest"), F.col("__row")]
    parted = (nodes.withColumn("__row", F.monotonically_increasing_id())
              .repartitionByRange(*by).sortWithinPartitions(*by).select(*lead, F.spark_partition_id().alias("part")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parted.schema.fields)
    numbered = materialise(parted.mapInArrow(_number_batches, f"{schema}, at long"))
    counts = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    # one row per tree and partition that holds some of it
    starts = materialise(counts.select("tree", "part", (F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
                                                        - F.col("rows")).alias("start"), F.sum("rows").over(tree).alias("n")))
    return (checked_join(numbered, starts, ["tree", "part"], "inner", measure=F.length("tree"))
            .withColumn("pos", F.col("start") + F.col("at")).drop("part", "at", "start"))


def _reduce(step: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("pos")
        n = int(g.n.iloc[0])
        top = _levels(g.digest.tolist(), _local(n, step))[-1]
        return pd.DataFrame({"tree": g.tree.iloc[:1], "pos": g.block.iloc[:1], "n": [n], "digest": top})
    return run


NODE = "tree string, pos long, n long, digest string"
OUTER = "tree string, block long, left array<string>, right array<string>, subroot string, root string"


def _block() -> Column:
    return F.expr(f"pos div {BLOCK}").alias("block")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of every round, from the given ones (tree, pos, n, digest) to one top node per tree."""
    rounds, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while BLOCK ** (len(rounds) - 1) < most:
        now = rounds[-1].select("tree", "pos", "n", "digest", _block())
        rounds.append(materialise(now.groupBy("tree", "block").applyInPandas(_reduce(len(rounds) - 1), NODE)))
    return rounds


def _descend(step: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Outer nodes of every member of a superblock: the local siblings, then the superblock's own outer nodes."""
    def run(g: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        g, o = g.sort_values("pos"), outer.iloc[0]
        paths = _paths(g.digest.tolist(), _local(g.n.iloc[0], step))
        above = list(o.left), list(o.right)
        return pd.DataFrame({"tree": g.tree.to_numpy(), "block": g.pos.to_numpy(), "left": [p[0] + above[0] for p in paths],
                             "right": [p[1] + above[1] for p in paths], "subroot": o.subroot, "root": o.root})
    return run


def outer_nodes(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """One row of outer nodes (tree, block, left, right, subroot, root) per superblock of the first round.

    ``top`` has the same columns, with block 0, for the single top node of every tree.
    """
    outer = top
    for step in range(len(rounds) - 2, 0, -1):
        now = rounds[step].select("tree", "pos", "n", "digest", _block())
        outer = materialise(now.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(_descend(step), OUTER))
    return outer


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(g: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The proof of every leaf of a superblock and the root it folds to."""
    g, o = g.sort_values("pos"), outer.iloc[0]
    above_left, above_right = list(o.left), list(o.right)
    above = "".join(a + b for a, b in zip(above_left, above_right))
    proofs, roots = [], []
    for (left, right), digest, changed in zip(_paths(g.digest.tolist(), _local(g.n.iloc[0], 0)), g.digest, g.changed):
        proofs.append(_h("".join(a + b for a, b in zip(left, right)) + above))
        now = digest if changed is None else changed
        for a, b in zip(left + above_left, right + above_right):
            now = _h(a + now + b)
        roots.append(now)
    return pd.DataFrame({"doc_id": g.doc_id.to_numpy(), "leaf": g.digest.to_numpy(), "subroot": o.subroot, "root": o.root,
                         "proof_sha256": proofs, "folded_root": roots, "verified": [r == o.root for r in roots]})


def manifest(leaves: DataFrame) -> DataFrame:
    """Proofs of the leaves (tree, doc_id, digest, changed), ordered by doc_id in each tree, trees by name.

    ``changed`` is the leaf to fold instead of ``digest``, null for the same.  ``leaves`` is a stored table.
    """
    placed = place(leaves, [F.col("doc_id").asc_nulls_first()])
    rounds = climb(placed)
    subroots = rounds[-1].select(F.lit("").alias("tree"), "digest", F.col("tree").alias("name"))
    trees = materialise(place(subroots, [F.col("name")]))
    tops = climb(trees)
    root = tops[-1].select(F.col("digest").alias("root"))
    named = trees.select("pos", F.col("name"), F.col("digest").alias("subroot"))
    nothing = F.lit([]).cast("array<string>")
    start = tops[-1].select("tree", F.lit(0).cast("long").alias("block"), nothing.alias("left"), nothing.alias("right"),
                            F.lit("").alias("subroot"), F.col("digest").alias("root"))
    # down through the tree of sources, its own nodes included: a row of outer nodes per source
    if len(tops) > 1:
        members = tops[0].select("tree", "pos", "n", "digest", _block())
        above = members.groupBy("tree", "block").cogroup(outer_nodes(tops, start).groupBy("tree", "block")).applyInPandas(_descend(0), OUTER)
    else:
        above = start
    sources = materialise(above.drop("tree", "subroot").join(named, F.col("block") == F.col("pos"))
                          .select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "left", "right", "subroot", "root"))
    outer = outer_nodes(rounds, sources)
    members = placed.select("tree", "pos", "n", "digest", "doc_id", "changed", _block())
    return members.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(_prove, PROOF)


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, changed): the leaf of every row, and that of its tampered text where it is tampered with."""
    columns = [F.col(c) for c in FIELDS]
    tampered = [*columns[:-1], F.translate("text", _UPPER, _LOWER)]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"), "doc_id",
                       leaf(*columns).alias("digest"), F.when(chosen, leaf(*tampered)).alias("changed"))


def merkle_query(docs: DataFrame) -> DataFrame:
    """Roots, proofs and folded roots of the documents by the contract of op12."""
    return manifest(materialise(document_leaves(docs)))


def _sql_field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


_SQL_LEAF = " || ".join(_sql_field(c) for c in FIELDS[:-1])
# The same tree level by level, with the siblings of every leaf joined on.
MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({_SQL_LEAF} || {_sql_field('text')}) AS leaf,
    sha256({_SQL_LEAF} || {_sql_field(f"translate(text, '{_UPPER}', '{_LOWER}')")}) AS lowered,
    4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(str_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc
  FROM documents
), leafs AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d
), lv AS (
  SELECT 0 AS level, tree, pos, leaf AS digest FROM leafs
  UNION ALL
  SELECT level + 1, tree, pos // {RUN}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM lv) WHERE c > 1 GROUP BY level, tree, pos // {RUN}
), subroots AS (
  SELECT tree, level AS deep, digest, row_number() OVER (ORDER BY tree) - 1 AS pos
  FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY level DESC) AS k FROM lv) WHERE k = 1
), up AS (
  SELECT 0 AS level, pos, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // {RUN}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS c FROM up) WHERE c > 1 GROUP BY level, pos // {RUN}
), top AS (
  SELECT level AS deep, digest AS root FROM up ORDER BY level DESC LIMIT 1
), path AS (
  SELECT l.id, v.level AS step, coalesce(string_agg(v.digest, '' ORDER BY v.pos) FILTER (v.pos < l.pos // (1 << (4 * v.level))), '') AS lft,
    coalesce(string_agg(v.digest, '' ORDER BY v.pos) FILTER (v.pos > l.pos // (1 << (4 * v.level))), '') AS rgt
  FROM leafs l JOIN subroots s ON s.tree = l.tree
  JOIN lv v ON v.tree = l.tree AND v.level < s.deep AND v.pos // {RUN} = l.pos // (1 << (4 * v.level)) // {RUN} GROUP BY l.id, v.level
  UNION ALL
  SELECT l.id, s.deep + v.level, coalesce(string_agg(v.digest, '' ORDER BY v.pos) FILTER (v.pos < s.pos // (1 << (4 * v.level))), ''),
    coalesce(string_agg(v.digest, '' ORDER BY v.pos) FILTER (v.pos > s.pos // (1 << (4 * v.level))), '')
  FROM leafs l JOIN subroots s ON s.tree = l.tree CROSS JOIN top
  JOIN up v ON v.level < top.deep AND v.pos // {RUN} = s.pos // (1 << (4 * v.level)) // {RUN} GROUP BY l.id, s.deep + v.level
), fold AS (
  SELECT id, 0 AS step, CASE WHEN doc_id IS NOT NULL AND crc % {TAMPER} = 0 THEN lowered ELSE leaf END AS now FROM leafs
  UNION ALL
  SELECT f.id, f.step + 1, sha256(p.lft || f.now || p.rgt) FROM fold f JOIN path p ON p.id = f.id AND p.step = f.step
), folded AS (
  SELECT id, arg_max(now, step) AS folded_root FROM fold GROUP BY id
), proofs AS (
  SELECT id, sha256(string_agg(lft || rgt, '' ORDER BY step)) AS proof FROM path GROUP BY id
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, top.root, coalesce(p.proof, sha256('')) AS proof_sha256, f.folded_root,
  f.folded_root = top.root AS verified
FROM leafs l JOIN subroots s ON s.tree = l.tree CROSS JOIN top JOIN folded f ON f.id = l.id LEFT JOIN proofs p ON p.id = l.id
"""
