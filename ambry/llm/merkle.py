"""Merkle manifest of a dataset, with a witness (proof of membership) for every row.

Rows are leaves of a tree per group; the groups' roots are leaves of a top tree.  At
each level every two consecutive nodes become the hash of both, a last single one the
hash of itself, until one is left.  A leaf's witness is its siblings, level by level.

Leaves are numbered within their group and appended in order, in aligned blocks of
``BLOCK_ROWS``.  A task appends one block at a time: a stack holds the open subtrees;
each leaf starts with an empty witness, and whenever a subtree is completed by its
sibling the witnesses in both are extended by the other's hash.  A block's root then is
one more append, to the tree of its group's blocks; these trees are built in blocks in
turn, and at last the groups' roots are appended to the top tree.  What a block's root
gets as its witness extends the witnesses of all its leaves.  No task holds more than a
block and no level but the leaves is larger than rows / ``BLOCK_ROWS``.

``append`` adds later rows to a manifest: closed blocks stay as they are, only the last
block of a group that grows is appended to again.

Whether a witness has a sibling at some level, and on which side, follows from the
leaf's place and the tree's number of leaves, so a witness is only the siblings' bytes.

Defined cases: a null group comes first; a null id comes first in its group; equal ids
are ordered by leaf, and equal leaves are leaves of their own; a null value is ``-`` in a
leaf; an empty table has an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambry.llm.common import written

#: Levels of a block, and its leaves.
BLOCK_LEVELS = 10
BLOCK_ROWS = 1 << BLOCK_LEVELS
#: Columns of a leaf, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: A row is tampered with where this divides the checksum of its id.
TAMPER_EVERY = 7

_LOW = 33  # monotonically_increasing_id keeps the place in a partition in the low 33 bits


def field(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    """The hash of a row's values."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def group_key(c: Column) -> Column:
    """A group as a string that is never null and keeps the order (null first, then bytewise)."""
    return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string")))


def h(*nodes: bytes) -> bytes:
    """The hash of nodes, which go in as hex text."""
    return hashlib.sha256(b"".join(n.hex().encode() for n in nodes)).digest()


def append(leaves: list[bytes], levels: int | None) -> tuple[bytes, list[list[bytes]]]:
    """Append ``leaves`` one by one to an empty tree: its root and each leaf's witness.  With
    ``levels`` the tree is part of a larger one, and its root is of that level."""
    witnesses: list[list[bytes]] = [[] for _ in leaves]
    stack: list[tuple[int, bytes, int, int]] = []  # open subtrees: level, hash, first leaf, end

    def push(level: int, node: bytes, first: int, end: int) -> None:
        while stack and stack[-1][0] == level:  # this completes the subtree to its left
            _, left, start, middle = stack.pop()
            for w in witnesses[start:middle]:
                w.append(node)
            for w in witnesses[middle:end]:
                w.append(left)
            level, node, first = level + 1, h(left, node), start
        stack.append((level, node, first, end))

    for i, x in enumerate(leaves):
        push(0, x, i, i + 1)
    while len(stack) > 1 or levels is not None and stack[-1][0] < levels:
        level, node, first, end = stack.pop()  # a single last node is hashed alone
        push(level + 1, h(node), first, end)
    return stack[0][1], witnesses


def fold(node: bytes, witness: bytes, place: int, size: int) -> tuple[bytes, int]:
    """The root that ``node``, at ``place`` of ``size`` leaves, and its witness lead to; the bytes used."""
    at = 0
    while size > 1:
        if place ^ 1 >= size:
            node = h(node)
        else:
            other = witness[at:at + 32]
            at += 32
            node = h(other, node) if place & 1 else h(node, other)
        place, size = place >> 1, size + 1 >> 1
    return node, at


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, their place within their group, and ``n``, the group's size.

    Rows are dealt out by ranges (equal ones, too, so that a hot key is no load), written with
    their place in their part, and the parts' counts are summed along each group.
    """
    tie = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [group, *order, "_tie"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(tie.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie")
                     .withColumn("_mid", F.monotonically_increasing_id())
                     .withColumn("_part", F.shiftright("_mid", _LOW)), f"{name}-placed")
    counts = placed.groupBy(group, "_part").agg(F.min("_mid").alias("_first"), F.count("*").alias("_count"))
    along = Window.partitionBy(group)
    starts = counts.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first", F.sum("_count").over(along).alias("n"),
        F.coalesce(F.sum("_count").over(along.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    starts = written(starts, f"{name}-starts")  # a row per part and group: its size shows whether to broadcast it
    return (placed.join(starts, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn("pos", F.col("_mid") - F.col("_first") + F.col("_start"))
            .drop("_mid", "_part", "_g", "_p", "_first", "_start"))


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """``nodes`` (g, pos, n, node and others) with ``witness`` within their block, and ``root``, the block's."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                t = pa.Table.from_batches(held).combine_chunks()
                root, witnesses = append(t.column("node").to_pylist(), BLOCK_LEVELS if t.column("n")[0].as_py() > BLOCK_ROWS else None)
                t = t.append_column("witness", pa.array([b"".join(w) for w in witnesses], pa.binary()))
                yield from t.append_column("root", pa.array([root] * len(t), pa.binary())).to_batches()
            held.clear()

        for b in batches:
            keys = list(zip(b.column("g").to_pylist(), b.column("block").to_pylist()))
            start = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start]:
                    if keys[start] != at:
                        yield from flush()
                        at = keys[start]
                    held.append(b.slice(start, i - start))
                    start = i
        yield from flush()

    dealt = (nodes.withColumn("block", F.shiftright("pos", BLOCK_LEVELS))
             .repartition("g", "block").sortWithinPartitions("g", "block", "pos"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return written(dealt.mapInArrow(work, f"{fields}, witness binary, root binary"), f"{name}-blocks")


def _tree(blocks: DataFrame, name: str) -> DataFrame:
    """For each block (g, block): ``above``, its root's witness in the group's tree, that tree's
    root ``subroot`` and number of leaves ``n``; further trees of blocks are built as long as any group has several."""
    roots = blocks.where(F.expr(f"pos & {BLOCK_ROWS - 1} = 0")).select(
        "g", F.col("block").alias("pos"), F.shiftright(F.col("n") + (BLOCK_ROWS - 1), BLOCK_LEVELS).alias("n"), F.col("root").alias("node"))
    if (roots.agg(F.max("n")).first()[0] or 1) == 1:
        return roots.select("g", F.col("pos").alias("block"), F.lit(b"").alias("above"), F.col("node").alias("subroot"))
    upper = _blocks(roots, name)
    above = _tree(upper, name)
    return (upper.select("g", "pos", "block", "witness").join(above, ["g", "block"])
            .select("g", F.col("pos").alias("block"), F.concat("witness", "above").alias("above"), "subroot"))


@dataclass
class Manifest:
    """``leaves``: g, pos, n, node, witness (within the block), block, root (the block's), and what
    was carried along; ``blocks``: g, block, above (the witness from the block to the group's root and on to the
    root), subroot, root, group_pos and groups (the group's place in the top tree, and its number of leaves)."""
    leaves: DataFrame
    blocks: DataFrame

    def witnessed(self) -> DataFrame:
        """Leaves with their whole witness and what it leads to."""
        own = [c for c in self.leaves.columns if c not in ("witness", "root", "block")]
        return (self.leaves.drop("root").join(self.blocks, ["g", "block"])
                .select(*own, F.concat("witness", "above").alias("witness"), "subroot", "root", "group_pos", "groups"))

    def append(self, rows: DataFrame, order: list[str]) -> "Manifest":
        """A manifest with ``rows`` (g, node and what is carried along) behind the leaves of their groups.

        Only the rows of each group's open last block are appended again; closed blocks keep their witnesses.
        """
        new = numbered(rows, "g", order, "manifest-more").withColumnRenamed("n", "_more")
        sizes = self.leaves.where("pos = 0").select(F.col("g"), F.col("n").alias("_had"))
        more = written(new.groupBy("g").agg(F.max("_more").alias("_more")), "manifest-sizes")
        had = self.leaves.join(more, "g", "left").withColumn("_had", F.col("n"))
        had = had.withColumn("n", F.col("n") + F.coalesce("_more", F.lit(0)))
        # an open block of a group that grows; the others stay as they are
        grows = F.col("_more").isNotNull() & ((F.col("block") + 1) * BLOCK_ROWS > F.col("_had"))
        closed = had.where(~grows).drop("_more", "_had")
        own = [c for c in self.leaves.columns if c not in ("witness", "root", "block")]
        new = (new.join(sizes, "g", "left").withColumn("_had", F.coalesce("_had", F.lit(0)))
               .withColumn("pos", F.col("pos") + F.col("_had")).withColumn("n", F.col("_more") + F.col("_had")))
        opened = _blocks(had.where(grows).select(*own).unionByName(new.select(*own)), "manifest")
        return _manifest(closed.unionByName(opened))


def _manifest(leaves: DataFrame) -> Manifest:
    """All the trees above leaves in blocks."""
    blocks = written(_tree(leaves, "manifest"), "manifest-above")
    groups = numbered(blocks.where("block = 0").select(F.lit("").alias("g"), F.col("g").alias("_group"), F.col("subroot").alias("node")),
                      "g", ["_group"], "manifest-groups")
    top = _blocks(groups, "manifest-top")
    rest = _tree(top, "manifest-top").select(F.col("g"), F.col("block"), F.col("above").alias("_rest"), F.col("subroot").alias("_root"))
    # written, so that its size shows whether to broadcast it: a group may have most of the blocks
    top = written(top.join(rest, ["g", "block"]).select(
        F.col("_group").alias("g"), F.concat("witness", "_rest").alias("_top"), F.col("_root").alias("root"),
        F.col("pos").alias("group_pos"), F.col("n").alias("groups")), "manifest-tops")
    whole = blocks.join(top, "g").select("g", "block", F.concat("above", "_top").alias("above"), "subroot", "root", "group_pos", "groups")
    return Manifest(leaves, written(whole, "manifest-witnesses"))


def manifest(rows: DataFrame, order: list[str]) -> Manifest:
    """The manifest of ``rows``: g (a group key), node (a leaf's hash) and other columns, which are
    carried along; ``order`` names those by which leaves ascend."""
    return _manifest(_blocks(numbered(rows, "g", order, "manifest"), "manifest"))


def proven(witnessed: DataFrame, node: str) -> DataFrame:
    """``witnessed`` with proof_sha256 (the hash of a witness) and folded_root (where ``node`` and the witness lead to)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            proofs, roots = [], []
            for x, w, pos, n, gpos, groups in zip(*[b.column(c).to_pylist() for c in (node, "witness", "pos", "n", "group_pos", "groups")]):
                proofs.append(hashlib.sha256(w.hex().encode()).hexdigest())
                subroot, used = fold(x, w, pos, n)
                roots.append(fold(subroot, w[used:], gpos, groups)[0].hex())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(proofs, pa.string()), pa.array(roots, pa.string())],
                                             [*b.schema.names, "proof_sha256", "folded_root"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in witnessed.schema)
    return witnessed.mapInArrow(work, f"{fields}, proof_sha256 string, folded_root string")


def document_leaves(docs: DataFrame) -> DataFrame:
    """Each document's group, leaf, and the leaf of its tampered row."""
    cols = {c: F.col(c) for c in LEAF_COLUMNS}
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0, F.lit(False))
    more = {**cols, "n_chars": F.col("n_chars").cast("decimal(20,0)") + F.when(hit, 1).otherwise(0)}
    return docs.select("doc_id", group_key(F.col("lang")).alias("g"), leaf(*cols.values()).alias("node"),
                       leaf(*more.values()).alias("tampered"))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``."""
    leaves = written(document_leaves(docs), "manifest-leaves")  # the texts are read once
    found = proven(manifest(leaves, ["doc_id", "node"]).witnessed(), "tampered")
    return found.select("doc_id", *[F.lower(F.hex(c)).alias(name) for c, name in (("node", "leaf"), ("subroot", "subroot"), ("root", "root"))],
                        "proof_sha256", "folded_root", (F.col("folded_root") == F.lower(F.hex("root"))).alias("verified"))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"

#: The same rows in DuckDB's SQL, level by level.
SQL = f"""
WITH RECURSIVE
d AS (SELECT *, row_number() OVER () AS r,
        -- crc32: each byte is followed by eight shifts
        xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
              lambda b: [ord(b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS crc
      FROM documents),
l AS (SELECT r, doc_id, lang, {" || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang"))} AS head,
        {_FIELD.format("n_chars")} AS n, {_FIELD.format("(n_chars::HUGEINT + 1)")} AS n1, {_FIELD.format("text")} AS body,
        coalesce(crc % {TAMPER_EVERY} = 0, false) AS hit FROM d),
x AS (SELECT r, doc_id, lang, sha256(head || n || body) AS leaf, sha256(head || CASE WHEN hit THEN n1 ELSE n END || body) AS tampered,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(head || n || body)) - 1 AS i FROM l),
t AS (  -- the nodes of each language's tree: level, place, hash, nodes of the level
  SELECT 0 AS level, lang, i, leaf AS h, count(*) OVER (PARTITION BY lang) AS m FROM x
  UNION ALL
  SELECT level + 1, lang, i // 2, sha256(h || coalesce(next_, '')), (m + 1) // 2
  FROM (SELECT *, lead(h) OVER (PARTITION BY lang ORDER BY i) AS next_ FROM t WHERE m > 1) WHERE i % 2 = 0),
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t WHERE m = 1),
u AS (
  SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS m FROM s
  UNION ALL
  SELECT level + 1, i // 2, sha256(h || coalesce(next_, '')), (m + 1) // 2
  FROM (SELECT *, lead(h) OVER (ORDER BY i) AS next_ FROM u WHERE m > 1) WHERE i % 2 = 0),
steps AS (  -- one step a level, the top tree's after the others; without a sibling a node is hashed alone
  SELECT x.r, a.level, CASE WHEN b.h IS NULL THEN '-' WHEN b.i < a.i THEN 'L' || b.h ELSE 'R' || b.h END AS step
  FROM x JOIN t AS a ON a.lang IS NOT DISTINCT FROM x.lang AND a.i = x.i >> a.level AND a.m > 1
  LEFT JOIN t AS b ON b.lang IS NOT DISTINCT FROM a.lang AND b.level = a.level AND b.i = xor(a.i, 1)
  UNION ALL
  SELECT x.r, 100 + a.level, CASE WHEN b.h IS NULL THEN '-' WHEN b.i < a.i THEN 'L' || b.h ELSE 'R' || b.h END
  FROM x JOIN s ON s.lang IS NOT DISTINCT FROM x.lang JOIN u AS a ON a.i = s.i >> a.level AND a.m > 1
  LEFT JOIN u AS b ON b.level = a.level AND b.i = xor(a.i, 1)),
w AS (SELECT r, list(step ORDER BY level) AS steps FROM steps GROUP BY r),
f AS (SELECT x.*, s.subroot, (SELECT h FROM u WHERE m = 1) AS root, coalesce(w.steps, []::VARCHAR[]) AS steps
      FROM x JOIN s ON s.lang IS NOT DISTINCT FROM x.lang LEFT JOIN w USING (r)),
g AS (SELECT *, list_reduce(list_concat([tampered], steps),
        lambda a, e: sha256(CASE e[1] WHEN 'L' THEN e[2:] || a WHEN 'R' THEN a || e[2:] ELSE a END)) AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate(list_transform(list_filter(steps, lambda e: e <> '-'), lambda e: e[2:]), 'string_agg', ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM g
"""
