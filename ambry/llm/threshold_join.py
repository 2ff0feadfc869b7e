"""Hard-negative mining by threshold joins over pruned inverted indexes.

Anchors look for the rows of highest inner product: first their positives (rows of
their label), then for each positive the rows of other labels in a window under
its score.  Rows are dealt to shards by hash, and a shard keeps, for each block of
components, a list of the rows in descending order of the norm of what they have
from that block on.  For a threshold t and an anchor q the head of a list up to norm
t / |q| is its inverted index: components behind it are omitted, as all of them
together can't reach t.  Partial scores are accumulated block by block; a row is
dropped once its partial score and the norms of what remains can't reach t; the
omitted components of the few rows left come from the stored vectors.  Thresholds
start at what few rows reach and are lowered until every window is filled or its end is
reached.  A shard's first rows of a window contain those of the whole table that lie
in it, so results are exact.

Defined cases: rows with a null label, a null vector, or null or non-finite
components take no part; shorter vectors count as ended with zeros, empty ones score 0;
rows equal in id, label and vector count once; equal vectors of a label are one entry
with its smallest ids, so that copies are no load; a null id comes last and is no
anchor; anchors that share an id are mined each on its own; an empty table gives an empty result; other columns are ignored.  Scores are exact
while squared norms stay below 2**53; beyond that the job fails.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambry.llm.common import written
from ambry.llm.vectors import NULL_ID, copies, finite, matrix, visit

#: Rows whose id this divides are anchors.
ANCHOR_EVERY = 100
POSITIVES = NEGATIVES = 5
#: A negative's score is at least this share of its positive's.
LEAST, OF = 80, 100
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Components in a block of the index.
BLOCK = 8
#: Rows of a label whose scores give the first thresholds.
GUESS_ROWS = 128
#: Steps from a positive's score to its window's end.
STEPS = 5
#: Rows of a shard, at most about (0.9 KB each of 64 components).
SHARD_ROWS = 8192


class Lists:
    """The inverted index of some rows: for each block of components the rows by descending norm of
    what they have from that block on, with their components of the block."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.cuts = list(range(0, x.shape[1], BLOCK)) or [0]
        square = np.concatenate([(x[:, c:c + BLOCK] ** 2).sum(axis=1)[:, None] for c in self.cuts], axis=1)
        self.rest = np.sqrt(square[:, ::-1].cumsum(axis=1)[:, ::-1])
        self.order = [np.argsort(-self.rest[:, b], kind="stable") for b in range(len(self.cuts))]
        self.norms = [-self.rest[o, b] for b, o in enumerate(self.order)]
        self.parts = [np.ascontiguousarray(x[o, c:c + BLOCK]) for c, o in zip(self.cuts, self.order)]

    def reaching(self, q: np.ndarray, t: float, allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The rows whose score is ``t`` or more, and their scores."""
        left = np.sqrt(np.array([(q[c:] ** 2).sum() for c in self.cuts]))
        if t <= 0 or not left[0]:  # norms can't prune
            rows = np.arange(len(self.x)) if allowed is None else np.flatnonzero(allowed)
        else:
            t_low = t - 1e-6 * abs(t) - 1e-6  # norms are rounded
            score = np.zeros(len(self.x))
            alive = np.ones(len(self.x), bool) if allowed is None else allowed.copy()
            rows = None
            for b, c in enumerate(self.cuts):
                upto = int(np.searchsorted(self.norms[b], -t_low / left[0], "right"))
                head = self.order[b][:upto]
                if b == 0:  # whoever isn't even here can't reach t
                    touched = np.zeros(len(self.x), bool)
                    touched[head] = True
                    alive &= touched
                on = alive[head]
                rows = head[on]
                if not len(rows):
                    break
                score[rows] += self.parts[b][:upto][on] @ q[c:c + BLOCK]
                if b + 1 < len(self.cuts):
                    alive[rows] = score[rows] + left[b + 1] * self.rest[rows, b + 1] >= t_low
            rows = np.flatnonzero(alive)
        found = self.x[rows] @ q
        good = found >= t
        return rows[good], found[good]


class Shard:
    """The rows of a shard, by label and together; ``ids`` are each row's smallest."""

    def __init__(self, t: pa.Table, width: int):
        x = matrix(t.column("vec"), width)
        if len(x) and (x ** 2).sum(axis=1).max() >= 2.0 ** 53:
            raise ValueError("vectors too long for exact scores: squared norms must stay below 2**53")
        self.dims = np.argsort(-(x ** 2).sum(axis=0), kind="stable")  # heavy components first
        self.x, self.label = x[:, self.dims], t.column("label").to_numpy()
        ids = t.column("ids").combine_chunks()
        self.ids = ids.flatten().to_numpy()
        self.ends = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy())))
        self.all: Lists | None = None
        self.of: dict[int, tuple[np.ndarray, Lists]] = {}

    def expand(self, rows: np.ndarray, scores: np.ndarray, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the rows' copies, highest score first, ties by id."""
        n = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        ids, scores = self.ids[at], np.repeat(scores, n)
        if without is not None:
            ids, scores = ids[ids != without], scores[ids != without]
        order = np.lexsort((ids, -scores))
        return ids[order], scores[order]

    def positives(self, anchor: int, label: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if label not in self.of:
            rows = np.flatnonzero(self.label == label)
            self.of[label] = rows, Lists(self.x[rows])
        rows, lists = self.of[label]
        if not len(rows):
            return np.zeros(0, np.int64), np.zeros(0)
        some = lists.x[::max(1, len(rows) // GUESS_ROWS)] @ q
        ladder = [*np.sort(some)[::-1][:POSITIVES + 1], -np.inf]
        for t in ladder[1:]:  # the first is likely the anchor's own
            hit, score = lists.reaching(q, float(t))
            ids, score = self.expand(rows[hit], score, anchor)
            if len(ids) >= POSITIVES or t == -np.inf:
                break
        return ids[:POSITIVES], score[:POSITIVES]

    def negatives(self, label: int, q: np.ndarray, above: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each of the positives' scores the first rows of other labels in its window."""
        ends = {p: -(-LEAST * p // OF) for p in above if p >= 0}
        if not ends:
            return []
        self.all = self.all or Lists(self.x)
        other = self.label != label
        lowest, last = min(ends), min(ends.values())
        for step in range(1, STEPS + 1):
            t = max(last, lowest - (lowest - last) * step / STEPS)
            hit, score = self.all.reaching(q, t, other)
            ids, score = self.expand(hit, score)
            out = []
            for p, end in ends.items():
                inside = (score <= p) & (score >= end)
                out.append((p, ids[inside][:NEGATIVES], score[inside][:NEGATIVES]))
            if t <= last or all(len(i) >= NEGATIVES or t <= ends[p] for p, i, _ in out):
                break
        return out


def _positives(width: int) -> Callable[[pa.Table], Callable[[pa.Table], pa.RecordBatch]]:
    def make(t: pa.Table) -> Callable[[pa.Table], pa.RecordBatch]:
        shard = Shard(t, width)

        def answer(q: pa.Table) -> pa.RecordBatch:
            x = matrix(q.column("vec"), width)[:, shard.dims]
            a, ids, scores = [], [], []
            for key, anchor, label, v in zip(q.column("a").to_numpy(), q.column("anchor_id").to_numpy(), q.column("label").to_numpy(), x):
                found, score = shard.positives(anchor, label, v)
                a.append(np.full(len(found), key))
                ids.append(found)
                scores.append(score)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in (a, ids, scores)], ["a", "positive_id", "positive_score"])
        return answer
    return make


def _negatives(width: int) -> Callable[[pa.Table], Callable[[pa.Table], pa.RecordBatch]]:
    def make(t: pa.Table) -> Callable[[pa.Table], pa.RecordBatch]:
        shard = Shard(t, width)

        def answer(q: pa.Table) -> pa.RecordBatch:
            x = matrix(q.column("vec"), width)[:, shard.dims]
            out: list[list[np.ndarray]] = [[np.zeros(0)], [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0)]]
            for key, label, above, v in zip(q.column("a").to_numpy(), q.column("label").to_numpy(), q.column("above").to_pylist(), x):
                for p, found, score in shard.negatives(label, v, above):
                    for column, values in zip(out, (np.full(len(found), key), np.full(len(found), p), found, score)):
                        column.append(values)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out],
                                              ["a", "positive_score", "negative_id", "negative_score"])
        return answer
    return make


def hard_negatives(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """``rows`` and ``anchors`` hold vec_id, label, vec (integers); one row per anchor, positive and negative."""
    def own(df: DataFrame) -> DataFrame:
        return df.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("id"),
                         F.col("label").cast("long").alias("label"), F.col("vec").cast("array<long>").alias("vec"))

    entries = written(copies(own(rows), "id", ["label", "vec"], POSITIVES + 1), "join-entries")
    n, width = entries.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    shards = int(n) // SHARD_ROWS + 1
    index = entries.withColumn("shard", F.pmod(F.xxhash64("label", "vec"), F.lit(shards)).cast("int"))
    # numbered once: whatever reads the written rows sees the same numbers
    asked = written(own(anchors.where(F.col("vec_id").isNotNull())).distinct().withColumnRenamed("id", "anchor_id")
                    .withColumn("a", F.monotonically_increasing_id()), "join-anchors")
    n_asked = asked.count()

    first = Window.partitionBy("a").orderBy(F.desc("positive_score"), "positive_id")
    pairs = visit(index, asked, shards, n_asked, ["label", "vec"], _positives(int(width)), "a long, positive_id long, positive_score long")
    positives = written(pairs.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= POSITIVES).drop("_rank"), "join-positives")

    windows = positives.groupBy("a").agg(F.collect_set("positive_score").alias("above"))  # POSITIVES at most
    below = visit(index, asked.join(windows, "a").select("a", "label", "vec", "above"), shards, n_asked, ["label", "vec"],
                  _negatives(int(width)), "a long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("a", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    below = below.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= NEGATIVES)

    def name(c: str) -> F.Column:
        return F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)

    return (positives.join(below, ["a", "positive_score"]).join(asked.select("a", "anchor_id"), "a")
            .select("anchor_id", name("positive_id"), "rank", name("negative_id"), "positive_score", "negative_score"))


def hard_negative_report(embeddings: DataFrame) -> DataFrame:
    """The contract's rows."""
    rows = (embeddings.select("vec_id", "label", F.col("embedding").alias("vec")).where(F.col("label").isNotNull() & finite("vec"))
            .withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
            .withColumn("vec", F.transform("vec", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long"))))
    return hard_negatives(rows, rows.where(F.col("vec_id") % ANCHOR_EVERY == 0))


#: The same rows in DuckDB's SQL, every anchor against every row.
SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e AS a, e AS b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""
