"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt to shards by hash.  Each shard's nodes are ordered by
level, highest first (a node reaches level l with chance 1 / M**l), so that a
level's members are the first so many nodes, and its graph is one flat array of
neighbour numbers.  Levels are built from the top: nodes enter in batches, find
their neighbours by a beam search that starts where the level above led them,
keep the nearest that are not closer to one already kept, and are linked back;
lists that overflow are chosen anew by the same rule.  A query descends all
levels of every shard, and the shards' results are merged by exact distances.

The number of shards grows with the square root of the rows, so that both the
graphs and the shards that a query visits stay far below the input;
``MAX_SHARD_ROWS`` bounds a task's memory (about 0.5 KB a node of 64 components).

Defined cases: vectors that are null, zero, empty or hold null or non-finite
components take no part; shorter vectors count as ended with zeros; rows equal
in id and vector count once; equal vectors are one node with its smallest ids,
so that copies neither crowd the graph nor get lost; a null id comes last and is
no query; queries that share an id are answered each on its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambry.llm.common import written
from ambry.llm.vectors import NULL_ID, copies, finite, lists_of, matrix, visit

#: Neighbours that a node chooses and keeps at the upper levels; twice as many at level 0.
M = 16
#: Candidates held while a graph is built, and while it is searched.
BUILD_EF, SEARCH_EF = 64, 96
#: Nodes that enter a graph at once.
BATCH = 512
#: Candidates of which a batch's steps take the nearest unexpanded ones.
BEAM = 4
#: Shards number the square root of rows / SHARD_SCALE, but hold at most so many rows.
SHARD_SCALE, MAX_SHARD_ROWS = 1024, 262_144
#: Rows whose id this divides are the queries.
QUERY_EVERY = 100
NEIGHBOURS = 10

_INF = np.float32(np.inf)


class Graph:
    """The levels of one shard: ``links[l]`` has a row of neighbours (-1: none) for each member."""

    def __init__(self, x: np.ndarray, sizes: list[int], links: list[np.ndarray] | None = None):
        self.exact, self.sizes = x, sizes
        self.x = x.astype(np.float32)
        self.norm = np.einsum("nd,nd->n", self.x, self.x)
        self.links = links or [np.full((s, 2 * M if level == 0 else M), -1, np.int32) for level, s in enumerate(sizes)]
        if links is None:
            for level in range(len(sizes) - 1, -1, -1):
                self._build(level)

    def _far(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances, less the query's own norm, of each row's nodes to its query."""
        return self.norm[nodes] - 2 * np.matmul(self.x[nodes], q[:, :, None])[:, :, 0]

    def _beam(self, q: np.ndarray, level: int, entry: np.ndarray, ef: int, inserted: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``ef`` members found from ``entry`` (a row of nodes for each query), nearest first."""
        links, n = self.links[level], len(q)
        seen = np.zeros((n, inserted), bool)
        rows = np.arange(n)
        ids = np.full((n, ef), -1, np.int32)
        far = np.full((n, ef), _INF)
        entry = np.sort(entry[:, :ef], axis=1)
        again = np.zeros(entry.shape, bool)
        again[:, 1:] = entry[:, 1:] == entry[:, :-1]
        ids[:, :entry.shape[1]] = entry
        far[:, :entry.shape[1]] = np.where(again, _INF, self._far(q, entry))
        seen[rows[:, None], entry] = True
        fresh = np.isfinite(far)
        live = rows
        while len(live):
            open_ = np.where(fresh[live], far[live], _INF)
            at = np.argpartition(open_, min(BEAM, ef - 1), axis=1)[:, :BEAM] if ef > BEAM else np.argsort(open_, axis=1)[:, :1]
            good = np.isfinite(np.take_along_axis(open_, at, 1))
            some = good.any(axis=1)
            live, at, good = live[some], at[some], good[some]
            if not len(live):
                break
            fresh[live[:, None], at] = False
            near = links[ids[live[:, None], at]]
            near = np.where(good[:, :, None], near, -1).reshape(len(live), -1)
            near.sort(axis=1)
            new = near >= 0
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            new &= ~seen[live[:, None], near]
            wide = int(new.sum(axis=1).max(initial=0))
            if not wide:
                continue
            # new nodes to the left, so that only they are measured
            order = np.argsort(~new, axis=1, kind="stable")[:, :wide]
            near, new = np.take_along_axis(near, order, 1), np.take_along_axis(new, order, 1)
            seen[np.broadcast_to(live[:, None], near.shape)[new], near[new]] = True
            d = np.where(new, self._far(q[live], np.where(new, near, 0)), _INF)
            all_d = np.concatenate([far[live], d], axis=1)
            best = np.argpartition(all_d, ef - 1, axis=1)[:, :ef]
            far[live] = np.take_along_axis(all_d, best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), best, 1)
            fresh[live] = np.take_along_axis(np.concatenate([fresh[live], new], axis=1), best, 1)
        order = np.argsort(far, axis=1, kind="stable")
        far = np.take_along_axis(far, order, 1)
        return np.where(np.isfinite(far), np.take_along_axis(ids, order, 1), -1), far

    def _entry(self, q: np.ndarray, level: int, inserted: int | None = None) -> np.ndarray:
        """Where a search of ``level`` starts: the nearest found at the level above."""
        top = len(self.sizes) - 1
        inserted = inserted or self.sizes[level]
        first = np.zeros((len(q), 1), np.int32)
        entry = first
        for above in range(top, level, -1):
            found = self._beam(q, above, entry, 8, self.sizes[above])[0]
            entry = np.where(found >= 0, found, found[:, :1])
        return np.where(entry < inserted, entry, first)

    def _choose(self, far: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates (nearest first, -1: none) those not closer to a chosen one than
        to the row's own node; places left over go to the nearest of the others."""
        there = nodes >= 0
        x = self.x[np.where(there, nodes, 0)]
        norm = self.norm[np.where(there, nodes, 0)]
        apart = norm[:, :, None] + norm[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        chosen = np.zeros(nodes.shape, bool)
        count = np.zeros(len(nodes), np.int64)
        for c in range(nodes.shape[1]):
            close = ((apart[:, c, :c] < far[:, c:c + 1]) & chosen[:, :c]).any(axis=1)
            chosen[:, c] = there[:, c] & ~close & (count < most)
            count += chosen[:, c]
        order = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :most]
        out = np.take_along_axis(np.where(there, nodes, -1), order, 1)
        return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1) if out.shape[1] < most else out

    def _build(self, level: int) -> None:
        links, size = self.links[level], self.sizes[level]
        most = links.shape[1]
        at = 0
        while at < size:
            new = np.arange(at, min(size, at + max(64, min(BATCH, at))))
            q = self.x[new]
            own = self.norm[new][:, None]
            inside = self.norm[new][None, :] + own - 2 * q @ q.T  # batch members see each other
            np.fill_diagonal(inside, _INF)
            near, far = np.broadcast_to(new, inside.shape), inside
            if at:
                found, d = self._beam(q, level, self._entry(q, level, at), BUILD_EF, at)
                near, far = np.concatenate([found, near], axis=1), np.concatenate([d + own, far], axis=1)
            order = np.argsort(far, axis=1, kind="stable")[:, :BUILD_EF]
            far, near = np.take_along_axis(far, order, 1), np.take_along_axis(near, order, 1)
            near = np.where(np.isfinite(far), near, -1).astype(np.int32)
            kept = self._choose(far, near, M)
            links[new, :M] = kept
            self._link_back(links, new, kept, most)
            at = int(new[-1]) + 1

    def _link_back(self, links: np.ndarray, new: np.ndarray, kept: np.ndarray, most: int) -> None:
        source, target = np.repeat(new, kept.shape[1]), kept.ravel()
        real = target >= 0
        source, target = source[real], target[real]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for s in range(0, len(nodes), 1024):
            some, start, n = nodes[s:s + 1024], first[s:s + 1024], count[s:s + 1024]
            added = np.full((len(some), int(n.max())), -1, np.int32)
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            added[np.repeat(np.arange(len(some)), n), place] = source[start[0]:start[0] + int(n.sum())]
            both = np.sort(np.concatenate([links[some], added], axis=1), axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1  # linked both ways within a batch
            there = both >= 0
            full = there.sum(axis=1)
            fits = full <= most
            order = np.argsort(~there, axis=1, kind="stable")
            both = np.take_along_axis(both, order, 1)
            wide = min(both.shape[1], most)
            links[some[fits], :wide] = both[fits, :wide]
            over = ~fits
            if over.any():
                cand = both[over, :int(full.max())]
                q = self.x[some[over]]
                far = np.where(cand >= 0, self._far(q, np.where(cand >= 0, cand, 0)) + self.norm[some[over]][:, None], _INF)
                order = np.argsort(far, axis=1, kind="stable")
                links[some[over]] = self._choose(np.take_along_axis(far, order, 1), np.take_along_axis(cand, order, 1), most)

    def nearest(self, q: np.ndarray, k: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nearest found for each query: node numbers (-1: none) and exact distances."""
        f = q.astype(np.float32)
        ids = self._beam(f, 0, self._entry(f, 0), max(ef, k), self.sizes[0])[0][:, :max(k, ef // 4)]
        d = np.sqrt(((q[:, None, :] - self.exact[np.where(ids >= 0, ids, 0)]) ** 2).sum(axis=2))
        d = np.where(ids >= 0, d, np.inf)
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)


def _levels(ids: np.ndarray) -> np.ndarray:
    """Each node's level, from its hash."""
    from ambry.llm.common import mixed
    u = (mixed(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64)
    return np.floor(-np.log((u + 0.5) / float(1 << 53)) / np.log(M)).astype(np.int64)


INDEX_SCHEMA = "shard int, node int, level int, ids array<long>, vec array<double>, links array<int>"


def build_index(rows: DataFrame, id_col: str, vec_col: str, keep: int = NEIGHBOURS + 1) -> tuple[DataFrame, int, int]:
    """The graphs of all rows, a row per node with its flat neighbours of level 0, 1 and so on;
    the number of shards; the width of the vectors.  Each node has its ``keep`` smallest ids."""
    own = rows.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.transform(vec_col, lambda x: x.cast("double")).alias("vec"))
    # -0.0 and 0.0 are one number
    own = own.where(finite("vec")).withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
    own = own.where(F.exists("vec", lambda x: x != 0))
    nodes = written(copies(own, "id", ["vec"], keep), "nodes")
    n, width = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    shards = max(1, -(-int(n) // MAX_SHARD_ROWS), int(np.ceil((int(n) / SHARD_SCALE) ** 0.5)))

    def shard_graph(t: pa.Table) -> pa.Table:
        from ambry.llm.common import mixed
        x = matrix(t.column("vec"), width)
        # a vector's own bits decide its level, so that a repeated task builds the same graph
        h = mixed(np.ascontiguousarray(x).view(np.uint64) + np.arange(1, width + 1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        level = _levels(h.view(np.int64))
        order = np.lexsort((h, -level))
        level = level[order]
        while len(level) > 1 and level[0] > 0 and (level >= level[0]).sum() < 2 and (level >= level[0] - 1).sum() < 2:
            level = np.minimum(level, level[0] - 1)
        sizes = [int((level >= at).sum()) for at in range(int(level[0]) + 1)]
        g = Graph(x[order], sizes)
        links = [np.concatenate([g.links[at][i] for at in range(int(level[i]) + 1)]) for i in range(len(level))]
        return pa.table({"shard": t.column("shard").combine_chunks(), "node": pa.array(np.arange(len(level)), pa.int32()),
                         "level": pa.array(level, pa.int32()), "ids": t.column("ids").combine_chunks().take(pa.array(order)),
                         "vec": lists_of(list(x[order]), pa.float64()), "links": lists_of(links, pa.int32())})

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int"))
    built = dealt.repartition(4 * shards, "shard").groupBy("shard").applyInArrow(shard_graph, INDEX_SCHEMA)
    return written(built, "small-worlds"), shards, int(width)


def _searcher(width: int, k: int, ef: int) -> Callable[[pa.Table], Callable[[pa.Table], pa.RecordBatch]]:
    def make(t: pa.Table) -> Callable[[pa.Table], pa.RecordBatch]:
        level = t.column("level").to_numpy()
        ids = t.column("ids").combine_chunks()
        flat, ends = t.column("links").combine_chunks(), None
        ends = np.concatenate(([0], np.cumsum(flat.value_lengths().to_numpy())))
        flat = flat.flatten().to_numpy()
        sizes = [int((level >= at).sum()) for at in range(int(level.max()) + 1)]
        links = [np.stack([flat[ends[:-1][:s] + (0 if at == 0 else 2 * M + (at - 1) * M) + j] for j in range(2 * M if at == 0 else M)], axis=1)
                 for at, s in enumerate(sizes)]
        g = Graph(matrix(t.column("vec"), width), sizes, links)

        def answer(q: pa.Table) -> pa.RecordBatch:
            found, d = g.nearest(matrix(q.column("vec"), width), k, ef)
            real = found >= 0
            row, _ = np.nonzero(real)
            mine = [q.column(c).combine_chunks().take(pa.array(row)) for c in ("a", "query_id")]
            return pa.RecordBatch.from_arrays([*mine, ids.take(pa.array(found[real])), pa.array(d[real])], ["a", "query_id", "ids", "score"])
        return answer
    return make


def neighbours(rows: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int = NEIGHBOURS,
               ef: int = SEARCH_EF) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the ``k`` nearest rows found,
    the row itself (its id and vector) left out; nearest first, ties to the smaller id."""
    index, shards, width = build_index(rows, id_col, vec_col, k + 1)
    asked = queries.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("query_id"),
                           F.transform(vec_col, lambda x: x.cast("double") + F.lit(0.0)).alias("vec")).where(finite("vec"))
    # numbered once: whatever reads the written rows sees the same numbers
    asked = written(asked.where(F.exists("vec", lambda x: x != 0)).distinct().withColumn("a", F.monotonically_increasing_id()), "ann-queries")
    found = visit(index, asked, shards, asked.count(), ["node"], _searcher(width, k + 1, ef),
                  "a long, query_id long, ids array<long>, score double")
    each = found.select("a", "query_id", "score", F.explode("ids").alias("vec_id"))
    # the query's own row: its id at no distance
    each = each.where(~((F.col("vec_id") == F.col("query_id")) & (F.col("score") == 0)))
    rank = F.row_number().over(Window.partitionBy("a").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("vec_id") != NULL_ID, F.col("vec_id")).alias("vec_id"), "score")


def neighbour_report(embeddings: DataFrame) -> DataFrame:
    """The contract's rows."""
    return neighbours(embeddings, embeddings.where(F.col("vec_id") % QUERY_EVERY == 0), "vec_id", "embedding")
