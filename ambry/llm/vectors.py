"""What the vector operators share: usable rows, shards, and queries that visit every shard."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries that one task answers against one shard; more go to further tasks with a copy of the shard.
TASK_QUERIES = 50_000
#: Queries that are worked on at once.
QUERY_BATCH = 256
#: Stands for a null id inside the operators: it comes after all others.
NULL_ID = (1 << 63) - 1


def finite(vec: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    def ok(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vec, ok), F.lit(False))


def copies(rows: DataFrame, ids: str, keys: list[str], keep: int) -> DataFrame:
    """One row per distinct ``keys`` with its ``keep`` smallest distinct ids, ascending.

    Equal rows are dropped first and each task keeps the smallest ids of a key before they meet, so
    that a vector which most rows share is no load for one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(ids))
    least = rows.distinct().withColumn("_rank", rank).where(F.col("_rank") <= keep)
    return least.groupBy(*keys).agg(F.array_sort(F.collect_list(ids)).alias("ids"))


def matrix(lists: pa.Array | pa.ChunkedArray, width: int, dtype: type = np.float64) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones end with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def lists_of(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else [], kind))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """Rows of equal (shard, part) and kind that lie together."""
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "_part", "_kind")])
        starts = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [b.num_rows]))
        for s, e in zip(starts[:-1], starts[1:]):
            yield (int(keys[0, s]), int(keys[1, s])), int(keys[2, s]), b.slice(s, e - s)


def visit(index: DataFrame, queries: DataFrame, shards: int, n_queries: int, order: list[str],
          make: Callable[[pa.Table], Callable[[pa.Table], pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``make(rows of a shard)(rows of queries)`` returns for all queries against every shard.

    ``index`` has its rows' ``shard``.  Queries are no cross join: each is sent to every shard once,
    and a task holds one shard and a batch of queries.  A task that is lost is run again from its
    shuffled rows.
    """
    parts = n_queries // TASK_QUERIES + 1
    held = index.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("_kind", F.lit(0))
    asked = (queries.withColumn("_part", F.pmod(F.xxhash64(*queries.columns), F.lit(parts)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("_kind", F.lit(1)))
    both = held.unionByName(asked, allowMissingColumns=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, waiting, answer = None, [], [], None

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting and answer is not None:
                yield answer(pa.Table.from_batches(waiting))
            waiting.clear()

        for key, kind, piece in _runs(batches):
            if key != at:
                yield from flush()
                at, rows, answer = key, [], None
            if kind == 0:
                rows.append(piece)
                continue
            if rows:
                answer, rows = make(pa.Table.from_batches(rows)), []
            while piece.num_rows:
                room = QUERY_BATCH - sum(w.num_rows for w in waiting)
                waiting.append(piece.slice(0, room))
                piece = piece.slice(room)
                if piece.num_rows or sum(w.num_rows for w in waiting) >= QUERY_BATCH:
                    yield from flush()
        yield from flush()

    # a number of its own: Spark then doesn't merge small but laborious partitions
    return (both.repartition(4 * shards * parts, "shard", "_part")
            .sortWithinPartitions("shard", "_part", "_kind", *order).mapInArrow(work, schema))
