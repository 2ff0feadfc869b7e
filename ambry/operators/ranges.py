"""Upsert that rewrites only the key ranges a batch touches.

Operational tables use increasing (serial) keys, and changes concentrate on
recent keys.  Laying the bronze table out as Parquet partitions of
``key div range_size`` lets an upsert read, merge and rewrite only the
partitions whose range received a changed row:

1. the batch is reduced to the newest row per key (partial aggregate);
2. the touched ranges are the distinct ranges of the batch — a small set;
3. the touched range numbers are fetched once — one long per touched
   partition, bounded by the table's partition count and never by its rows —
   and become a static partition filter, so untouched ranges are never
   listed or read (a semi join would not prune: dynamic partition pruning
   needs a selective filter on the other side);
4. the merged rows of the touched ranges are written to a staging folder in
   the shared checkpoint area (Spark cannot overwrite the partitions it is
   reading), then copied over the target with dynamic partition overwrite,
   which replaces exactly the partitions present in the staged data.

Re-running after a failure is safe: the staged data is a complete image of
each touched range, so copying it again gives the same table.

A folder costs a file to open, to write and to move, however few rows it has.  So a table of
more than ``FOLDERS`` ranges is laid out in folders of 2, 4, 8, ... adjacent ranges, which
hold at most ``FOLDER_KEYS`` keys; the partition column's name says how many
(``key_range_x8``), and the folder is then what an upsert rewrites.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from ambry.operators.materialize import materialize
from ambry.operators.schema_evolution import align_to_target, evolve_schema, evolve_table
from ambry.operators.upsert import applied, latest_per_key, prepared_batch
from ambry.session import scratch_path

RANGE_COL = "key_range"
#: A table of more ranges than this gets folders of several, of so many keys at most.
FOLDERS, FOLDER_KEYS = 256, 1 << 20


def key_range(pk: str, range_size: int, column: str = RANGE_COL) -> Column:
    return F.floor(F.col(pk) / F.lit(range_size)).cast("long").alias(column)


def folder_ranges(n_ranges: int, range_size: int) -> int:
    """How many adjacent ranges of a table of ``n_ranges`` share a folder: a power of two."""
    per = 1
    while n_ranges > FOLDERS * per and 2 * per * range_size <= FOLDER_KEYS:
        per *= 2
    return per


def write_ranged(df: DataFrame, path: str, pk: str, range_size: int) -> None:
    """Initial layout of a target table, partitioned by key range.  The keys are read once more to count the ranges."""
    per = folder_ranges(df.select(key_range(pk, range_size)).distinct().count(), range_size)
    column = RANGE_COL if per == 1 else f"{RANGE_COL}_x{per}"
    (df.withColumn(column, key_range(pk, range_size * per))
     .repartition(column).write.mode("overwrite").partitionBy(column).parquet(path))


def _laid_out(spark: SparkSession, path: str) -> tuple[DataFrame, str, int]:
    """The table in its widest layout, its partition column and how many ranges a folder has."""
    table = spark.read.option("mergeSchema", "true").parquet(path)
    column = table.columns[-1]      # partition columns are the last ones
    named = re.fullmatch(RANGE_COL + r"(?:_x(\d+))?", column)
    if not named:
        raise ValueError(f"{path}: not partitioned by key range, but by {column}")
    return table, column, int(named[1] or 1)


def read_ranged(spark: SparkSession, path: str) -> DataFrame:
    """The whole table (all ranges, widest layout) without the range column."""
    table, column, _ = _laid_out(spark, path)
    return table.drop(column)


def upsert_touched_ranges(spark: SparkSession, path: str, batch: DataFrame, pk: str | list[str],
                          ts_col: str, range_size: int, newer_only: bool = False) -> DataFrame:
    """Upsert ``batch`` into the range-partitioned table at ``path``.

    The range is taken on the first key column; rows are matched on all key
    columns.  New batch columns are added (additive evolution): the touched
    partitions are written with the wider layout and the table is read with
    ``mergeSchema``, so untouched partitions show NULL for them.
    With ``newer_only`` a stored row stays where the batch's is older.
    Returns the staged rows of the touched ranges (already written); an
    empty batch changes nothing.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    current, column, per = _laid_out(spark, path)
    base = StructType([f for f in current.schema.fields if f.name != column])
    schema = evolve_schema(base, batch.schema)
    folder = key_range(keys[0], range_size * per, column)
    # the newest rows are written once: a batch may be costly, or a stream's
    newest = align_to_target(batch, schema)
    if newer_only:
        newest = materialize(latest_per_key(newest, keys, ts_col), "touched-batch")
    else:
        newest, small = prepared_batch(newest, keys, ts_col)
    touched = [r[0] for r in newest.select(folder).distinct().collect()]
    if not touched:                       # empty batch: nothing to rewrite
        return newest.withColumn(column, folder)
    old = evolve_table(current.where(F.col(column).isin(touched)).drop(column), schema)
    newest = newest.select(*old.columns)
    if newer_only:
        merged = latest_per_key(old.unionByName(newest), keys, ts_col)
    else:
        merged = applied(old, newest, keys, small)
    staging = scratch_path(spark, "touched-ranges")
    merged.withColumn(column, folder).repartition(column).write.partitionBy(column).parquet(staging)
    staged = spark.read.parquet(staging)
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))
    return staged
