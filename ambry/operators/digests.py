"""Reconciliation of two tables by digests of key ranges.

Row counts alone don't show a changed row, and comparing all rows shuffles both
tables.  A digest of a key range is its rows' count, the sum and the exclusive or of
their hashes: it doesn't depend on the rows' order, combines in the map tasks, and
one pass without a shuffle of rows gives a few numbers a range for either side.  Only ranges
whose digests differ are read again; their rows are compared as multisets and the
target's are replaced by the source's.

Few differing ranges become a filter on the key that reaches the scan (row groups of a
table sorted by key are skipped); many are joined with the computed range.  A NULL
key's rows are a range of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from ambry.operators.deltas import SIGN, version_changes
from ambry.operators.materialize import broadcast_if_small, materialize

RANGE = "key_range"
#: So many differing ranges at most become a filter on the key.
FILTER_RANGES = 1000


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """64-bit hash of a row's columns; where a NULL lies counts."""
    types = {f.name: f.dataType for f in df.schema}
    flat = [F.to_json(F.struct(c)) if isinstance(types[c], (ArrayType, MapType, StructType, VariantType)) else F.col(c) for c in columns]
    return F.xxhash64(F.concat(*[F.isnull(c).cast("int").cast("string") for c in columns]), *flat)


def range_of(key: str, size: int) -> Column:
    return F.floor(F.col(key) / F.lit(size)).cast("long")


def digests(df: DataFrame, key: str, size: int, columns: list[str]) -> DataFrame:
    """key_range, n, total, mix."""
    h = row_hash(df, columns)
    return (df.select(range_of(key, size).alias(RANGE), h.alias("h")).groupBy(RANGE)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("total"), F.bit_xor("h").alias("mix")))


def drift(source: DataFrame, target: DataFrame, key: str, size: int, columns: list[str]) -> DataFrame:
    """key_range, source_rows, target_rows of the ranges whose digests differ."""
    both = digests(source, key, size, columns).withColumn("s", F.lit(1)).unionByName(digests(target, key, size, columns).withColumn("s", F.lit(-1)))
    return (both.groupBy(RANGE).agg(
        F.sum(F.when(F.col("s") == 1, F.col("n")).otherwise(0)).alias("source_rows"),
        F.sum(F.when(F.col("s") == -1, F.col("n")).otherwise(0)).alias("target_rows"),
        F.sum(F.col("s") * F.col("total")).alias("t"), F.bit_xor("mix").alias("x"))
        .where("source_rows <> target_rows OR t <> 0 OR x <> 0").select(RANGE, "source_rows", "target_rows"))


def splitter(ranges: DataFrame, key: str, size: int) -> Callable[[DataFrame, bool], DataFrame]:
    """Gives a table's rows inside (True) or outside (False) of ``ranges``."""
    few = ranges.select(RANGE).limit(FILTER_RANGES + 1).collect()
    if len(few) > FILTER_RANGES:
        side, _ = broadcast_if_small(ranges.select(F.struct(RANGE).alias("__r")), "drift-ranges")
        return lambda df, inside: (df.withColumn("__r", F.struct(range_of(key, size).alias(RANGE)))
                                   .join(side, "__r", "left_semi" if inside else "left_anti").drop("__r"))
    runs: list[list[int]] = []
    for r in sorted(r[0] for r in few if r[0] is not None):
        if runs and runs[-1][1] == r - 1:
            runs[-1][1] = r
        else:
            runs.append([r, r])
    k = F.col(key)
    parts = [(k >= F.lit(a * size)) & (k < F.lit((b + 1) * size)) for a, b in runs] + [k.isNull() for r in few if r[0] is None]
    hit = reduce(lambda a, b: a | b, parts, F.lit(False))
    return lambda df, inside: df.where(hit if inside else ~F.coalesce(hit, F.lit(False)))


@dataclass
class Repair:
    """``report``: key_range, source_rows, target_rows, missing, extra, changed (keys); ``changes``: the signed rows
    by which the target differs; ``table``: the target with its differing ranges taken from the source."""
    report: DataFrame
    changes: DataFrame
    table: DataFrame


def reconcile(source: DataFrame, target: DataFrame, keys: list[str], size: int) -> Repair | None:
    """Compare ``source``, in ``target``'s layout, with ``target``; None where no digest differs.
    Ranges are of the first key, an integer; keys are unique but for what drifted."""
    columns = target.columns
    found = materialize(drift(source, target, keys[0], size, columns), "drift")
    if found.isEmpty():
        return None
    part = splitter(found, keys[0], size)
    fresh = part(source.select(*columns), True)
    changes = materialize(version_changes(part(target, True), fresh, columns), "drift-changes")
    plus, minus = F.max(F.col(SIGN) > 0), F.max(F.col(SIGN) < 0)
    by_key = changes.groupBy(range_of(keys[0], size).alias(RANGE), *keys).agg(plus.alias("in_source"), minus.alias("in_target"))
    kinds = by_key.groupBy(F.col(RANGE).alias("__r")).agg(F.count_if(~F.col("in_target")).alias("missing"), F.count_if(~F.col("in_source")).alias("extra"),
                                                        F.count_if(F.col("in_source") & F.col("in_target")).alias("changed"))
    report = found.join(kinds, F.col(RANGE).eqNullSafe(F.col("__r"))).drop("__r")
    return Repair(report, changes, part(target, False).unionByName(fresh))
