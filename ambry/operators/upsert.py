"""Write-side operators without MERGE.

Parquet tables have no MERGE/UPDATE, so each operator returns the *new
version* of the target as a DataFrame; the caller writes it as a new
version (see ``ambry.operators.versioned``).

Plan shape: the changed batch is usually far smaller than the target, so the
key operations are ``left_anti``/``left_semi`` joins whose small side AQE
broadcasts after checking its runtime size; with a large batch they fall back
to a shuffled join.  Nothing is collected.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from ambry.functions import ts_lit


def _orderable(df: DataFrame, exclude: list[str]) -> list[str]:
    """Columns usable in a deterministic ordering (maps/variants are not)."""
    def ok(t) -> bool:
        if isinstance(t, (MapType, VariantType)):
            return False
        if isinstance(t, ArrayType):
            return ok(t.elementType)
        if isinstance(t, StructType):
            return all(ok(f.dataType) for f in t.fields)
        return True
    return [f.name for f in df.schema.fields if f.name not in exclude and ok(f.dataType)]


def latest_per_key(batch: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """Keep the newest row per key: ts descending, then all other columns.

    A ``max_by`` aggregate instead of a ``row_number`` window: partial
    aggregation collapses a hot key map-side, so one key holding a third of
    the batch never lands in one task.  Applying the ts-ordered batch row by
    row (the reference's chunk loop) leaves the same last row, except that
    we also break ties on the other columns deterministically.
    """
    others = [c for c in batch.columns if c not in keys]
    if not others:
        return batch.dropDuplicates(keys)
    order = F.struct(F.col(ts_col), *[F.col(c) for c in _orderable(batch, keys + [ts_col])])
    picked = batch.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others]).select(*batch.columns)


def upsert(target: DataFrame, batch: DataFrame, keys: list[str],
           ts_col: str | None = None) -> DataFrame:
    """Insert new keys, overwrite every non-key column of existing keys.

    NULLs in the batch overwrite values (no coalesce); the last write wins
    even if it is older.  Duplicate keys in the batch collapse to the newest
    row (``ts_col``) — the reference would apply them in ts order.

    A NULL in a key fails the job: the keys are declared NOT NULL.

    The deduplicated batch is written once; the count, the anti join and the
    result all read that copy, so a live source is read a single time.  When
    its keys have at most ``BROADCAST_MAX_BYTES`` they are broadcast, so the
    target is streamed through the anti join and never shuffled.  A larger
    batch takes a shuffled anti join (keys unique on both sides, so no skew).
    """
    batch, small = prepared_batch(batch.select(*target.columns), keys, ts_col)
    return applied(target, batch, keys, small)


def prepared_batch(batch: DataFrame, keys: list[str], ts_col: str | None) -> tuple[DataFrame, bool]:
    """The batch with one row per key, none of them NULL, written once; and whether its keys are small enough to broadcast."""
    from ambry import params
    from ambry.operators.contracts import not_null_guard
    from ambry.operators.materialize import stored_bytes
    from ambry.session import scratch_path

    if ts_col is not None:
        batch = latest_per_key(batch, keys, ts_col)
    else:
        batch = batch.dropDuplicates(keys)
    for k in keys:
        batch = batch.where(not_null_guard(F.col(k), "upsert", k))
    path = scratch_path(batch.sparkSession, "upsert-batch")
    batch.write.parquet(path)
    written = batch.sparkSession.read.schema(batch.schema).parquet(path)
    # the keys are a part of the batch, whose size bounds theirs
    return written, stored_bytes(batch.sparkSession, path) <= params.BROADCAST_MAX_BYTES


def applied(target: DataFrame, batch: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """``target`` with a prepared batch's rows in place of those of their keys."""
    some = batch.select(*keys)
    return target.join(F.broadcast(some) if small else some, keys, "left_anti").unionByName(batch)


def _comparable(c: Column, t) -> Column:
    """A column as something that can be compared: maps and variants as their JSON text."""
    return F.to_json(F.struct(c.alias("v"))) if isinstance(t, (MapType, VariantType)) or "map<" in t.simpleString() or "variant" in t.simpleString() else c


def changed_pairs(target: DataFrame, batch: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """``before`` and ``after`` (structs of all columns) of the batch's rows that differ from the
    target's; ``before`` is NULL where a key is new.  Rows read again unchanged are no change."""
    from ambry.operators.materialize import materialize

    some = batch.select(*keys)
    old = materialize(target.join(F.broadcast(some) if small else some, keys, "left_semi"), "upsert-before")
    b = batch.select(F.struct(*batch.columns).alias("after"), *[F.col(k).alias(f"__{k}") for k in keys])
    o = old.select(F.struct(*batch.columns).alias("before"), *[F.col(k).alias(f"__{k}") for k in keys])
    same = F.col("before").isNotNull()
    for f in batch.schema:
        same = same & _comparable(F.col(f"before.`{f.name}`"), f.dataType).eqNullSafe(_comparable(F.col(f"after.`{f.name}`"), f.dataType))
    return materialize(b.join(o, [f"__{k}" for k in keys], "left").where(~same).select("before", "after"), "upsert-changes")


def conditional_upsert(target: DataFrame, offered: DataFrame, key: str, value_cols: list[str],
                       ts_col: str, as_of: _dt.datetime) -> DataFrame:
    """``ON CONFLICT DO UPDATE ... WHERE t.v IS DISTINCT FROM excluded.v``.

    New keys are inserted with ``as_of``; existing keys take the offered
    values and ``as_of`` only if some value differs (NULL-safe); keys absent
    from the offer are kept untouched.  ``offered`` must already be cast to
    the stored type so the comparison is after rounding.
    """
    t, o = target.alias("t"), offered.alias("o")
    j = t.join(o, F.col(f"t.{key}") == F.col(f"o.{key}"), "full_outer")
    has_offer = F.col(f"o.{key}").isNotNull()
    has_old = F.col(f"t.{key}").isNotNull()
    differs = F.lit(False)
    for c in value_cols:
        differs = differs | ~F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}"))
    write = has_offer & (~has_old | differs)
    cols: list[Column] = [F.coalesce(F.col(f"o.{key}"), F.col(f"t.{key}")).alias(key)]
    for c in value_cols:
        cols.append(F.when(write, F.col(f"o.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    cols.append(F.when(write, ts_lit(as_of)).otherwise(F.col(f"t.{ts_col}")).alias(ts_col))
    return j.select(*cols)


def update_from(target: DataFrame, source: DataFrame, key: str, assignments: dict[str, str],
                ts_col: str | None, as_of: _dt.datetime) -> DataFrame:
    """``UPDATE target SET col = source.x, ts = now FROM source WHERE key``.

    Every matched row is rewritten (even when unchanged); others untouched.
    ``source`` is unique on ``key`` (it is a primary-keyed table).
    """
    from ambry.operators.materialize import broadcast_if_small

    src_cols = sorted(set(assignments.values()))
    s = source.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__s_{c}") for c in src_cols])
    # The target (e.g. a curated subset) is usually far smaller than the
    # source; a LEFT join cannot broadcast its right side, so the source is
    # first reduced to the target's keys (counted, broadcast within the
    # bound) and the reduced source — no larger than the key set — is then
    # broadcast into the LEFT join.  Nothing big is shuffled.
    tkeys, small = broadcast_if_small(target.select(F.col(key).alias("__k")).distinct(), "update-keys")
    s = s.join(tkeys, "__k", "left_semi")
    j = target.join(F.broadcast(s) if small else s, F.col(key) == F.col("__k"), "left")
    hit = F.col("__k").isNotNull()
    out = []
    for c in target.columns:
        if c in assignments:
            out.append(F.when(hit, F.col(f"__s_{assignments[c]}")).otherwise(F.col(c))
                       .cast(target.schema[c].dataType).alias(c))
        elif c == ts_col:
            out.append(F.when(hit, ts_lit(as_of)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)
