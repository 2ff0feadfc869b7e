"""Joins that stay parallel when one key holds a large share of the rows.

A shuffled join sends every row of a key to one task; if one seller,
category, order or business holds a third of the rows, that task does a
third of the work.  AQE's skew split only applies when both join inputs are
plain shuffle stages, which our plans avoid on purpose (the unique side of a
join is usually an aggregate whose partitioning is reused), so hot keys are
salted explicitly:

* hot keys are found with a partial aggregate over a deterministic sample
  of the key column(s): keys whose estimated count ``n`` reaches
  ``min_rows / 2``.  There are at most about ``2 * rows / min_rows`` of
  them, so fetching and broadcasting the list is bounded by construction;
  with none, the ordinary join runs and nothing is salted;
* a hot key gets ``b = ceil(n / min_rows)`` salt buckets; each left row of
  it picks a bucket from a deterministic hash of the row, so every bucket
  holds about ``min_rows`` rows;
* the right side is unique per key (a dimension or an aggregate); its row
  for a hot key is replicated once per bucket.  The replicas total
  ``sum(b) <= about 3 * rows / min_rows`` — bounded, whatever the skew;
* rows with a NULL key never match; they are spread over buckets too,
  instead of all hashing to one task;
* the join runs on ``keys + salt``: one reference to each input, so the
  operator can be chained (ten role joins) without growing the plan.

Every left row meets exactly the right rows it would have met unsalted, so
the result is exactly the plain join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from ambry import params

SALT = "__salt"
BUCKETS = "__buckets"


SAMPLE_PER_HOT_KEY = 200    # expected sampled rows of a key with exactly min_rows rows


def hot_keys(keys_df: DataFrame, keys: list[str], min_rows: int) -> DataFrame:
    """Hot key values with their bucket count ``ceil(n / min_rows)``.

    Counting is done on a deterministic Bernoulli sample of about
    ``200 / min_rows`` of the rows (exact counting below that), so the
    extra aggregate stays tiny at any size.  Detection only steers
    parallelism: a missed key takes the ordinary join, a false one is merely
    salted — the join result is exact either way.
    """
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    fraction = min(1.0, SAMPLE_PER_HOT_KEY / min_rows)
    rows = keys_df.where(not_null)
    if fraction < 1.0:
        rows = rows.sample(fraction=fraction, seed=17)
    est = F.count(F.lit(1)) / F.lit(fraction)
    return (rows.groupBy(*keys).agg(est.alias("__n"))
            .where(F.col("__n") >= F.lit(min_rows) * (0.5 if fraction < 1.0 else 1.0))
            .select(*keys, F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(min_rows))).cast("int")
                    .alias(BUCKETS)))


def hot_from_counts(counts: DataFrame, keys: list[str], min_rows: int,
                    count_col: str = "__n") -> DataFrame:
    """Hot keys from an aggregate that already counted rows per key."""
    return (counts.where(F.col(count_col) >= min_rows)
            .select(*keys, F.ceil(F.col(count_col) / F.lit(min_rows)).cast("int").alias(BUCKETS)))


def hot_role_keys(df: DataFrame, key_cols: list[str], min_rows: int) -> DataFrame:
    """Hot keys of several key columns in one pass: ``(role, key, buckets)``.

    The key columns are unpivoted (as strings) and counted in a single
    aggregate, instead of one aggregate per column.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("role"), F.col(c).cast("string").alias("key"))
                      for c in key_cols])
    return hot_keys(df.select(F.inline(pairs)), ["role", "key"], min_rows)


def _hashable(t) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _hashable(t.elementType)
    if isinstance(t, StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return True


def _row_hash(df: DataFrame) -> Column:
    """Deterministic per-row hash over the hashable columns (maps cannot be hashed)."""
    cols = [F.col(f.name) for f in df.schema.fields if _hashable(f.dataType)]
    return F.xxhash64(*cols) if cols else F.xxhash64(F.to_json(F.struct(*df.columns)))


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def skew_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                   min_rows: int | None = None, hot: DataFrame | None = None,
                   key_source: DataFrame | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` for ``how`` in inner / left / left_semi /
    left_anti, with ``right`` unique per key.

    ``hot`` may be given (``keys`` + ``__buckets``, e.g. from
    ``hot_role_keys``); otherwise it is counted on ``key_source`` (default
    ``left``) — pass the base table the key comes from so a derived ``left``
    is not recomputed just for the count.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash and how in ("inner", "left"):
        raise ValueError(f"columns on both sides besides the keys: {sorted(clash)}")
    min_rows = min_rows or params.HOT_KEY_ROWS
    if hot is None:
        src = key_source if key_source is not None else left
        hot = hot_keys(src.select(*keys), keys, min_rows)
    hot = fetch_hot(hot)
    if hot is None:                       # nothing hot: the ordinary join
        return _plain(left, right, keys, how)
    salted_left, salted_right = salt_sides(left, right, keys, hot)
    return salted_left.join(salted_right, keys + [SALT], how).select(*_out_cols(left, right, keys, how))


def fetch_hot(hot: DataFrame) -> DataFrame | None:
    """The hot keys as a small local table, or ``None`` when there are none.

    The list has at most ``rows / min_rows`` entries — the same bound that
    makes broadcasting it safe (a broadcast passes through the driver too) —
    so it is fetched once: the join then carries no hot-key subplan, and
    the common no-skew case runs the plain join.
    """
    rows = hot.collect()
    if not rows:
        return None
    return hot.sparkSession.createDataFrame(rows, hot.schema)


def _out_cols(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> list[str]:
    cols = list(left.columns)
    if how in ("inner", "left"):
        cols += [c for c in right.columns if c not in keys]
    return cols


def _plain(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    return left.join(right, keys, how).select(*_out_cols(left, right, keys, how))


def salt_sides(left: DataFrame, right: DataFrame, keys: list[str],
               hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both join inputs with the ``__salt`` column added (see module doc)."""
    hot_b = F.broadcast(hot.select(*keys, BUCKETS))      # <= rows / min_rows entries
    # left: one bucket per row (deterministic), NULL keys spread as well
    row_hash = _row_hash(left)
    salt = (F.when(_any_null(keys), F.pmod(row_hash, F.lit(params.NULL_KEY_BUCKETS)))
            .when(F.col(BUCKETS).isNotNull(), F.pmod(row_hash, F.col(BUCKETS).cast("long")))
            .otherwise(F.lit(0)).cast("int").alias(SALT))
    salted_left = left.join(hot_b, keys, "left").select(*left.columns, salt)
    # right: one replica per bucket of a hot key, bucket 0 otherwise
    replicas = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(BUCKETS), F.lit(1)) - 1)).alias(SALT)
    salted_right = right.join(hot_b, keys, "left").select(*right.columns, replicas)
    return salted_left, salted_right
