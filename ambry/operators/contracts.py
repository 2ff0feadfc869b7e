"""Declared table contracts (A9, A14, A17) and lazy constraint checks.

Parquet does not enforce NOT NULL or primary keys, so a contract projects a
frame onto the declared columns, casts each column (assignment cast: HALF_UP
rounding, overflow raises under ANSI) and wraps NOT NULL columns in a
``raise_error`` guard.  The guard is an ordinary filter predicate: it costs
nothing extra and fails the job on the first violating row, like the
database would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def not_null_guard(c: Column, table: str, name: str) -> Column:
    """A predicate that is TRUE for non-NULL values and raises otherwise."""
    msg = f"NOT NULL violated: {table}.{name}"
    return F.when(c.isNull(), F.raise_error(F.lit(msg))).otherwise(F.lit(True))


def apply_contract(df: DataFrame, schema: StructType, table: str = "table",
                   positional: bool = False, keys: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` onto ``schema``.

    ``positional=True`` maps source columns to target columns by position
    (the extract-and-load semantics of A3); otherwise by name.  Columns that
    already have the declared type are passed through untouched.  NOT NULL
    guards of ``keys`` are a filter, so an upstream hash partitioning on the
    key survives the contract (no re-shuffle before the next join); other
    columns are guarded inside the projection, so a computed value is never
    evaluated twice (a filter would be pushed below the projection and
    recompute it).
    """
    src = df.columns
    types = dict(df.dtypes)
    if positional:
        if len(src) != len(schema.fields):
            raise ValueError(f"{table}: {len(src)} columns for {len(schema.fields)} targets")
        pairs = list(zip(src, schema.fields))
    else:
        missing = [f.name for f in schema.fields if f.name not in src]
        if missing:
            raise ValueError(f"{table}: missing columns {missing}")
        pairs = [(f.name, f) for f in schema.fields]
    cols = []
    for s, f in pairs:
        c = F.col(s)
        if types[s] != f.dataType.simpleString():
            c = c.cast(f.dataType)
        if not f.nullable and f.name not in keys:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NOT NULL violated: {table}.{f.name}"))).otherwise(c)
        cols.append(c.alias(f.name))
    out = df.select(*cols)
    guards = [not_null_guard(F.col(f.name), table, f.name) for f in schema.fields
              if not f.nullable and f.name in keys]
    if guards:
        cond = guards[0]
        for g in guards[1:]:
            cond = cond & g
        out = out.where(cond)
    return out


def require_keys(df: DataFrame, keys: list[str], table: str = "table") -> DataFrame:
    """``df`` itself, failing on a NULL or repeated key when it is run.

    The check is one hash aggregate over the key columns alone, read as a
    scalar subquery; the rows are neither shuffled nor aggregated.
    """
    most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).scalar()
    cond = F.when(most > 1, F.raise_error(F.lit(f"PRIMARY KEY violated: {table}({', '.join(keys)})"))).otherwise(F.lit(True))
    for k in keys:
        cond = cond & not_null_guard(F.col(k), table, k)
    return df.where(cond)


def assert_unique(df: DataFrame, keys: list[str], table: str = "table") -> DataFrame:
    """Fail if ``keys`` repeat; returns one row per key (the input rows).

    Implemented as a grouped aggregate with a ``raise_error`` guard: partial
    aggregation keeps it skew-proof, and it adds no extra job.
    """
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.first(c).alias(c) for c in others])
    msg = F.lit(f"PRIMARY KEY violated: {table}({', '.join(keys)})")
    guarded = F.when(F.col("__n") > 1, F.raise_error(msg))
    return agg.where(guarded.isNull()).select(*df.columns)
