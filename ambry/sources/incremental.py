"""Incremental and paged scans (A1, A2, F1, F2)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry.functions import ts_lit


def changed_rows(source: DataFrame, ts_col: str, since: _dt.datetime | None) -> DataFrame:
    """A1: rows with ``ts > since`` (strict; NULL ts is never captured).

    With ``since=None`` this is the full scan (A2).  The predicate is a
    literal comparison, so it reaches the Parquet/JDBC scan as a pushed
    filter (row-group skipping on sorted or partitioned data).
    """
    if since is None:
        return source
    return source.where(F.col(ts_col) > ts_lit(since))


def page(df: DataFrame, order_by: list[str], offset: int, limit: int) -> DataFrame:
    """one page of a sorted scan, ``ORDER BY .. LIMIT n OFFSET k``.

    The caller passes a total order (e.g. ts then pk) — the reference's
    ts-only order lets pages skip or repeat rows inside a tie.
    """
    return df.orderBy(*order_by).offset(offset).limit(limit)
