"""Scalar expressions of the scoring and sync jobs.

Everything here returns a ``Column`` made of built-in functions, so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ambry import params


def ts_lit(t: _dt.datetime) -> Column:
    """TIMESTAMP_NTZ literal (the test data is NTZ; a plain ``lit`` is LTZ)."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def days_before(t: _dt.datetime, days: int) -> Column:
    """``t - INTERVAL days DAYS`` folded to a literal (H9)."""
    return ts_lit(t - _dt.timedelta(days=days))


def is_true(c: Column | str) -> Column:
    """``x IS TRUE``: NULL counts as false."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c, F.lit(False))


def exact_avg(c: Column | str, where: Column | None = None) -> Column:
    """Average that rounds like an exact numeric average.

    Spark's ``avg(decimal(10,2))`` keeps 6 decimals, so rounding it to 2
    decimals afterwards can double-round.  Widening the input to 10 decimals
    keeps 14 in the result, which is exact for any count below 10^12.
    ``where`` turns it into a conditional average (D5) in the same pass.
    """
    c = F.col(c) if isinstance(c, str) else c
    v = c.cast("decimal(28,10)")
    if where is not None:
        v = F.when(where, v)
    return F.avg(v)


def guarded_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``CASE WHEN den > 0 THEN ROUND(COALESCE(num,0)/COALESCE(den,0), 2) ELSE 0``.

    Integers are widened to decimal first so the quotient is a decimal with
    enough scale (H6, H7); the division never sees a zero denominator.
    """
    n = F.coalesce(num, F.lit(0)).cast("decimal(20,2)")
    d = F.coalesce(den, F.lit(0)).cast("decimal(20,2)")
    return F.when(den > 0, F.round(n / d, scale)).otherwise(F.lit(0)).cast("decimal(24,2)")


def cap(part: Column, limit: Column) -> Column:
    """``CASE WHEN part > limit THEN limit ELSE part END`` (H5).

    Unlike ``least``, a NULL part or limit yields the part (NULL propagates).
    """
    return F.when(part > limit, limit).otherwise(part)


def stock_factor(stock: Column) -> Column:
    """Five-way stock availability bucket (H4)."""
    expr = None
    for lo, hi, factor in params.STOCK_BUCKETS:
        cond = stock >= lo if hi is None else (stock >= lo) & (stock <= hi)
        val = F.lit(factor).cast("decimal(3,2)")
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(F.lit(0).cast("decimal(3,2)"))
