"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from ambry.functions.scalar import (  # noqa: F401
    cap, days_before, exact_avg, guarded_ratio, is_true, stock_factor, ts_lit,
)
