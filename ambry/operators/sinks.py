"""Sinks (A7, A8) with free row metrics.

``observe`` attaches named aggregates to the write itself, so the row count
(and max change timestamp) of what was written come back without a second
scan — the reference counts before fetching with a separate query.

Note (PySpark 4.1): after an ``Observation`` has been used, a later query in
the same session that fails analysis (e.g. reading a missing path inside a
``try``) makes the listener bus log an ERROR line; it is harmless.  Library
internals therefore count written copies instead of observing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def _observed(df: DataFrame, name: str, ts_col: str | None) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if ts_col:
        metrics.append(F.max(ts_col).alias("max_ts"))
    return df.observe(obs, *metrics), obs


def append_rows(df: DataFrame, path: str, ts_col: str | None = None) -> dict:
    """Append without conflict handling; returns the observed metrics."""
    out, obs = _observed(df, "append", ts_col)
    out.write.mode("append").parquet(path)
    return obs.get


def replace_table(df: DataFrame, path: str, ts_col: str | None = None,
                  partition_by: list[str] | None = None) -> dict:
    """Truncate-and-insert.  ``path`` must not be read by ``df`` (Spark
    cannot overwrite its own input); write to a new version instead."""
    out, obs = _observed(df, "replace", ts_col)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return obs.get
