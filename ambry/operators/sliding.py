"""Trailing windows from mergeable day partials.

An aggregate over the rows since ``as_of - n days`` would read the whole window in
every run.  Here each run adds up only what changed since the last one: signed sums per
key and day are appended to a store of day partials, and the window's totals move by

    + the run's own sums of days inside the window
    - the stored sums of the days that left it

so a run reads its changes, the expired days' partials (a partition filter) and the
totals.  A window that starts within a day takes the rest of that day from the source.
Late rows, corrections and rows that vanish are signed changes of their day like any others.

Layout below ``root``: ``days/run=N/day=D`` (signed sums of run N), ``base/vN`` (all days
still in the window when run N compacted them), ``totals/vN`` and ``window/vN`` (its first whole day).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ambry.functions import ts_lit
from ambry.operators.deltas import SIGN, Fact, maintain, signed
from ambry.operators.versioned import exists, last_version, read_version, version_path, write_version

DAY = "day"


class SlidingWindow:
    """``fact`` gives keys, count and measures of source rows that have a timestamp ``ts``."""

    def __init__(self, spark: SparkSession, root: str, fact: Fact, ts: str):
        self.spark, self.root, self.fact, self.ts = spark, root.rstrip("/"), fact, ts
        self.by_day = replace(fact, keys=(*fact.keys, DAY), rows=lambda rows: fact.rows(rows).withColumn(DAY, F.to_date(ts)))

    @staticmethod
    def first_day(since: _dt.datetime) -> _dt.date:
        """The first day that lies whole in the window."""
        day = since.date()
        return day if since.time() == _dt.time() else day + _dt.timedelta(days=1)

    def partials(self, run: int, first: _dt.date, until: _dt.date, schema: StructType) -> DataFrame:
        """Sums per key and day of ``first`` <= day < ``until`` as of ``run``: only these days' folders are read."""
        base = last_version(self.spark, f"{self.root}/base", run + 1)
        days = (F.col(DAY) >= F.lit(first)) & (F.col(DAY) < F.lit(until))
        parts = []
        if base is not None:
            parts.append(self.spark.read.schema(schema).parquet(version_path(f"{self.root}/base", base)).where(days))
        runs = [n for n in self._runs() if (-1 if base is None else base) < n <= run]
        if runs:
            parts.append(self.spark.read.schema(schema).option("basePath", f"{self.root}/days")
                         .parquet(*[f"{self.root}/days/run={n}" for n in runs]).where(days).drop("run"))
        columns = [*self.by_day.keys, self.fact.count, *self.fact.measures]
        if not parts:
            return self.spark.createDataFrame([], schema).select(*columns)
        out = parts[0].select(*columns)
        for p in parts[1:]:
            out = out.unionByName(p.select(*columns))
        return out

    def _runs(self) -> list[int]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/days")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(n for n in (int(x[4:]) for x in names if x.startswith("run=")) if exists(self.spark, f"{self.root}/days/run={n}/_SUCCESS"))

    def slide(self, run: int, since: _dt.datetime, changes: DataFrame,
              edge: Callable[[_dt.datetime, _dt.datetime], DataFrame] | None = None) -> DataFrame:
        """The window's totals after ``run``: keys, count and measures of the rows at or after ``since``.

        ``changes`` are the signed source rows since the last run (on the first run, all rows of the
        window).  ``edge`` gives the source's rows of a time span, for a window that starts within a day.
        A run that failed is repeated with the same number: it overwrites what it left.
        """
        first = self.first_day(since)
        delta = self.by_day.delta(changes)
        delta = delta.where(" OR ".join(f"`{c}` <> 0" for c in delta.columns if c not in self.by_day.keys))
        schema = StructType([f for f in delta.schema if f.name != DAY]).add(DAY, DateType())
        path = f"{self.root}/days/run={run}"
        # few files a day; a day of many keys is split
        delta.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(path)
        own = self.spark.read.schema(schema).parquet(path)

        last = last_version(self.spark, f"{self.root}/totals", run)
        if last is None:
            moved, stored = own.where(F.col(DAY) >= F.lit(first)), {}
        else:
            was = read_version(self.spark, f"{self.root}/window", last).first()[0]
            stored = {"window": read_version(self.spark, f"{self.root}/totals", last)}
            moved = self._signed(own.where(F.col(DAY) >= F.lit(was)), 1)
            if first > was:     # days that left the window
                moved = moved.unionByName(self._signed(self.partials(run, was, first, schema), -1))
            elif first < was:   # a window that starts earlier than the last one did
                moved = moved.unionByName(self._signed(self.partials(run, first, was, schema), 1))
        if last is None:
            moved = self._signed(moved, 1)
        totals = maintain(self._added(), "window", stored, moved)["window"]
        self.spark.createDataFrame([(first,)], "first_day date").coalesce(1).write.mode("overwrite").parquet(version_path(f"{self.root}/window", run))
        write_version(totals, f"{self.root}/totals", run)
        out = read_version(self.spark, f"{self.root}/totals", run)
        midnight = _dt.datetime.combine(first, _dt.time())
        if edge is None or since >= midnight:
            return out
        rest = edge(since, midnight).where((F.col(self.ts) >= ts_lit(since)) & (F.col(self.ts) < ts_lit(midnight)))
        return maintain(self._added(), "edge", {"edge": out}, self._signed(self.fact.delta(signed(rest, 1)), 1))["edge"]

    def _signed(self, sums: DataFrame, sign: int) -> DataFrame:
        return signed(sums.select(*self.fact.keys, self.fact.count, *self.fact.measures), sign)

    def _added(self) -> Fact:
        """The fact over rows that are sums already."""
        return replace(self.fact, rows=lambda rows: rows, count_of=lambda: F.col(self.fact.count),
                       measures={c: ((lambda c=c: F.col(c)), t) for c, (_, t) in self.fact.measures.items()})

    def compact(self, run: int) -> None:
        """Add up the partials of all runs up to ``run`` and drop the days that left the window:
        later runs read one sum a key and day."""
        first = read_version(self.spark, f"{self.root}/window", run).first()[0]
        base = last_version(self.spark, f"{self.root}/base", run)
        path = version_path(f"{self.root}/base", base) if base is not None else f"{self.root}/days/run={self._runs()[0]}"
        schema = self.spark.read.parquet(path).drop("run").schema
        rows = self.partials(run, first, _dt.date.max, schema)
        sums = [self.fact.count, *self.fact.measures]
        whole = rows.groupBy(*self.by_day.keys).agg(*[F.sum(c).cast(dict(rows.dtypes)[c]).alias(c) for c in sums])
        write_version(whole.where(F.col(self.fact.count) != 0).hint("rebalance", DAY), f"{self.root}/base", run, partition_by=[DAY])
