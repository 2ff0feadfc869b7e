"""Run log of table syncs (I6, J6): append-only events, folded to one state row per target.

A run writes RUNNING before it reads, then SUCCESS or FAILED; nothing is ever updated,
so a crash leaves its RUNNING event and loses nothing.  The state of a target is folded
from its events: description, status, error and time are the newest event's, watermark,
counts and version the newest successful one's.  RUNNING and FAILED thus keep the
watermark, and a later run starts from the last good version.  The log has two small rows
a run; what is read on the driver is one row.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ambry import params
from ambry.functions import ts_lit
from ambry.operators.state import AUDIT_KEYS, AUDIT_SCHEMA, DESCRIBED, MEASURED
from ambry.operators.versioned import exists

LOG_SCHEMA = f"run_id BIGINT, seq BIGINT, version BIGINT, {AUDIT_SCHEMA}"
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"


def fold(events: DataFrame) -> DataFrame:
    """One row per target: the state columns, ``version`` (the newest good one) and ``run_id`` (of the newest event)."""
    seq, good = F.col("seq"), F.col("status") == SUCCESS
    newest = F.struct(*DESCRIBED, "status", "last_error", "updated_at", "run_id")
    kept = F.struct(*MEASURED, "version")
    g = events.groupBy(*[F.lower(k).alias(f"__{k}") for k in AUDIT_KEYS]).agg(
        F.max_by(newest, seq).alias("e"), F.max_by(F.when(good, kept), F.when(good, seq)).alias("m"))
    return g.select(*[F.col(f"e.{c}") for c in DESCRIBED],
                    F.coalesce("m.last_synced_at", ts_lit(params.DEFAULT_WATERMARK)).alias("last_synced_at"),
                    F.col("m.last_source_max_updated"), F.coalesce("m.last_source_row_count", F.lit(0)).alias("last_source_row_count"),
                    F.coalesce("m.last_target_row_count", F.lit(0)).alias("last_target_row_count"),
                    "e.status", "e.last_error", "e.updated_at", "m.version", "e.run_id")


class RunLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def events(self) -> DataFrame:
        if not exists(self.spark, self.root):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.root)

    def state(self) -> DataFrame:
        return fold(self.events())

    def before(self, run_id: int) -> tuple[Row | None, int]:
        """The state as earlier runs left it (None: there were none), and the number of events so far."""
        events = self.events()
        n = events.agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1
        return (fold(events.where(F.col("run_id") < run_id)).first() if n else None), n

    def versions(self, after: int, upto: int) -> list[int]:
        """Versions that successful runs above ``after`` and up to ``upto`` wrote, ascending."""
        own = self.events().where((F.col("status") == SUCCESS) & (F.col("run_id") > after) & (F.col("run_id") <= upto) & (F.col("version") > after))
        return sorted(r[0] for r in own.select("version").distinct().collect())

    def last_version(self, upto: int) -> int | None:
        """The version that the newest successful run up to ``upto`` left."""
        own = self.events().where((F.col("status") == SUCCESS) & (F.col("run_id") <= upto))
        return own.agg(F.max("version")).first()[0]

    def succeeded(self, run_id: int) -> bool:
        return not self.events().where((F.col("run_id") == run_id) & (F.col("status") == SUCCESS)).isEmpty()

    def append(self, run_id: int, seq: int, row: DataFrame, version: int | None = None) -> None:
        """One event; ``row`` has the state columns."""
        (row.withColumns({"run_id": F.lit(run_id).cast("bigint"), "seq": F.lit(seq).cast("bigint"), "version": F.lit(version).cast("bigint")})
         .select("run_id", "seq", "version", *row.columns).coalesce(1).write.mode("append").parquet(self.root))

    def status_row(self, described: dict, status: str, at: _dt.datetime, error: str | None = None) -> DataFrame:
        """The state columns of a RUNNING or FAILED event."""
        text = None if error is None else error[: params.ERROR_TEXT_LIMIT]
        values = [described.get(c) for c in DESCRIBED] + [None] * len(MEASURED) + [status, text, at]
        return self.spark.createDataFrame([tuple(values)], AUDIT_SCHEMA)
