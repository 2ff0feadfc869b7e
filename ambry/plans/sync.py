"""Warehouse sync: operational tables → bronze by watermark.

One run of ``sync_table`` is: read the watermark (J1) → create or evolve the
target layout (A14/A15) → scan rows changed since the watermark (A1) →
project them onto the target (A16–A18) → upsert by key (I1) → audit row and
new watermark ``as_of - 6 h`` (J4/J6).  The reference pages the changed rows
through one Python process 1000 at a time; here the scan, the key dedupe and
the anti-join are distributed and the whole batch is one plan.

Scale notes: the watermark is a literal, so it is pushed into the source
scan; the changed batch is small next to the target, so the ``left_anti``
against the target is a broadcast once AQE has measured the batch (and a
shuffled join when it is not small).  A hot key in the batch collapses in
the partial ``max_by`` aggregate of ``latest_per_key``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambry import params
from ambry.operators.schema_evolution import (align_to_target, create_target_schema, empty_table,
                                              evolve_schema, evolve_table)
from ambry.operators.state import AUDIT_KEYS, audit_row, empty_audit, read_source_max, read_watermark, upsert_state
from ambry.operators.contracts import require_keys
from ambry.operators.deltas import signed
from ambry.operators.upsert import applied, changed_pairs, prepared_batch, upsert
from ambry.sources.incremental import changed_rows


@dataclass(frozen=True)
class TableMapping:
    source_table: str
    target_table: str
    pk: list[str]
    ts_column: str = "updated_at"
    source_db_name: str = "source"
    source_schema: str = "public"
    target_db_name: str = "dw"
    target_schema: str = "bronze"
    extra: dict = field(default_factory=dict)

    def state_keys(self) -> dict[str, str]:
        return {"target_db_name": self.target_db_name, "target_schema": self.target_schema,
                "target_table": self.target_table}

    def described(self) -> dict:
        """What a state row says of the mapping."""
        return {**self.state_keys(), "table_name": f"{self.target_schema}.{self.target_table}", "table_no": self.extra.get("table_no"),
                "source_conn_id": self.extra.get("source_conn_id"), "target_conn_id": self.extra.get("target_conn_id"),
                "source_db_name": self.source_db_name, "source_schema": self.source_schema, "source_table": self.source_table,
                "pk_column": ",".join(self.pk), "ts_column": self.ts_column}


@dataclass
class SyncResult:
    target: DataFrame        # the new target version (lazy)
    state: DataFrame         # the new audit/watermark table (lazy)
    audit: DataFrame         # this run's audit row (lazy)
    changed: DataFrame       # rows captured by this run (lazy)
    since: _dt.datetime      # watermark the run started from
    changes: DataFrame | None = None   # before- and after-images of what changed, signed (written)


def sync_table(spark: SparkSession, source: DataFrame, target: DataFrame | None,
               mapping: TableMapping, state: DataFrame | None, as_of: _dt.datetime,
               overlap_hours: int = params.SYNC_OVERLAP_HOURS, feed: bool = False) -> SyncResult:
    """One incremental sync of ``source`` into ``target``.

    With ``feed`` the rows that the overlap reads again unchanged are left out of the upsert, and
    the others' images before and after are given as ``changes`` (``operators/deltas``); a first load has none.
    """
    changes = None
    since = read_watermark(state, mapping.state_keys())
    state = state if state is not None else empty_audit(spark)
    first_load = target is None
    if first_load:
        tschema = create_target_schema(source.schema, mapping.pk)
        target = empty_table(spark, tschema)
    else:
        tschema = evolve_schema(target.schema, source.schema)
        target = evolve_table(target, tschema)
    changed = changed_rows(source, mapping.ts_column, since)
    batch = align_to_target(changed, tschema)
    if first_load:   # nothing to merge into; a repeated or NULL key fails instead of losing rows
        new_target = require_keys(batch, mapping.pk, mapping.target_table)
    elif feed:
        batch, small = prepared_batch(batch, mapping.pk, mapping.ts_column)
        pairs = changed_pairs(target, batch, mapping.pk, small)
        new_target = applied(target, pairs.select("after.*"), mapping.pk, small)
        changes = signed(pairs.select("after.*"), 1).unionByName(signed(pairs.where("before IS NOT NULL").select("before.*"), -1))
    else:
        new_target = upsert(target, batch, mapping.pk, mapping.ts_column)
    audit = audit_row(spark, mapping.described(), source, new_target, mapping.ts_column,
                      since, as_of, overlap_hours,
                      previous_max=read_source_max(state, mapping.state_keys()))
    new_state = upsert_state(state, audit, AUDIT_KEYS)
    return SyncResult(new_target, new_state, audit, changed, since, changes)


def with_ts(df: DataFrame, key: str, epoch: _dt.datetime = params.DIM_EPOCH,
            name: str = "updated_at") -> DataFrame:
    """Fixture: give a table without a change timestamp one (epoch + up to 3649 days by key)."""
    from ambry.functions import ts_lit
    return df.withColumn(name, ts_lit(epoch) + F.make_dt_interval((F.col(key) % params.DIM_DAYS).cast("int")))


def standard_mappings() -> list[tuple[str, TableMapping]]:
    """The seven bronze mappings used on the test tables (FIXTURES.md §3)."""
    return [
        ("orders", TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")),
        ("lineitem", TableMapping("lineitem", "lineitem", ["l_orderkey", "l_linenumber"], "l_shipdate")),
        ("events", TableMapping("events", "events", ["event_id"], "ts")),
        ("customer", TableMapping("customer", "customer", ["c_custkey"])),
        ("supplier", TableMapping("supplier", "supplier", ["s_suppkey"])),
        ("part", TableMapping("part", "part", ["p_partkey"])),
        ("nation", TableMapping("nation", "nation", ["n_nationkey"])),
    ]


def order_lines(lineitem: DataFrame) -> DataFrame:
    """Fixture: lineitem with its key made unique, one row per (order, line)."""
    return lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum(F.col("l_quantity").cast("long")).alias("l_quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).cast("decimal(18,2)").alias("l_extendedprice"),
        F.max("l_shipdate").alias("l_shipdate"))


def mapping_source(tables, name: str, mapping: TableMapping) -> DataFrame:
    df = getattr(tables, name)
    if name == "lineitem":
        df = order_lines(df)
    if mapping.ts_column == "updated_at" and "updated_at" not in df.columns:
        df = with_ts(df, mapping.pk[0])
    return df
