"""Existing-target fixtures for the incremental jobs (FIXTURES.md §3).

An incremental job needs a "previous state": the bronze table and the audit
row a previous run left.  These are derived from the given tables, so they
grow with them; the small audit rows are the metadata a previous run wrote.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambry import params
from ambry.functions import ts_lit
from ambry.operators.state import AUDIT_SCHEMA


def bronze_orders(orders: DataFrame, until: _dt.datetime = params.BRONZE_TARGET_UNTIL,
                  drop: list[str] | None = None) -> DataFrame:
    """Bronze orders as of an earlier load: rows up to ``until``, with a stale
    price (0) on every fifth order, optionally missing some columns."""
    k = F.col("o_orderkey")
    df = (orders.where(F.col("o_orderdate") <= ts_lit(until))
          .withColumn("o_totalprice", F.when(k % 5 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice"))))
    return df.drop(*(drop or []))


def order_versions(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders as two runs saw them: since the first, rows newer than the watermark came, half of them
    from another business, day and price; some rows vanished, and some businesses are NULL in either."""
    k, late = F.col("o_orderkey"), F.col("o_orderdate") > ts_lit(params.SILVER_WATERMARK)
    new = orders.where(k % 19 != 3).withColumn("o_custkey", F.when(k % 17 != 0, F.col("o_custkey")))
    old = orders.where(~late | (k % 2 == 0)).withColumns({
        "o_custkey": F.when(k % 34 != 0, F.when(late, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))),
        "o_orderdate": F.when(late, F.col("o_orderdate") - F.expr("INTERVAL 100 DAYS")).otherwise(F.col("o_orderdate")),
        "o_orderstatus": F.when(late & (k % 4 == 0), "P").otherwise(F.col("o_orderstatus")),
        "o_totalprice": F.when(late & (k % 6 == 0), F.lit(1.25)).otherwise(F.col("o_totalprice"))})
    return old, new


def line_versions(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Order lines as two runs saw them: some moved to another order, changed or vanished, and NULL orders."""
    k, late = F.col("l_orderkey"), F.col("l_shipdate") > ts_lit(params.SILVER_WATERMARK)
    new = lineitem.where(k % 23 != 5).withColumn("l_orderkey", F.when(k % 13 != 0, k))
    old = lineitem.where(~late | (k % 2 == 0)).withColumns({
        "l_orderkey": F.when(k % 26 != 0, F.when(late, k + 1).otherwise(k)),
        "l_extendedprice": F.when(late & (k % 4 == 0), F.lit(2.5)).otherwise(F.col("l_extendedprice"))})
    return old, new


def drifted_orders(orders: DataFrame) -> DataFrame:
    """Bronze orders that drifted from their source in every fifth key range: changed, missing and extra rows."""
    k = F.col("o_orderkey")
    here = F.floor(k / F.lit(params.DRIFT_KEY_RANGE)) % 5 == 2
    kept = (orders.where(~here | (k % 41 != 5))
            .withColumn("o_totalprice", F.when(here & (k % 37 == 3), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))))
    return kept.unionByName(orders.where(here & (k % 53 == 7)).withColumn("o_orderkey", -k - 1))


#: A catalog's description of the raw orders.
RAW_ORDERS_CATALOG = [
    {"column_name": "o_orderkey", "data_type": "bigint", "column_default": "nextval('orders_seq')", "is_nullable": "NO"},
    {"column_name": "o_custkey", "data_type": "integer", "is_nullable": "NO"},
    {"column_name": "o_orderstatus", "data_type": "character varying", "character_maximum_length": 1, "is_nullable": "YES"},
    {"column_name": "o_totalprice", "data_type": "numeric", "numeric_precision": 12, "numeric_scale": 2, "is_nullable": "YES"},
    {"column_name": "o_orderdate", "data_type": "timestamp without time zone", "is_nullable": "NO"},
    {"column_name": "urgent", "data_type": "boolean", "is_nullable": "YES"},
    {"column_name": "detail", "data_type": "jsonb", "is_nullable": "YES"}]


def raw_orders(orders: DataFrame) -> DataFrame:
    """Orders as text, as a source without types gives them, some values of which don't fit."""
    k, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    return orders.select(
        text("o_orderkey").alias("o_orderkey"),
        F.when(k % 23 != 0, text("o_custkey")).alias("o_custkey"),
        F.when(k % 19 == 0, F.lit("XX")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(k % 13 == 0, F.lit("n/a")).when(k % 13 == 1, F.lit("12345678901.5")).when(k % 13 == 2, F.lit(None))
         .otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.lit(" "))).alias("o_totalprice"),
        F.when(k % 17 == 0, F.lit("yesterday")).otherwise(text("o_orderdate")).alias("o_orderdate"),
        F.when(k % 3 == 0, F.lit("true")).when(k % 3 == 1, F.lit("false")).alias("urgent"),
        F.when(k % 29 == 0, F.lit("{broken")).when(k % 2 == 0, F.concat(F.lit('{"priority":"'), F.col("o_orderpriority"), F.lit('"}'))).alias("detail"))


def nested_events(events: DataFrame) -> DataFrame:
    """Events with a struct, a map and an array column."""
    e, u = F.col("event_id"), F.col("user_id")
    return events.select(
        "event_id", "ts", F.struct(u.alias("user"), F.col("event_type").alias("kind"), F.when(e % 3 == 0, e % 100).alias("code")).alias("who"),
        F.create_map(F.lit("kind"), F.col("event_type"), F.lit("bucket"), (u % 7).cast("string")).alias("props"),
        F.when(e % 5 != 0, F.array(e % 10, u % 10)).alias("path"))


def audit_state(spark: SparkSession, last_synced_at: _dt.datetime = params.BRONZE_WATERMARK) -> DataFrame:
    """Audit table with the orders watermark (keys in other case) and one
    unrelated row that must survive the upsert."""
    def row(db: str, schema: str, table: str, pk: str) -> tuple:
        return (f"{schema}.{table}", 1, "ops", "source", "public", table, "wh", db, schema, table, pk, "updated_at",
                last_synced_at, last_synced_at, 0, 0, "SUCCESS", None, last_synced_at)

    rows = [row("DW", "Bronze", "ORDERS", "o_orderkey"), row("dw", "bronze", "customer", "c_custkey")]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)
