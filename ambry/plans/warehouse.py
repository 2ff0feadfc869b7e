"""Silver dimensions and facts, gold snapshots.

The reference calls stored functions and refreshes materialized views whose
bodies are not in its repository; the definitions here are ours, designed
from the function names and the star schema (FIXTURES.md §4), and labelled
as such.  Silver facts are incremental (touched-key refresh from a
watermark); gold snapshots are full recomputes written as new versions.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambry import params
from ambry.functions import days_before, ts_lit
from ambry.operators.incremental import as_of_watermark, refresh_touched
from ambry.operators.star import Role, star_join
from ambry.operators.upsert import upsert
from ambry.sources import proxies
from ambry.sources.tables import Frames, Tables

AMOUNT = "decimal(18,2)"



# ------------------------------------------------------------ fact recipes
def order_lines_agg(rows: DataFrame) -> DataFrame:
    """S2 (ours): invoice transaction per (order, line)."""
    return (rows.groupBy("l_orderkey", "l_linenumber")
            .agg(F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).cast(AMOUNT).alias("amount"),
                 F.count(F.lit(1)).alias("line_count")))


def payment_rows(orders: DataFrame, *more: str) -> DataFrame:
    """S3 (ours): one payment transaction per order."""
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_day"),
                         F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
                         (F.col("o_orderstatus") == "F").alias("is_paid"),
                         F.col("o_orderdate").alias("updated_at"), *more)


def business_stats_agg(rows: DataFrame) -> DataFrame:
    """S5 (ours): per business and day, orders and delivered orders."""
    return (rows.groupBy("from_business_id", "day")
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.count_if(F.col("delivery_status_id") == 1).alias("delivered")))


def daily_orders_agg(rows: DataFrame) -> DataFrame:
    """S6 (ours): per day, orders, distinct businesses and amount."""
    return (rows.groupBy("day")
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.count_distinct("o_custkey").alias("businesses"),
                 F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast(AMOUNT).alias("amount")))


def order_invoice_agg(rows: DataFrame) -> DataFrame:
    """S7 (ours): per order, line count, quantity and gross amount."""
    return (rows.groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("line_count"),
                 F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
                 F.sum(F.col("l_extendedprice").cast("decimal(10,2)")).cast(AMOUNT).alias("gross_amount")))


def payment_invoice_agg(rows: DataFrame) -> DataFrame:
    """S8 (ours): per customer, paid and unpaid amounts."""
    amt = F.col("o_totalprice").cast("decimal(12,2)")
    paid = F.col("o_orderstatus") == "F"
    zero = F.lit(0).cast("decimal(12,2)")
    return (rows.groupBy("o_custkey")
            .agg(F.sum(F.when(paid, amt).otherwise(zero)).cast(AMOUNT).alias("paid_amount"),
                 F.sum(F.when(paid, zero).otherwise(amt)).cast(AMOUNT).alias("unpaid_amount")))


def star_days(t: Tables) -> DataFrame:
    return proxies.star_fact(t).withColumn("day", F.to_date("timestamp_at"))


def hub_performance_agg(rows: DataFrame) -> DataFrame:
    """S9 (ours): per delivery hub and day, orders, delivered, share in bp."""
    g = (rows.groupBy("delivery_hub_id", "day")
         .agg(F.count(F.lit(1)).alias("orders"),
              F.count_if(F.col("delivery_status_id") == 1).alias("delivered")))
    return g.withColumn("delivered_bp", F.expr("(delivered * 10000) div orders"))


# ------------------------------------------------------------------ the run
SILVER_FACTS = ("order_invoice_transaction", "payment_invoice_transaction", "fact_order_status",
                "business_stats", "daily_orders_summary", "order_invoice", "payment_invoice",
                "hub_performance")
GOLD_SNAPSHOTS = ("business_totals", "daily_orders_snapshot", "agent_report", "daily_order_invoice",
                  "daily_payment_invoice", "order_global_report", "delivery_status_last_7days",
                  "delivery_aging_last_7days")


class Warehouse:
    """Silver and gold on the test tables for one ``as_of``.

    ``wm`` is the silver watermark, one value or one per fact name.
    ``previous`` maps fact names to the stored result of the previous run;
    a fact without one starts from the result a run at the watermark would
    have stored (the aggregate over rows up to the watermark).
    """

    def __init__(self, spark: SparkSession, sf_dir: str,
                 wm: _dt.datetime | dict = params.SILVER_WATERMARK,
                 as_of: _dt.datetime = params.ORDERS_AS_OF,
                 previous: dict[str, DataFrame] | None = None, tables: Frames | None = None):
        self.t = tables or Tables(spark, sf_dir)
        self._dims: dict[str, DataFrame] = {}
        self._wm = wm
        self.as_of = as_of
        self.previous = previous or {}

    def wm(self, name: str) -> _dt.datetime:
        return self._wm[name] if isinstance(self._wm, dict) else self._wm

    def use_silver(self, facts: dict[str, DataFrame]) -> "Warehouse":
        """Serve stored silver facts as-is (gold snapshots then read them
        instead of refreshing again)."""
        for name, df in facts.items():
            if name not in SILVER_FACTS:
                raise KeyError(name)
            self.__dict__[name] = df      # fills the cached_property
        return self

    def use_dims(self, dims: dict[str, DataFrame]) -> "Warehouse":
        """Serve stored dimensions as they are."""
        self._dims.update(dims)
        return self

    # S1 (ours): dims upserted from bronze into targets holding even keys ----
    def dim(self, name: str) -> DataFrame:
        if name in self._dims:
            return self._dims[name]
        src, key, label = {
            "business": (proxies.dim_business, "business_id", "business_name"),
            "store": (proxies.dim_store, "store_id", "store_name"),
            "agent": (proxies.dim_agent, "agent_id", "agent_name"),
            "hub": (proxies.dim_hub, "hub_id", "hub_name"),
            "order": (proxies.dim_order, "order_id", "priority"),
            "delivery_status": (proxies.delivery_status, "delivery_status_id", "delivery_status_name"),
        }[name]
        fresh = src(self.t)
        stale = (fresh.where(F.col(key) % 2 == 0)
                 .withColumn(label, F.concat(F.lit("old "), F.col(label))))
        return upsert(stale, fresh, [key], "updated_at")

    @cached_property
    def star(self) -> DataFrame:
        return proxies.star_fact(self.t)

    # silver facts -------------------------------------------------------------
    def _refresh(self, name: str, rows, keys: list[str], ts: str, agg) -> DataFrame:
        """``rows`` gives the keyed source from a set of tables."""
        wm, keyed = self.wm(name), rows(self.t)
        previous = self.previous.get(name)
        if previous is None:
            previous = as_of_watermark(keyed, ts, wm, agg)
        return refresh_touched(previous, keyed, keys, ts, wm, agg)

    def _upsert_newer(self, name: str, rows: DataFrame, key: str, ts: str) -> DataFrame:
        wm = ts_lit(self.wm(name))
        previous = self.previous.get(name)
        if previous is None:
            previous = rows.where(F.col(ts) <= wm)
        return upsert(previous, rows.where(F.col(ts) > wm), [key], ts)

    @cached_property
    def order_invoice_transaction(self) -> DataFrame:          # S2
        ids = ["l_orderkey", "l_linenumber"]
        return self._refresh("order_invoice_transaction", lambda t: t.lineitem, ids, "l_shipdate", order_lines_agg)

    @cached_property
    def payment_invoice_transaction(self) -> DataFrame:        # S3
        return self._upsert_newer("payment_invoice_transaction", payment_rows(self.t.orders),
                                  "o_orderkey", "updated_at")

    @cached_property
    def fact_order_status(self) -> DataFrame:                  # S4
        return self._upsert_newer("fact_order_status", self.star, "id", "updated_at")

    @cached_property
    def business_stats(self) -> DataFrame:                     # S5
        return self._refresh("business_stats", star_days, ["from_business_id", "day"], "updated_at", business_stats_agg)

    @cached_property
    def daily_orders_summary(self) -> DataFrame:               # S6
        return self._refresh("daily_orders_summary", lambda t: t.orders.withColumn("day", F.to_date("o_orderdate")), ["day"],
                             "o_orderdate", daily_orders_agg)

    @cached_property
    def order_invoice(self) -> DataFrame:                      # S7
        return self._refresh("order_invoice", lambda t: t.lineitem, ["l_orderkey"], "l_shipdate", order_invoice_agg)

    @cached_property
    def payment_invoice(self) -> DataFrame:                    # S8
        return self._refresh("payment_invoice", lambda t: t.orders, ["o_custkey"], "o_orderdate", payment_invoice_agg)

    @cached_property
    def hub_performance(self) -> DataFrame:                    # S9
        return self._refresh("hub_performance", star_days, ["delivery_hub_id", "day"], "updated_at", hub_performance_agg)

    # gold snapshots -----------------------------------------------------------
    @cached_property
    def business_totals(self) -> DataFrame:                    # G1
        return (self.business_stats.groupBy("from_business_id")
                .agg(F.sum("orders").alias("orders"), F.sum("delivered").alias("delivered")))

    @cached_property
    def daily_orders_snapshot(self) -> DataFrame:              # G2
        return self.daily_orders_summary

    @cached_property
    def agent_report(self) -> DataFrame:                       # G3
        roles = F.array(
            F.struct(F.col("pickup_agent_id").alias("agent_id"), F.lit("pickup").alias("role")),
            F.struct(F.col("delivery_agent_id").alias("agent_id"), F.lit("delivery").alias("role")))
        rows = (self.fact_order_status
                .select(F.inline(roles), "delivery_status_id")
                .where(F.col("agent_id").isNotNull()))
        return rows.groupBy("agent_id", "role", "delivery_status_id").agg(
            F.count(F.lit(1)).alias("orders"))

    @cached_property
    def daily_order_invoice(self) -> DataFrame:                # G4
        days = self.t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                                    F.to_date("o_orderdate").alias("day"))
        return (self.order_invoice.join(days, "l_orderkey")
                .groupBy("day").agg(F.sum("gross_amount").cast(AMOUNT).alias("gross_amount")))

    @cached_property
    def daily_payment_invoice(self) -> DataFrame:              # G5
        p = self.payment_invoice_transaction
        zero = F.lit(0).cast("decimal(12,2)")
        return (p.groupBy(F.col("order_day").alias("day"))
                .agg(F.sum(F.when(F.col("is_paid"), F.col("amount")).otherwise(zero)).cast(AMOUNT)
                     .alias("paid_amount"),
                     F.sum(F.when(F.col("is_paid"), zero).otherwise(F.col("amount"))).cast(AMOUNT)
                     .alias("unpaid_amount")))

    @cached_property
    def order_global_report(self) -> DataFrame:                # G6, C10
        dims = {n: self.dim(n) for n in ("business", "store", "agent", "hub", "order", "delivery_status")}
        roles = [
            Role("order_id", "order", "order_id", {"priority": "order_priority"}),
            Role("from_business_id", "business", "business_id", {"business_name": "from_business_name"}),
            Role("to_business_id", "business", "business_id", {"business_name": "to_business_name"}),
            Role("from_store_id", "store", "store_id", {"store_name": "from_store_name"}),
            Role("to_store_id", "store", "store_id", {"store_name": "to_store_name"}),
            Role("pickup_hub_id", "hub", "hub_id", {"hub_name": "pickup_hub_name"}),
            Role("delivery_hub_id", "hub", "hub_id", {"hub_name": "delivery_hub_name"}),
            Role("pickup_agent_id", "agent", "agent_id", {"agent_name": "pickup_agent_name"}, True),
            Role("delivery_agent_id", "agent", "agent_id", {"agent_name": "delivery_agent_name"}, True),
            Role("delivery_status_id", "delivery_status", "delivery_status_id",
                 {"delivery_status_name": "delivery_status_name"}),
        ]
        wide = star_join(self.fact_order_status, dims, roles, bounded=frozenset({"delivery_status"}))
        return wide.select("id", "timestamp_at", "order_priority", "from_business_name",
                           "to_business_name", "from_store_name", "to_store_name",
                           "pickup_hub_name", "delivery_hub_name", "pickup_agent_name",
                           "delivery_agent_name", "delivery_status_name")

    def _last_7_days(self) -> DataFrame:
        return self.fact_order_status.where(F.col("timestamp_at") >= days_before(self.as_of, 7))

    @cached_property
    def delivery_status_last_7days(self) -> DataFrame:         # G7
        return (self._last_7_days().groupBy(F.to_date("timestamp_at").alias("day"), "delivery_status_id")
                .agg(F.count(F.lit(1)).alias("orders")))

    @cached_property
    def delivery_aging_last_7days(self) -> DataFrame:          # G8
        age = F.datediff(F.to_date(ts_lit(self.as_of)), F.to_date("timestamp_at"))
        bucket = (F.when(age <= 1, "0-1").when(age <= 3, "2-3").when(age <= 7, "4-7"))
        return (self._last_7_days().where(F.col("delivery_status_id") != 1)
                .groupBy(bucket.alias("age_bucket")).agg(F.count(F.lit(1)).alias("orders")))
