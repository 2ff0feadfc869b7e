"""Reference-shaped operational inputs derived from the given tables.

The reference reads operational PostgreSQL tables (products, reviews, order
items, campaigns, view counts).  These functions derive frames of the same
shape from the TPC-H-like test tables, row-for-row as FIXTURES.md §3 defines,
so that every job's work grows with the input.  All are lazy projections;
scalar subqueries (``DataFrame.scalar``) replace driver-side counts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambry import params
from ambry.functions import ts_lit
from ambry.sources.tables import Tables


def _count(df: DataFrame) -> F.Column:
    return df.select(F.count(F.lit(1))).scalar()


def _minus_days(t: _dt.datetime, days: F.Column) -> F.Column:
    return ts_lit(t) - F.make_dt_interval(days.cast("int"))


def src_product(t: Tables, as_of: _dt.datetime = params.AS_OF) -> DataFrame:
    p = F.col("p_partkey")
    return t.part.select(
        p.alias("id"),
        (p % _count(t.supplier.select("s_suppkey"))).cast("int").alias("seller_id"),
        F.col("p_size").cast("int").alias("category_id"),
        ((p * 37) % 130).cast("int").alias("total_stock_quantity"),
        F.when(p % 10 == 0, 2).otherwise(1).alias("approval_status_id"),
        F.when(p % 11 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_minus_days(as_of, p % 30)).alias("created_at"),
    )


def src_seller_review(t: Tables) -> DataFrame:
    return (t.lineitem.where(F.col("l_suppkey") % 7 != 0)
            .select(F.col("l_suppkey").cast("int").alias("seller_id"),
                    (1 + (F.col("l_orderkey") + F.col("l_linenumber")) % 5)
                    .cast("decimal(10,2)").alias("rating")))


def src_customer_review(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t.lineitem.select(
        F.col("l_partkey").alias("product_id"),
        (1 + F.col("l_orderkey") % 5).cast("decimal(10,2)").alias("rating"),
        F.when(flag == "A", True).when(flag == "R", False).alias("is_accepted"),
    )


def src_order_items(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_shipdate").alias("created_at"),
    )


def src_orders(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(s == "F", 23).when(s == "O", 1).alias("package_status_id"),
    )


def src_campaigns(t: Tables, as_of: _dt.datetime = params.AS_OF) -> DataFrame:
    k = F.col("n_nationkey")
    return t.nation.select(
        k.alias("id"),
        _minus_days(as_of, k).alias("start_date"),
        _minus_days(as_of, k - 10).alias("end_date"),
    )


def src_campaign_products(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    return (t.part.where(p % 3 == 0)
            .select(p.alias("product_id"), (p % 25).cast("int").alias("campaign_id")))


def src_product_views(t: Tables) -> DataFrame:
    """View counts per product; the reference receives these as a CSV file."""
    return (t.events.where(F.col("event_type") == "view")
            .groupBy(F.col("user_id").cast("int").alias("product_id"))
            .agg(F.count(F.lit(1)).cast("int").alias("view_count")))


def src_boosted(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    return t.part.where(p % 4 == 0).select(
        p.alias("product_id"),
        F.lit(0).cast("decimal(10,2)").alias("base_score"),
        ts_lit(params.DIM_EPOCH).alias("modified_at"),
    )


def algorithm_parameters(t: Tables, weights: dict | None = None) -> DataFrame:
    """The weight table (rank_parameter, weight_value decimal(10,2))."""
    w = weights if weights is not None else params.WEIGHTS
    rows = [(k, v) for k, v in w.items()]
    return (t.spark.createDataFrame(rows, "rank_parameter string, weight_value string")
            .select("rank_parameter", F.col("weight_value").cast("decimal(10,2)")))


# ------------------------------------------------------------ warehouse star
def star_fact(t: Tables) -> DataFrame:
    """Order-status fact rows on the star layout (FIXTURES.md §3 star_fact)."""
    return star_rows(t, t.orders)


def star_rows(t: Tables, orders: DataFrame, *more: str) -> DataFrame:
    """The star rows of some orders, with ``more`` of their columns; ``t`` gives the dimensions."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    n_cust = _count(t.customer.select("c_custkey"))
    n_supp = _count(t.supplier.select("s_suppkey"))
    s = F.col("o_orderstatus")
    return orders.select(
        k.alias("id"),
        F.col("o_orderdate").alias("timestamp_at"),
        k.alias("order_id"),
        c.alias("from_business_id"),
        ((c * 7 + 3) % n_cust).alias("to_business_id"),
        (k % n_supp).alias("from_store_id"),
        ((k + 1) % n_supp).alias("to_store_id"),
        (c % 25).cast("int").alias("pickup_hub_id"),
        (k % 25).cast("int").alias("delivery_hub_id"),
        F.lit(0).alias("billing_status_id"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(k % n_supp).alias("pickup_agent_id"),
        F.when(k % 9 == 0, F.lit(None)).otherwise((k + 5) % n_supp).alias("delivery_agent_id"),
        F.when(s == "F", 1).when(s == "O", 2).otherwise(3).alias("delivery_status_id"),
        F.col("o_orderdate").alias("updated_at"),
        *more,
    )


def _dim_ts(key: str) -> F.Column:
    return ts_lit(params.DIM_EPOCH) + F.make_dt_interval((F.col(key) % params.DIM_DAYS).cast("int"))


def dim_business(t: Tables, *more: str) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("business_id"),
                             F.col("c_name").alias("business_name"),
                             _dim_ts("c_custkey").alias("updated_at"), *more)


def dim_store(t: Tables, *more: str) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("store_id"),
                             F.col("s_name").alias("store_name"),
                             F.col("s_nationkey").alias("hub_id"),
                             _dim_ts("s_suppkey").alias("updated_at"), *more)


def dim_agent(t: Tables, *more: str) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("agent_id"),
                             F.col("s_name").alias("agent_name"),
                             F.col("s_nationkey").alias("hub_id"),
                             _dim_ts("s_suppkey").alias("updated_at"), *more)


def dim_hub(t: Tables, *more: str) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("hub_id"),
                           F.col("n_name").alias("hub_name"),
                           F.col("n_regionkey").alias("region_id"),
                           _dim_ts("n_nationkey").alias("updated_at"), *more)


def dim_order(t: Tables, *more: str) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("order_id"),
                           F.col("o_orderdate").alias("created_at"),
                           F.col("o_custkey").alias("customer_id"),
                           F.col("o_orderpriority").alias("priority"),
                           F.col("o_orderdate").alias("updated_at"), *more)


# Names of the delivery statuses (ours).
DELIVERY_STATUSES = [(1, "Delivered"), (2, "In transit"), (3, "Pending")]


def delivery_status(t: Tables) -> DataFrame:
    """The statuses that occur in the order facts, named."""
    return named_statuses(star_fact(t).select("delivery_status_id").distinct())


def named_statuses(ids: DataFrame) -> DataFrame:
    name = F.create_map(*[F.lit(x) for s in DELIVERY_STATUSES for x in s])
    return (ids
            .select("delivery_status_id", name[F.col("delivery_status_id")].alias("delivery_status_name"),
                    ts_lit(params.DIM_EPOCH).alias("updated_at")))
