"""P5 and P6 kept up to date instead of recomputed: order items over a trailing window from day
partials, product ratings from mergeable sums and counts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambry import params
from ambry.functions import is_true, ts_lit
from ambry.operators.contracts import apply_contract
from ambry.operators.deltas import SIGN, Fact, net
from ambry.operators.materialize import broadcast_if_small
from ambry.operators.skew import skew_safe_join
from ambry.operators.sliding import SlidingWindow
from ambry.plans.scoring import CUSTOMER_REVIEW, ORDER_ITEMS

ITEMS = Fact("order_items", lambda rows: rows.withColumn("product_id", F.col("product_id").cast("int")), ("product_id",),
             {"gmv": (lambda: F.coalesce(F.col("price") * F.col("quantity"), F.lit(0)), "decimal(18,2)"),
              "order_item_count": (lambda: F.coalesce(F.col("quantity"), F.lit(0)), "bigint")}, "n")

#: ``rated``: reviews with a rating; the mean's count takes the unrated ones, too.
REVIEWS = Fact("reviews", lambda rows: rows.where(is_true("is_accepted")).withColumn("product_id", F.col("product_id").cast("int")),
               ("product_id",), {"rating_sum": (lambda: F.coalesce(F.col("rating"), F.lit(0)), "decimal(18,2)"),
                                 "rated": (lambda: F.when(F.col("rating").isNotNull(), 1).otherwise(0), "bigint")}, "n")


def counted_ids(orders: DataFrame, *more: str) -> DataFrame:
    """Ids of the orders whose items count."""
    return orders.where(F.col("package_status_id") != params.EXCLUDED_PACKAGE_STATUS).select(F.col("id").alias("order_id"), *more)


def counted_changes(item_changes: DataFrame, orders: DataFrame, order_changes: DataFrame, old_items: DataFrame) -> DataFrame:
    """The signed change of "items whose order counts" from the signed changes of both sides:

        changed items ⋉ orders that count now   ∪   items as they were ⋈ orders that came to count or ceased to

    ``old_items`` (restricted to the window) are read only for the orders whose status turned.
    """
    turned = net(counted_ids(order_changes, SIGN))
    turned, few = broadcast_if_small(turned.withColumnRenamed(SIGN, "__turned"), "turned-orders")
    referenced, small = broadcast_if_small(item_changes.select("order_id").distinct(), "changed-item-orders")
    good = counted_ids(orders).join(referenced, "order_id", "left_semi")
    if small:   # at most as many as referenced ones
        now = item_changes.join(F.broadcast(good), "order_id", "left_semi")
    else:
        now = skew_safe_join(item_changes, good, ["order_id"], "left_semi")
    join = old_items.join(turned, "order_id") if few else skew_safe_join(old_items, turned, ["order_id"], "inner")
    return now.unionByName(join.withColumn(SIGN, F.col("__turned")).drop("__turned").select(*now.columns))


def sliding_order_items(spark: SparkSession, root: str, run: int, as_of: _dt.datetime, changes: DataFrame,
                        items: DataFrame | None = None, window_days: int = params.ORDER_WINDOW_DAYS) -> DataFrame:
    """P6 at ``as_of`` from the signed changes since the last run; ``items`` (those that count) are
    needed only where the window starts within a day, for the rest of that day."""
    since = as_of - _dt.timedelta(days=window_days)
    window = SlidingWindow(spark, root, ITEMS, "created_at")
    totals = window.slide(run, since, changes, (lambda a, b: items.where(F.col("created_at").between(ts_lit(a), ts_lit(b)))) if items is not None else None)
    out = totals.drop("n").withColumn("updated_at", ts_lit(as_of))
    return apply_contract(out, ORDER_ITEMS, "stg.order_items", keys=("product_id",))


def mean_ratings(stored: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """P5 from the stored sums and counts; a product none of whose reviews has a rating has the mean 0."""
    mean = F.col("rating_sum").cast("decimal(28,10)") / F.col("n").cast("decimal(20,0)")   # a stored key has rows
    out = stored.select("product_id", mean.alias("product_rating")).withColumn("updated_at", ts_lit(as_of))
    return apply_contract(out, CUSTOMER_REVIEW, "stg.customer_review", keys=("product_id",))
