"""Silver kept up to date from the change feeds of bronze tables.

The definitions are those of ``plans/warehouse`` (ours, FIXTURES.md §4).  Facts that
aggregate are sums and counts of signed rows (``operators/deltas``); dimensions and
facts of one row per key take the images before and after by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambry.operators.deltas import SIGN, Fact, net, split_by_keys
from ambry.operators.materialize import materialize
from ambry.plans.warehouse import AMOUNT, payment_rows
from ambry.sources import proxies
from ambry.sources.tables import Frames


def _int(c: str) -> Callable[[], Column]:
    return lambda: F.col(c).cast("long")


def _money(c: str, when: str | None = None) -> Callable[[], Column]:
    def amount() -> Column:
        v = F.col(c).cast("decimal(12,2)")
        return v if when is None else F.when(F.expr(when), v).otherwise(F.lit(0).cast("decimal(12,2)"))
    return amount


def _star(tables) -> Callable[[DataFrame], DataFrame]:
    return lambda orders: proxies.star_rows(tables, orders, SIGN).withColumn("day", F.to_date("timestamp_at"))


def facts(tables) -> dict[str, Fact]:
    """The maintained facts; ``tables`` gives the dimension tables that the star rows refer to.

    Order lines come as single lines or, from bronze, added up per (order, line) with ``n_items``.
    """
    delivered = (lambda: F.when(F.col("delivery_status_id") == 1, 1).otherwise(0), "bigint")
    lines = lambda rows: rows if "n_items" in rows.columns else rows.withColumn("n_items", F.lit(1))
    price = lambda: F.col("l_extendedprice").cast("decimal(18,2)")
    return {
        "order_invoice_transaction": Fact(
            "lineitem", lines, ("l_orderkey", "l_linenumber"), {"amount": (price, AMOUNT)}, "line_count", _int("n_items")),
        "business_stats": Fact(
            "orders", _star(tables), ("from_business_id", "day"), {"delivered": delivered}, "orders"),
        "daily_orders_summary": Fact(
            "orders", lambda rows: rows.withColumn("day", F.to_date("o_orderdate")), ("day",),
            {"amount": (_money("o_totalprice"), AMOUNT)}, "orders", distinct={"businesses": "o_custkey"}),
        "order_invoice": Fact(
            "lineitem", lines, ("l_orderkey",), {"quantity": (_int("l_quantity"), "bigint"), "gross_amount": (price, AMOUNT)},
            "line_count", _int("n_items")),
        "payment_invoice": Fact(
            "orders", lambda rows: rows, ("o_custkey",),
            {"paid_amount": (_money("o_totalprice", "o_orderstatus = 'F'"), AMOUNT),
             "unpaid_amount": (_money("o_totalprice", "NOT coalesce(o_orderstatus = 'F', false)"), AMOUNT)},
            "orders", hidden=("orders",)),
        "hub_performance": Fact(
            "orders", _star(tables), ("delivery_hub_id", "day"), {"delivered": delivered}, "orders",
            derived={"delivered_bp": "(delivered * 10000) div orders"}),
    }


def statuses(tables) -> Fact:
    """The delivery statuses that occur, with the number of orders that have them."""
    return Fact("orders", _star(tables), ("delivery_status_id",), {}, "orders")


#: Dimensions and facts of one row per key: bronze table, key, and how signed source rows become theirs.
Keyed = tuple[str, str, Callable[[DataFrame], DataFrame]]


def keyed(tables) -> dict[str, Keyed]:
    def of(table: str, make) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: make(Frames(rows.sparkSession, {table: rows}), SIGN)

    return {
        "payment_invoice_transaction": ("orders", "o_orderkey", lambda rows: payment_rows(rows, SIGN)),
        "fact_order_status": ("orders", "id", lambda rows: proxies.star_rows(tables, rows, SIGN)),
        "dim_business": ("customer", "business_id", of("customer", proxies.dim_business)),
        "dim_store": ("supplier", "store_id", of("supplier", proxies.dim_store)),
        "dim_agent": ("supplier", "agent_id", of("supplier", proxies.dim_agent)),
        "dim_hub": ("nation", "hub_id", of("nation", proxies.dim_hub)),
        "dim_order": ("orders", "order_id", of("orders", proxies.dim_order)),
    }


def refresh_keyed(name: str, how: Keyed, stored: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The table after ``changes``: keys of any image go, the images after come."""
    _, key, rows = how
    images = rows(changes)
    if stored is None:
        return images.drop(SIGN)
    images = materialize(net(images), f"images-{name}")
    kept, _ = split_by_keys(stored, images, (key,), name)
    return kept.unionByName(images.where(F.col(SIGN) > 0).drop(SIGN))
