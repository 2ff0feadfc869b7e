"""The scoring job end to end on the reference-shaped inputs.

``ScoringRun`` wires the stage extracts, product stats, category states and
scores for one ``as_of``; each attribute is lazy.  ``product_stats`` is the
one table read by several later steps (category averages, seller averages,
the score join), so ``materialized=True`` writes it once into the shared
checkpoint folder instead of recomputing its six-way lineage per reader.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambry import params
from ambry.functions import ts_lit
from ambry.operators.materialize import materialize
from ambry.plans import scoring
from ambry.sources import proxies
from ambry.sources.tables import Tables


#: The operational tables of the job, and how the test tables stand in for them.
SOURCES = {
    "products": proxies.src_product,                                # id, seller_id, category_id, total_stock_quantity, approval_status_id, created_at
    "seller_reviews": lambda t, _: proxies.src_seller_review(t),    # seller_id, rating
    "customer_reviews": lambda t, _: proxies.src_customer_review(t),  # product_id, rating, is_accepted
    "order_items": lambda t, _: proxies.src_order_items(t),         # order_id, product_id, price, quantity, created_at
    "orders": lambda t, _: proxies.src_orders(t),                   # id, package_status_id
    "campaigns": proxies.src_campaigns,                             # id, start_date, end_date
    "campaign_products": lambda t, _: proxies.src_campaign_products(t),  # product_id, campaign_id
    "product_views": lambda t, _: proxies.src_product_views(t),     # product_id, view_count
}


class ScoringRun:
    """``sources`` gives any of the operational tables (``SOURCES``) as frames of their columns."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: _dt.datetime = params.AS_OF,
                 window_days: int = params.ORDER_WINDOW_DAYS, weights: dict | None = None,
                 views: DataFrame | None = None, materialized: bool = False,
                 sources: dict[str, DataFrame] | None = None):
        self.t = Tables(spark, sf_dir)
        self.given = sources or {}
        if unknown := set(self.given) - set(SOURCES):
            raise ValueError(f"unknown sources {sorted(unknown)}; there are {sorted(SOURCES)}")
        self.as_of = as_of
        self.window_days = window_days
        self.weights = weights
        self._views = views
        self.materialized = materialized

    def source(self, name: str) -> DataFrame:
        """An operational table: the given one, else the one derived from the test tables."""
        return self.given[name] if name in self.given else SOURCES[name](self.t, self.as_of)

    # stage tables -----------------------------------------------------------
    @cached_property
    def product_info(self) -> DataFrame:
        return scoring.product_info(self.source("products"), self.as_of)

    @cached_property
    def seller_review(self) -> DataFrame:
        return scoring.seller_review(self.source("seller_reviews"), self.as_of)

    @cached_property
    def customer_review(self) -> DataFrame:
        return scoring.customer_review(self.source("customer_reviews"), self.as_of)

    @cached_property
    def order_items(self) -> DataFrame:
        return scoring.order_items(self.source("order_items"), self.source("orders"), self.as_of, self.window_days)

    @cached_property
    def deal_bowl(self) -> DataFrame:
        return scoring.deal_bowl(self.source("campaign_products"), self.source("campaigns"), self.as_of)

    @cached_property
    def product_views(self) -> DataFrame:
        v = self._views if self._views is not None else self.source("product_views")
        return scoring.product_views(v, self.as_of)

    # targets ----------------------------------------------------------------
    @cached_property
    def product_stats(self) -> DataFrame:
        df = scoring.product_stats(self.product_info, self.customer_review, self.seller_review,
                                   self.order_items, self.deal_bowl, self.product_views, self.as_of)
        return materialize(df, "product_stats") if self.materialized else df

    @cached_property
    def category_states(self) -> DataFrame:
        return scoring.category_states(self.product_stats, self.as_of)

    @cached_property
    def algorithm_parameters(self) -> DataFrame:
        return proxies.algorithm_parameters(self.t, self.weights)

    @cached_property
    def scores(self) -> DataFrame:
        """P11 output (product_id, category_id, unrounded score)."""
        return scoring.product_score(self.product_stats, self.category_states,
                                     self.algorithm_parameters)

    @cached_property
    def score_rows(self) -> DataFrame:
        return scoring.score_rows(self.scores, self.as_of)


def previous_scores(new_rows: DataFrame, src_product: DataFrame,
                    old_ts: _dt.datetime = params.OLD_SCORE_TS) -> DataFrame:
    """Fixture: the product_score table as a previous run left it.

    Products with id % 7 = 0 are missing (they get inserted); of the rest,
    id % 3 = 0 had a different score (updated), others the same score
    (untouched); unapproved products keep an old score of 0 (absent from the
    new offer, so kept).
    """
    k = F.col("product_id")
    scored = (new_rows.where(k % 7 != 0)
              .select(k, F.when(k % 3 == 0, F.col("score") + 1).otherwise(F.col("score"))
                      .cast("decimal(10,2)").alias("score"),
                      ts_lit(old_ts).alias("updated_at")))
    unapproved = (src_product.where((F.col("approval_status_id") != params.APPROVED_STATUS)
                                    & (F.col("id") % 7 != 0))
                  .select(F.col("id").cast("int").alias("product_id"),
                          F.lit(0).cast("decimal(10,2)").alias("score"),
                          ts_lit(old_ts).alias("updated_at")))
    return scored.unionByName(unapproved)
