"""Scoring expressions and stages: rounding, caps, buckets, NULL weights, semi joins."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ambry.functions import cap, exact_avg, guarded_ratio, stock_factor
from ambry.plans import scoring

AS_OF = dt.datetime(2001, 11, 5)


def test_exact_avg_does_not_double_round(spark):
    # 5001 x 1.23 and 5000 x 1.24: exact mean 1.234999.. -> 1.23 (narrow decimal gives 1.24)
    df = spark.range(10001).select(
        F.when(F.col("id") < 5001, F.lit(Decimal("1.23"))).otherwise(F.lit(Decimal("1.24")))
        .cast("decimal(10,2)").alias("x"))
    assert df.agg(F.round(exact_avg("x"), 2).cast("decimal(10,2)")).first()[0] == Decimal("1.23")


def test_round_half_up_negative(spark):
    df = spark.createDataFrame([(Decimal("-1.125"),)], "x decimal(10,3)")
    assert df.select(F.round("x", 2)).first()[0] == Decimal("-1.13")


def test_stock_buckets(spark):
    df = spark.createDataFrame([(v,) for v in [None, 0, 1, 10, 11, 50, 51, 100, 101]], "s int")
    got = [r[0] for r in df.select(stock_factor(F.col("s"))).collect()]
    assert got == [Decimal(x) for x in ["0", "0", "0.25", "0.25", "0.40", "0.40", "0.55", "0.55", "1.00"]]


def test_cap_keeps_null_and_boundary(spark):
    df = spark.createDataFrame([(Decimal("15"), Decimal("15")), (Decimal("16"), Decimal("15")),
                                (None, Decimal("15")), (Decimal("3"), None)], "p decimal(10,2), w decimal(10,2)")
    got = [r[0] for r in df.select(cap(F.col("p"), F.col("w"))).collect()]
    assert got == [Decimal("15"), Decimal("15"), None, Decimal("3")]


def test_guarded_ratio_zero_average(spark):
    df = spark.createDataFrame([(5, Decimal("0")), (5, Decimal("2.00")), (None, Decimal("2"))], "n int, d decimal(10,2)")
    got = [r[0] for r in df.select(guarded_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("0"), Decimal("2.50"), Decimal("0")]


def _stats(spark, rows):
    cols = ("product_id int, seller_id int, category_id int, product_rating decimal(10,2), "
            "seller_rating decimal(10,2), product_view_count int, gmv decimal(10,2), order_item_count int, "
            "stock_count int, is_new_product boolean, is_in_deal_bowl boolean, updated_at timestamp_ntz")
    return spark.createDataFrame([r + (AS_OF,) for r in rows], cols)


def _weights(spark, w):
    return spark.createDataFrame(list(w.items()), "rank_parameter string, weight_value string") \
        .select("rank_parameter", F.col("weight_value").cast("decimal(10,2)"))


FULL = {"Seller Rating": "10", "Stock Availability": "15", "GMV": "20", "Newly Added Product": "5",
        "Order Count": "15", "Product Rating": "15", "Deal Bowl Participation": "5", "CTR/Product View": "15"}


def test_score_parts_and_caps(spark):
    stats = _stats(spark, [
        (1, 1, 1, Decimal("4.00"), Decimal("3.00"), 10, Decimal("100.00"), 2, 101, True, True),
        (2, 1, 1, Decimal("2.00"), Decimal("3.00"), 30, Decimal("300.00"), 6, 0, False, False),
    ])
    cats = scoring.category_states(stats, AS_OF)
    assert [tuple(r)[1:5] for r in cats.collect()] == [(Decimal("3.00"), Decimal("20.00"), Decimal("200.00"), Decimal("4.00"))]
    sc = {r[0]: r[2] for r in scoring.product_score(stats, cats, _weights(spark, FULL)).collect()}
    # product 1: rating 4/3=1.33*15=19.95->cap 15; seller 3*10=30->cap 10; views .5*15=7.5;
    # gmv .5*20=10; orders .5*15=7.5; stock 1.0*15=15; new 5; deal 5 -> 75.0
    assert sc[1] == Decimal("75.0000")
    # product 2: rating .67*15=10.05; seller cap 10; views 1.5*15 -> cap 15; gmv 1.5*20 -> cap 20;
    # orders 1.5*15 -> cap 15; stock 0; new 0; deal 0 -> 70.05
    assert sc[2] == Decimal("70.0500")


def test_score_null_view_weight_is_null_other_missing_is_zero(spark):
    stats = _stats(spark, [(1, 1, 1, Decimal("4.00"), Decimal("3.00"), 10, Decimal("1.00"), 1, 5, False, False)])
    cats = scoring.category_states(stats, AS_OF)
    no_view = {k: v for k, v in FULL.items() if k != "CTR/Product View"}
    assert scoring.product_score(stats, cats, _weights(spark, no_view)).first()["score"] is None
    no_gmv = {k: v for k, v in FULL.items() if k != "GMV"}
    assert scoring.product_score(stats, cats, _weights(spark, no_gmv)).first()["score"] is not None


def test_order_items_semi_join_statuses(spark):
    items = spark.createDataFrame(
        [(1, 10, Decimal("1.50"), 2, AS_OF), (2, 10, Decimal("1.00"), 1, AS_OF), (3, 10, Decimal("9.00"), 1, AS_OF),
         (1, 11, Decimal("2.00"), 1, AS_OF - dt.timedelta(days=200))],
        "order_id long, product_id long, price decimal(10,2), quantity int, created_at timestamp_ntz")
    orders = spark.createDataFrame([(1, 1), (2, 23), (3, None)], "id long, package_status_id int")
    out = [tuple(r)[:3] for r in scoring.order_items(items, orders, AS_OF, 7).collect()]
    assert out == [(10, Decimal("3.00"), 2)]


def test_deal_bowl_inclusive_end_and_distinct(spark):
    cp = spark.createDataFrame([(5, 1), (5, 2), (6, 3)], "product_id long, campaign_id int")
    camps = spark.createDataFrame([(1, AS_OF - dt.timedelta(days=3), AS_OF), (2, AS_OF, AS_OF + dt.timedelta(days=1)),
                                   (3, AS_OF - dt.timedelta(days=9), AS_OF - dt.timedelta(days=1))],
                                  "id int, start_date timestamp_ntz, end_date timestamp_ntz")
    assert [r[0] for r in scoring.deal_bowl(cp, camps, AS_OF).collect()] == [5]


def test_customer_review_integer_rating_divides_like_integers(spark):
    src = spark.createDataFrame([(1, 4, True), (1, 5, True), (1, 1, False), (2, 3, None)],
                                "product_id long, rating int, is_accepted boolean")
    out = [tuple(r)[:2] for r in scoring.customer_review(src, AS_OF, integer_rating=True).collect()]
    assert out == [(1, Decimal("4.00"))]          # (4 + 5) div 2 = 4; rejected and NULL dropped
    dec = src.withColumn("rating", F.col("rating").cast("decimal(10,2)"))
    assert [tuple(r)[:2] for r in scoring.customer_review(dec, AS_OF).collect()] == [(1, Decimal("4.50"))]
