"""Sliding windows from day partials equal the aggregate over the window, and read only what changed."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from ambry.functions import ts_lit
from ambry.operators.deltas import Fact, signed, version_changes
from ambry.operators.sliding import SlidingWindow

FACT = Fact("sales", lambda rows: rows, ("shop",), {"amount": (lambda: F.col("price"), "bigint")}, "n")
SCHEMA = "shop int, price int, at timestamp_ntz"
START = dt.datetime(2024, 3, 1)


def expected(rows, since):
    out = {}
    for shop, price, at in rows:
        if at >= since:
            n, s = out.get(shop, (0, 0))
            out[shop] = (n + 1, s + price)
    return out


def got(df):
    return {r.shop: (r.n, r.amount) for r in df.collect()}


def test_random_histories(spark, tmp_path):
    rng = random.Random(1)
    window = SlidingWindow(spark, str(tmp_path), FACT, "at")
    row = lambda lo, hi: (rng.choice([1, 2, 3, None]), rng.randrange(9), START + dt.timedelta(hours=rng.randrange(24 * lo, 24 * hi)))
    rows = [row(0, 20) for _ in range(150)]
    before = None
    for run, (day, hour) in enumerate([(5, 0), (8, 6), (8, 12), (15, 0), (13, 0)]):   # the last one goes back
        since = START + dt.timedelta(days=day, hours=hour)
        if before is not None:   # late rows, corrections, vanished rows, new ones
            rows = [r for r in rows if rng.random() > 0.1] + [row(0, 20) for _ in range(15)] + [row(19, 25) for _ in range(15)]
        now = spark.createDataFrame(rows, SCHEMA)
        changes = signed(now, 1) if before is None else version_changes(before, now, now.columns)
        edge = lambda a, b, now=now: now.where((F.col("at") >= ts_lit(a)) & (F.col("at") < ts_lit(b)))
        if run == 2:   # a run that failed half-way is repeated
            window.slide(run, since, changes, edge)
        assert got(window.slide(run, since, changes, edge)) == expected(rows, since), run
        if run == 2:
            # days in the window of the runs to come are kept by the compaction
            window.compact(run)
        before = spark.createDataFrame(now.collect(), SCHEMA)


def test_only_expired_days_are_read(spark, tmp_path):
    window = SlidingWindow(spark, str(tmp_path), FACT, "at")
    rows = [(i % 3, 1, START + dt.timedelta(hours=i)) for i in range(24 * 30)]
    window.slide(0, START, signed(spark.createDataFrame(rows, SCHEMA), 1))
    none = signed(spark.createDataFrame([], SCHEMA), 1)
    out = window.slide(1, START + dt.timedelta(days=2), none)
    assert sum(r.n for r in out.collect()) == 24 * 28
    schema = spark.read.parquet(f"{tmp_path}/days/run=0").select("shop", "n", "amount", "day").schema
    expired = window.partials(1, START.date(), START.date() + dt.timedelta(days=2), schema)
    assert "PartitionFilters: [isnotnull(day" in expired._jdf.queryExecution().executedPlan().toString()
    assert {f.rsplit("/", 2)[1] for f in expired.inputFiles() if "/day=" in f} >= {"day=2024-03-01", "day=2024-03-02"}
    assert sum(r.n for r in expired.collect()) == 48


def test_means_of_products_that_lose_their_last_rating(spark):
    """Reviews of a product may all be left without a rating: its mean is 0, as the SQL has it, and not an error."""
    from ambry.operators.deltas import maintain
    from ambry.plans.sliding_items import REVIEWS, mean_ratings
    schema = "product_id long, rating decimal(10,2), is_accepted boolean"
    old = spark.createDataFrame([(1, Decimal(4), True), (1, None, True), (2, Decimal(5), True), (3, None, True), (4, Decimal(1), True)], schema)
    new = spark.createDataFrame([(1, Decimal(4), True), (1, None, True), (2, None, True), (3, None, True), (4, Decimal(1), None)], schema)
    first = maintain(REVIEWS, "reviews", {}, signed(old, 1))
    now = maintain(REVIEWS, "reviews", first, version_changes(old, new, new.columns))
    means = lambda stored: {r.product_id: float(r.product_rating) for r in mean_ratings(stored["reviews"], START).collect()}
    assert means(first) == {1: 2.0, 2: 5.0, 3: 0.0, 4: 1.0} and means(now) == {1: 2.0, 2: 0.0, 3: 0.0}
