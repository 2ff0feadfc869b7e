"""Signed deltas: maintained facts equal a full recompute; feeds hold what changed and nothing else."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ambry.operators.deltas import SIGN, Fact, maintain, net, signed, version_changes
from ambry.plans.jobs import CHANGES, run_silver, run_sync, sync_state
from ambry.plans.sync import TableMapping
from ambry.sources.tables import Frames, Tables

SF = "/root/testdata/sf0.001"
SCHEMA = "id int, shop int, day int, buyer int, price decimal(10,2)"
FACT = Fact("sales", lambda rows: rows, ("shop", "day"), {"amount": (lambda: F.col("price"), "decimal(18,2)")}, "n", distinct={"buyers": "buyer"})


def full(rows):
    out = {}
    for _, shop, day, buyer, price in rows:
        n, amount, buyers = out.setdefault((shop, day), [0, 0, set()])
        out[shop, day] = [n + 1, amount + (price or 0), buyers | ({buyer} - {None})]
    return sorted(((s, d, n, a, len(b)) for (s, d), (n, a, b) in out.items()), key=str)


def stored_rows(df):
    return sorted(((r.shop, r.day, r.n, float(r.amount or 0), r.buyers) for r in df.collect()), key=str)


def test_random_histories_equal_full_recompute(spark):
    """Rows that come, move between keys, lose or get a NULL key, repeat and vanish, over several runs."""
    rng = random.Random(3)
    row = lambda i: (i, rng.choice([1, 2, 3, None]), rng.choice([1, 2, None]), rng.choice([7, 8, None]), Decimal(rng.choice([1, 2, 5])))
    old, stored = [], {}
    for run in range(4):
        new = [r for r in old if rng.random() > 0.2]
        new = [row(r[0]) if rng.random() < 0.3 else r for r in new] + [row(100 * run + i) for i in range(25)]
        if run == 3:
            new = [r for r in new if r[1] != 2]    # a whole key vanishes
        a, b = (spark.createDataFrame(x, SCHEMA) for x in (old, new))
        changes = version_changes(a, b, a.columns)
        if run:
            assert changes.agg(F.sum(F.abs(SIGN))).first()[0] < len(old) + len(new)
        out = maintain(FACT, "sales", stored, changes if run else signed(b, 1))
        stored = {k: spark.createDataFrame(df.collect(), df.schema) for k, df in out.items()}
        assert [(s, d, n, float(a), b) for s, d, n, a, b in full(new)] == stored_rows(stored["sales"]), run
        old = new
    everything = spark.createDataFrame(old, SCHEMA)
    assert maintain(FACT, "sales", stored, signed(everything, -1))["sales"].count() == 0


def test_more_taken_off_than_counted_fails(spark):
    one = spark.createDataFrame([(1, 1, 1, 1, Decimal(2))], SCHEMA)
    stored = maintain(FACT, "sales", {}, signed(one, 1))
    with pytest.raises(Exception, match="more rows taken off"):
        maintain(FACT, "sales", stored, signed(one.union(one), -1))["sales"].collect()


def test_net_cancels_equal_images(spark):
    one = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    both = signed(one, 1).unionByName(signed(one.where("a = 1").limit(1), -1))
    assert sorted(map(tuple, net(both).collect()), key=str) == [(1, None, 1), (2, "x", 1)]


def _at(day):
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def test_sync_feeds_changes_and_skips_the_unchanged(spark, tmp_path):
    store, m = str(tmp_path), TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    orders = Tables(spark, SF).orders
    first, _ = run_sync(spark, orders, m, store, 0, dt.datetime(2001, 1, 1))
    # the overlap reads rows again that didn't change: no version, no changes
    again, audit = run_sync(spark, orders, m, store, 1, dt.datetime(2001, 8, 3))
    assert again == first and sync_state(spark, audit).first().status == "SUCCESS"
    assert not (tmp_path / f"bronze.orders{CHANGES}").exists()
    moved = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") == 5, 149).otherwise(F.col("o_custkey"))) \
        .withColumn("o_orderdate", F.when(F.col("o_orderkey") == 5, _at("2002-01-01")).otherwise(F.col("o_orderdate")))
    extra = moved.where("o_orderkey = 7").withColumn("o_orderkey", F.lit(10**6).cast("long")).withColumn("o_orderdate", _at("2002-01-02"))
    path, _ = run_sync(spark, moved.unionByName(extra), m, store, 2, dt.datetime(2002, 2, 1))
    assert path != first and spark.read.parquet(path).count() == orders.count() + 1
    feed = spark.read.parquet(f"{store}/bronze.orders{CHANGES}/v000002")
    assert sorted((r.o_orderkey, r[SIGN]) for r in feed.collect()) == [(5, -1), (5, 1), (10**6, 1)]


def test_silver_reads_only_changes(spark, tmp_path):
    """With the unchanged bronze rows out of reach, a later run still brings silver up to date."""
    store = str(tmp_path)
    t = Tables(spark, SF)
    keys = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "nation": ["n_nationkey"], "lineitem": ["l_orderkey", "l_linenumber"]}
    from ambry.plans.sync import mapping_source, standard_mappings
    mappings = dict(standard_mappings())
    for n in keys:
        run_sync(spark, mapping_source(t, n, mappings[n]), mappings[n], f"{store}/{n}", 0, dt.datetime(2001, 8, 2))
    bronze = Frames(spark, {n: spark.read.parquet(f"{store}/{n}/bronze.{n}/v000000") for n in keys})
    first = run_silver(spark, bronze, store, 0)
    moved = t.orders.where("o_orderkey % 50 = 0").withColumn("o_custkey", F.lit(3).cast("long")).withColumn("o_orderdate", _at("2002-01-01"))
    run_sync(spark, t.orders.where("o_orderkey % 50 <> 0").unionByName(moved), mappings["orders"], f"{store}/orders", 1, dt.datetime(2002, 2, 1))
    blind = Frames(spark, {**bronze.frames, "orders": bronze.orders.where("raise_error('the unchanged source was read') IS NULL")})
    second = run_silver(spark, blind, store, 1)
    assert {n for n in second if second[n] == first[n]} == {"order_invoice_transaction", "order_invoice", "dim_business", "dim_store", "dim_agent", "dim_hub"}
    got = spark.read.parquet(second["daily_orders_summary"]).where("day = DATE'2002-01-01'").first()
    assert (got.orders, got.businesses) == (moved.count(), 1)
    new = spark.read.parquet(f"{store}/orders/bronze.orders/v000001")
    for n, query in (("business_stats", "SELECT o_custkey, to_date(o_orderdate), count(*), count_if(o_orderstatus = 'F') FROM o GROUP BY 1, 2"),
                     ("payment_invoice_transaction", "SELECT o_orderkey, to_date(o_orderdate), CAST(o_totalprice AS DECIMAL(12,2)), o_orderstatus = 'F', o_orderdate FROM o"),
                     ("dim_order", "SELECT o_orderkey, o_orderdate, o_custkey, o_orderpriority, o_orderdate FROM o")):
        want = spark.sql(query.replace("FROM o", "FROM {o}"), o=new)
        assert sorted(map(str, map(tuple, spark.read.parquet(second[n]).collect()))) == sorted(map(str, map(tuple, want.collect()))), n
