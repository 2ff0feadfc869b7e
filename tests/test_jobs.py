"""Scheduled runs: idempotency (SURVEY §5 (3)) and convergence ((4))."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from ambry import params
from ambry.plans.jobs import run_scoring, run_sync, sync_state
from ambry.plans.sync import TableMapping
from ambry.sources import proxies
from ambry.sources.tables import Tables

SF = "/root/testdata/sf0.001"


def _rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_scoring_rerun_keeps_updated_at(spark):
    store = tempfile.mkdtemp(prefix="ambry-store-")
    boosted = proxies.src_boosted(Tables(spark, SF))
    a = run_scoring(spark, SF, store, 0, params.AS_OF, boosted=boosted)
    b = run_scoring(spark, SF, store, 1, params.AS_OF)          # same inputs, same as_of
    s0 = _rows(spark.read.parquet(a.product_score), "product_id")
    s1 = _rows(spark.read.parquet(b.product_score), "product_id")
    assert s0 == s1 and all(r[2] == params.AS_OF for r in s1)   # no score changed: updated_at kept
    st = spark.read.parquet(b.publish_state).collect()
    assert [(r[0], r[1]) for r in st] == [("public.product_score", params.AS_OF + dt.timedelta(microseconds=1))]
    # scores are published after they are stamped: unchanged ones are sent once
    sent = [spark.read.schema("n_rows long").json(x.messages).agg(F.sum("n_rows")).first()[0] for x in (a, b)]
    assert sent == [len(s0), None]
    bo = spark.read.parquet(b.boosted_products)
    assert bo.count() == boosted.count() and bo.where(F.col("modified_at") == params.AS_OF).count() > 0
    # a later run with changed inputs bumps only the changed scores
    later = params.AS_OF + dt.timedelta(hours=3)
    c = run_scoring(spark, SF, store, 2, later)
    s2 = {r[0]: r for r in _rows(spark.read.parquet(c.product_score), "product_id")}
    for pid, score, ts in s1:
        assert (s2[pid][2] == later) == (s2[pid][1] != score)


def test_sync_in_slices_equals_full_load(spark):
    orders = Tables(spark, SF).orders
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    store = tempfile.mkdtemp(prefix="ambry-sync-")
    # three runs; each run sees the rows stamped up to its run time, and its
    # watermark becomes the run time - 6 h
    cuts = [dt.datetime(1995, 1, 1), dt.datetime(1999, 1, 1), dt.datetime(2003, 1, 1)]
    for i, cut in enumerate(cuts):
        src = orders.where(F.col("o_orderdate") <= F.lit(cut.isoformat(" ")).cast("timestamp_ntz"))
        tpath, spath = run_sync(spark, src, m, store, i, cut)
    assert _rows(spark.read.parquet(tpath), "o_orderkey") == _rows(orders, "o_orderkey")
    # same run again: idempotent
    tpath2, _ = run_sync(spark, orders, m, store, 3, cuts[-1] + dt.timedelta(hours=7))
    assert _rows(spark.read.parquet(tpath2), "o_orderkey") == _rows(orders, "o_orderkey")
    audit = sync_state(spark, spath).collect()
    assert len(audit) == 1 and audit[0]["status"] == "SUCCESS"


def test_sync_goes_on_after_a_failed_run(spark):
    orders = Tables(spark, SF).orders
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    store = tempfile.mkdtemp(prefix="ambry-fail-")
    run_sync(spark, orders.where("o_orderkey < 50"), m, store, 0, dt.datetime(1990, 1, 1))
    bad = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") != 60, F.col("o_orderkey")))
    with pytest.raises(Exception, match="NOT NULL violated"):
        run_sync(spark, bad, m, store, 1, dt.datetime(2002, 1, 1))
    failed = sync_state(spark, f"{store}/_log").collect()
    assert [r["status"] for r in failed] == ["FAILED"]
    tpath, spath = run_sync(spark, orders, m, store, 2, dt.datetime(2002, 1, 1))
    assert _rows(spark.read.parquet(tpath), "o_orderkey") == _rows(orders, "o_orderkey")
    assert [r["status"] for r in sync_state(spark, spath).collect()] == ["SUCCESS"]


def test_warehouse_refreshes_keys_that_lost_rows(spark):
    from ambry.cli import main
    from ambry.plans.warehouse import Warehouse
    import os
    new, store = tempfile.mkdtemp(prefix="ambry-moved-"), tempfile.mkdtemp(prefix="ambry-wh-")
    for name in os.listdir(SF):
        if name != "orders.parquet":
            os.symlink(f"{SF}/{name}", f"{new}/{name}")
    # after the first run, every seventh order moves to another customer and day
    moved, at = F.col("o_orderkey") % 7 == 0, F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")
    (Tables(spark, SF).orders.withColumn("o_custkey", F.when(moved, (F.col("o_custkey") + 1) % 150).otherwise(F.col("o_custkey")))
     .withColumn("o_orderdate", F.when(moved, at).otherwise(F.col("o_orderdate"))).write.parquet(f"{new}/orders.parquet"))
    run = lambda folder, n, at: main(["warehouse", "--sf-dir", folder, "--store", store, "--run-id", n, "--as-of", at])
    run(SF, "0", "2001-12-01T00:00:00")
    out = run(new, "1", "2002-02-01T00:00:00")
    full = Warehouse(spark, new, wm=dt.datetime(1900, 1, 1))
    for name in ("business_stats", "daily_orders_summary", "payment_invoice", "payment_invoice_transaction", "fact_order_status",
                 "order_global_report", "daily_orders_snapshot", "business_totals", "hub_performance"):
        exp = getattr(full, name)
        got = spark.read.parquet(out[name]).select(*exp.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, exp.collect())), name


def test_warehouse_runs_converge_to_full_recompute(spark):
    from ambry.plans.jobs import run_warehouse
    from ambry.plans.warehouse import Warehouse
    store = tempfile.mkdtemp(prefix="ambry-wh-")
    run_warehouse(spark, SF, store, 0, dt.datetime(1999, 1, 1))
    out = run_warehouse(spark, SF, store, 1, params.ORDERS_AS_OF)
    # a single Warehouse over all rows from an early watermark = full recompute
    full = Warehouse(spark, SF, wm=dt.datetime(1900, 1, 1))
    for name in ("business_stats", "daily_orders_summary", "payment_invoice", "fact_order_status",
                 "agent_report", "order_global_report"):
        got = spark.read.parquet(out[name])
        exp = getattr(full, name)
        assert sorted(map(tuple, got.select(*exp.columns).collect())) == sorted(map(tuple, exp.collect())), name
    st = spark.read.parquet(out["_silver_state"]).collect()
    assert len(st) == 8 and all(r["last_synced_at"] == params.ORDERS_AS_OF - dt.timedelta(hours=6) for r in st)


def test_cli_sync_and_score(spark):
    from ambry.cli import main
    store = tempfile.mkdtemp(prefix="ambry-cli-")
    out = main(["sync", "--sf-dir", SF, "--store", store, "--run-id", "0", "--as-of", "2001-08-02T00:00:00",
                "--tables", "orders,nation"])
    assert set(out) == {"orders", "nation"}
    assert spark.read.parquet(out["orders"][0]).count() == Tables(spark, SF).orders.count()
    out = main(["score", "--sf-dir", SF, "--store", store, "--run-id", "0"])
    assert spark.read.parquet(out["product_score"]).count() > 0


def test_run_sync_all_parallel(spark):
    from ambry.plans.jobs import run_sync_all
    from ambry.plans.sync import mapping_source, standard_mappings
    t = Tables(spark, SF)
    store = tempfile.mkdtemp(prefix="ambry-syncall-")
    sources = {n: (mapping_source(t, n, m), m) for n, m in standard_mappings()}
    out = run_sync_all(spark, sources, store, 0, params.ORDERS_AS_OF, parallelism=4)
    assert set(out) == set(sources)
    assert spark.read.parquet(out["nation"][0]).count() == 25
    li = t.lineitem.select("l_orderkey", "l_linenumber").distinct().count()
    assert spark.read.parquet(out["lineitem"][0]).count() == li


def test_ranged_sync_in_slices_equals_full_load(spark):
    from ambry.operators.ranges import read_ranged
    from ambry.plans.jobs import run_sync_ranged
    orders = Tables(spark, SF).orders
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    store = tempfile.mkdtemp(prefix="ambry-ranged-sync-")
    cuts = [dt.datetime(1995, 1, 1), dt.datetime(1999, 1, 1), dt.datetime(2003, 1, 1)]
    for i, cut in enumerate(cuts):
        src = orders.where(F.col("o_orderdate") <= F.lit(cut.isoformat(" ")).cast("timestamp_ntz"))
        if i == 2:   # a new source column arrives with the last slice
            src = src.withColumn("o_channel", F.lit("web"))
        tpath, spath = run_sync_ranged(spark, src, m, store, i, cut, key_range=100)
    out = read_ranged(spark, tpath)
    assert out.count() == orders.count()
    exp = orders.withColumn("o_channel", F.when(F.col("o_orderdate") > F.lit("1998-12-31 18:00:00")
                                                .cast("timestamp_ntz"), F.lit("web")))
    assert _rows(out.select(*exp.columns), "o_orderkey") == _rows(exp, "o_orderkey")
    st = sync_state(spark, spath).collect()
    assert len(st) == 1 and st[0]["status"] == "SUCCESS"


def test_cli_sync_ranged(spark):
    from ambry.cli import main
    from ambry.operators.ranges import read_ranged
    store = tempfile.mkdtemp(prefix="ambry-cli-ranged-")
    for run in ("0", "1"):
        out = main(["sync", "--sf-dir", SF, "--store", store, "--run-id", run, "--as-of", "2001-08-02T00:00:00",
                    "--tables", "orders", "--key-range", "500"])
    assert read_ranged(spark, out["orders"][0]).count() == Tables(spark, SF).orders.count()


def test_ranged_sync_empty_first_source(spark):
    from ambry.operators.ranges import read_ranged
    from ambry.plans.jobs import run_sync_ranged
    orders = Tables(spark, SF).orders
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    store = tempfile.mkdtemp(prefix="ambry-ranged-empty-")
    run_sync_ranged(spark, orders.limit(0), m, store, 0, params.ORDERS_AS_OF, key_range=100)
    tpath, _ = run_sync_ranged(spark, orders, m, store, 1, params.ORDERS_AS_OF, key_range=100)
    assert read_ranged(spark, tpath).count() == orders.count()


def test_cli_warehouse(spark):
    from ambry.cli import main
    store = tempfile.mkdtemp(prefix="ambry-cli-wh-")
    out = main(["warehouse", "--sf-dir", SF, "--store", store, "--run-id", "0", "--as-of", "2001-08-02T00:00:00"])
    assert spark.read.parquet(out["order_global_report"]).count() == Tables(spark, SF).orders.count()
    assert spark.read.parquet(out["_silver_state"]).count() == 8


def test_last_version_with_a_date_as_run_id(spark, tmp_path):
    import time

    from ambry.operators.versioned import last_version, write_version
    root = str(tmp_path / "t")
    assert last_version(spark, root, 20261202) is None
    df = spark.range(1)
    for v in (3, 20261130, 20261203):
        write_version(df, root, v)
    (tmp_path / "t" / "v20261201").mkdir()  # a run that failed before its write was whole
    (tmp_path / "t" / "notes").mkdir()
    start = time.time()
    assert last_version(spark, root, 20261202) == 20261130
    assert last_version(spark, root, 20261130) == 3 and last_version(spark, root, 3) is None
    assert time.time() - start < 5
