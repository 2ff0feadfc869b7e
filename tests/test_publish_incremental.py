"""Publishing batches, touched-key incremental facts, streaming sync."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ambry.operators.batching import global_index, message_batches
from ambry.operators.incremental import as_of_watermark, refresh_touched
from ambry.plans.publish import changed_scores
from ambry.plans.warehouse import daily_orders_agg

T = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("n,size,expect", [(0, 3, []), (6, 3, [3, 3]), (7, 3, [3, 3, 1])])
def test_batches_sizes(spark, n, size, expect):
    df = spark.createDataFrame([(i * 10, Decimal("12.50")) for i in range(n)], "id int, baseScore decimal(10,2)")
    got = message_batches(df, "id", size, num_ranges=3).orderBy("batch_no").collect()
    assert [r["n_rows"] for r in got] == expect
    if got:
        first = json.loads(got[0]["value"])
        assert first[0] == {"id": 0, "baseScore": 12.5}
        assert [x["id"] for x in first] == sorted(x["id"] for x in first)


def test_global_index_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    idx = {r["k"]: r["row_index"] for r in global_index(df, "k", 5).collect()}
    assert sorted(idx) == list(range(1000)) and all(idx[k] == k for k in idx)


def test_publish_watermark_inclusive(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"), T), (2, Decimal("2.00"), T - dt.timedelta(seconds=1))],
                               "product_id int, score decimal(10,2), updated_at timestamp_ntz")
    assert [r[0] for r in changed_scores(df, T).collect()] == [1]


def test_incremental_refresh_equals_full_recompute(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumn("day", F.to_date("o_orderdate"))
    full = sorted(tuple(r) for r in daily_orders_agg(orders).collect())
    # converge over three watermark slices
    wms = [dt.datetime(1999, 1, 1), dt.datetime(2000, 6, 1), dt.datetime(2001, 7, 1)]
    cur = as_of_watermark(orders, "o_orderdate", wms[0], daily_orders_agg)
    for wm in wms:
        cur = refresh_touched(cur, orders, ["day"], "o_orderdate", wm, daily_orders_agg)
        cur = spark.createDataFrame(cur.collect(), cur.schema)
    assert sorted(tuple(r) for r in cur.collect()) == full


def test_stream_sync_restart_processes_only_new_files(spark):
    import tempfile

    from ambry.plans.sync import TableMapping
    from ambry.streaming.sync_stream import start_stream_sync
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    root = tempfile.mkdtemp(prefix="ambry-stream-")
    src, tgt, ckpt = f"{root}/src", f"{root}/tgt", f"{root}/ckpt"
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    orders.where(F.col("o_orderdate") < cut).write.parquet(f"{src}/part=1")
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    empty = orders.limit(0)
    s = start_stream_sync(spark, src, empty, m, tgt, ckpt)
    s.query.awaitTermination()
    first = s.latest(spark).count()
    assert first == orders.where(F.col("o_orderdate") < cut).count()
    # new arrivals (incl. a changed copy of an old order) after a restart
    changed = orders.where(F.col("o_orderkey") == 0).withColumn("o_orderpriority", F.lit("changed")) \
        .withColumn("o_orderdate", F.lit("2002-01-01").cast("timestamp_ntz"))
    orders.where(F.col("o_orderdate") >= cut).unionByName(changed).write.parquet(f"{src}/part=2")
    s2 = start_stream_sync(spark, src, empty, m, tgt, ckpt)
    s2.query.awaitTermination()
    out = s2.latest(spark)
    assert out.count() == orders.count()
    assert out.where(F.col("o_orderkey") == 0).first()["o_orderpriority"] == "changed"


def test_message_timestamps_like_isoformat(spark):
    rows = [(1, dt.datetime(2001, 11, 5, 0, 0), dt.date(2001, 11, 5)),
            (2, dt.datetime(2001, 11, 5, 1, 2, 3, 450000), dt.date(2001, 1, 2))]
    df = spark.createDataFrame(rows, "id int, ts timestamp_ntz, d date")
    got = json.loads(message_batches(df, "id", 10, num_ranges=2).first()["value"])
    assert got == [{"id": r[0], "ts": r[1].isoformat(), "d": r[2].isoformat()} for r in rows]
