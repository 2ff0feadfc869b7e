"""Page index, trailing-week streams, the command line with a mapping file."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ambry.operators.pages import PageIndex
from ambry.streaming.last_days import aging_last_days, daily_counts, start_daily_counts, status_last_days


def test_deep_page_reads_few_rows(spark, tmp_path):
    n = 1_200_000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), (F.col("id") % 5).alias("v"))
    index = PageIndex.build(df, ["k"], str(tmp_path), 5000)
    page = index.page(1_000_000, 100)
    assert [r.k for r in page.collect()] == list(range(1_000_000, 1_000_100))
    met = index.ranges().where("start < 1000100 AND start + n > 1000000").agg(F.sum("n")).first()[0]
    assert met < 0.01 * n and "PartitionFilters" in page._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in index.page(n - 2, 50).collect()] == [n - 2, n - 1] and index.page(n, 5).count() == 0


def test_pages_cover_all_rows_once(spark, tmp_path):
    rows = [(i % 4 if i % 9 else None, i) for i in range(500)]
    index = PageIndex.build(spark.createDataFrame(rows, "a int, b int"), ["a", "b"], str(tmp_path / "p"), 40)
    pages = [tuple(r) for o in range(0, 500, 70) for r in index.page(o, 70).collect()]
    assert pages == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    empty = PageIndex.build(spark.createDataFrame([], "a int"), ["a"], str(tmp_path / "e"), 40)
    assert empty.page(0, 10).count() == 0


def test_small_ranges_share_folders(spark, tmp_path):
    """Ranges of few rows don't cost a folder, a task and a sample each; pages of any span are whole."""
    n = 20_000
    index = PageIndex.build(spark.range(n).select((F.col("id") * 7919 % n).alias("k")), ["k"], str(tmp_path), 10)
    assert len(list((tmp_path / "rows").glob("__part=*"))) <= 256
    ranges = index.ranges().orderBy("start").collect()
    assert len(ranges) >= n // 10 and max(r.n for r in ranges) <= 10
    assert [r.start for r in ranges] == [sum(x.n for x in ranges[:i]) for i in range(len(ranges))]
    for offset, limit in ((0, 7), (9_990, 25), (3_333, 1_000), (n - 3, 9), (0, n)):
        assert [r.k for r in index.page(offset, limit).collect()] == list(range(offset, min(n, offset + limit)))
    assert index.page(n, 5).count() == 0 and index.page(5, 0).count() == 0


AS_OF = dt.datetime(2024, 5, 20)


def test_stream_of_days_with_late_rows_and_restart(spark, tmp_path):
    schema = "id long, timestamp_at timestamp_ntz, delivery_status_id int"
    at = lambda d, h=1: AS_OF - dt.timedelta(days=d) + dt.timedelta(hours=h)
    first = [(i, at(i % 6 + 1, i % 24), i % 3 + 1) for i in range(60)] + [(100, at(40), 1)]
    late = [(200 + i, at(6, i), 2) for i in range(5)] + [(300, at(1), 3), (301, at(30), 2)]   # the last is too late for the state
    src, root, ckpt = (str(tmp_path / x) for x in ("src", "table", "ckpt"))
    seen = []
    for part in (first, late):
        spark.createDataFrame(part, schema).write.mode("append").parquet(src)
        seen += part
        start_daily_counts(spark, spark.readStream.schema(schema).parquet(src), root, ckpt).awaitTermination()
        counts = daily_counts(spark, root)
        want = {}
        for _, t, s in seen:
            if t >= AS_OF - dt.timedelta(days=7):
                want[t.date(), s] = want.get((t.date(), s), 0) + 1
        assert {(r.day, r.delivery_status_id): r.orders for r in status_last_days(counts, AS_OF).collect()} == want
        ages = {}
        for (day, s), n in want.items():
            if s != 1:
                age = (AS_OF.date() - day).days
                b = "0-1" if age <= 1 else "2-3" if age <= 3 else "4-7"
                ages[b] = ages.get(b, 0) + n
        assert {r.age_bucket: r.orders for r in aging_last_days(counts, AS_OF).collect()} == ages
    assert daily_counts(spark, root).where(F.col("day") == F.lit(at(30).date())).count() == 0


def test_cli_with_a_mapping_file(spark, tmp_path):
    from ambry.cli import main
    from ambry.plans.jobs import sync_state
    (tmp_path / "in").mkdir()
    spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1)), (2, "b", dt.datetime(2024, 1, 2))], "key int, v string, changed timestamp_ntz") \
        .write.parquet(str(tmp_path / "in" / "items.parquet"))
    mapping = tmp_path / "map.xml"
    mapping.write_text('<sources><source source_db_name="ops" source_conn_id="c1" target_db_name="dw" target_conn_id="c2">'
                       '<table table_no="7" source_schema="public" source_table="items" target_schema="bronze_ops" target_table="all_items" '
                       'pk_column="key" ts_column="changed"/></source></sources>')
    out = main(["sync", "--sf-dir", str(tmp_path / "in"), "--store", str(tmp_path / "store"), "--run-id", "1", "--as-of", "2024-02-01T00:00:00",
                "--mappings", str(mapping)])
    path, log = out["all_items"]
    assert spark.read.parquet(path).count() == 2
    s = sync_state(spark, log).first()
    assert (s.table_name, s.table_no, s.source_conn_id, s.source_table, s.status) == ("bronze_ops.all_items", 7, "c1", "items", "SUCCESS")
    with pytest.raises(ValueError, match="never synced"):
        main(["sync", "--sf-dir", str(tmp_path / "in"), "--store", str(tmp_path / "other"), "--run-id", "1", "--as-of", "2024-02-01T00:00:00",
              "--mappings", str(mapping), "--reconcile", "10"])


def test_scoring_on_tables_of_ones_own(spark, tmp_path):
    from ambry.cli import main
    from ambry.plans.scoring_run import SOURCES, ScoringRun
    sf = "/root/testdata/sf0.001"
    run = ScoringRun(spark, sf)
    for name in SOURCES:   # without campaign products: these then come from the test tables
        if name != "campaign_products":
            run.source(name).write.parquet(str(tmp_path / "own" / f"{name}.parquet"))
    (spark.read.parquet(str(tmp_path / "own" / "products.parquet")).withColumn("total_stock_quantity", F.lit(0))
     .write.parquet(str(tmp_path / "empty" / "products.parquet")))
    out = [spark.read.parquet(main(["score", "--sf-dir", sf, "--store", str(tmp_path / d), "--run-id", "0", *more])["product_score"])
           for d, more in (("a", []), ("b", ["--sources", str(tmp_path / "own")]), ("c", ["--sources", str(tmp_path / "empty")]))]
    plain, own, no_stock = ({r.product_id: r.score for r in df.collect()} for df in out)
    assert plain == own and plain.keys() == no_stock.keys() and all(no_stock[k] <= plain[k] for k in plain) and no_stock != plain
    with pytest.raises(ValueError, match="unknown sources"):
        ScoringRun(spark, sf, sources={"produkte": spark.range(1)})


def test_day_counts_are_grouped_in_one_partition(spark, tmp_path, monkeypatch):
    """One task must not group a partition after the other: it would keep the memory of each."""
    from ambry.streaming import last_days
    plans, write = [], last_days.write_version

    def put(df, *more):
        plans.append((df._jdf.queryExecution().executedPlan().toString(), df.rdd.getNumPartitions()))
        return write(df, *more)

    monkeypatch.setattr(last_days, "write_version", put)
    schema = "timestamp_at timestamp_ntz, delivery_status_id int"
    spark.createDataFrame([(AS_OF, 1), (AS_OF, 1), (AS_OF, 2)], schema).write.parquet(str(tmp_path / "src"))
    start_daily_counts(spark, spark.readStream.schema(schema).parquet(str(tmp_path / "src")), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert plans and all("Coalesce" not in p and n == 1 for p, n in plans)
    assert {(r.delivery_status_id, r.orders) for r in daily_counts(spark, str(tmp_path / "t")).collect()} == {(1, 2), (2, 1)}
