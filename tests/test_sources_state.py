"""CSV source, watermark scans, state lookups, schema evolution, type mapping."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from ambry import params
from ambry.functions.types import spark_type, struct_field
from ambry.operators.schema_evolution import align_to_target, evolve_schema, evolve_table
from ambry.operators.state import (audit_row, empty_audit, publish_state_row, read_watermark,
                                   upsert_state)
from ambry.sources.csv_views import read_view_counts
from ambry.sources.incremental import changed_rows, page

W = dt.datetime(2024, 1, 10)


def test_csv_edge_rows(spark):
    d = tempfile.mkdtemp(prefix="ambry-csv-")
    with open(os.path.join(d, "views.csv"), "w") as f:
        f.write('product_id,view_count\n1,10\n2,20,30\n3\nx,5\n6,7.5\n 4 , 40 \n"5","50"\n\n7,70\n')
    got = sorted(tuple(r) for r in read_view_counts(spark, d).collect())
    assert got == [(1, 10), (4, 40), (5, 50), (7, 70)]


def test_csv_stage_has_no_key(spark):
    d = tempfile.mkdtemp(prefix="ambry-csv-")
    with open(os.path.join(d, "views.csv"), "w") as f:
        f.write("product_id,view_count\n1,10\n1,11\n")
    assert sorted(tuple(r) for r in read_view_counts(spark, d).collect()) == [(1, 10), (1, 11)]


def test_changed_rows_strict_and_null_ts(spark):
    df = spark.createDataFrame([(1, W), (2, W + dt.timedelta(seconds=1)), (3, None)], "id int, ts timestamp_ntz")
    assert [r[0] for r in changed_rows(df, "ts", W).collect()] == [2]
    assert changed_rows(df, "ts", None).count() == 3


def test_page_total_order(spark):
    df = spark.createDataFrame([(i, W) for i in range(10)], "id int, ts timestamp_ntz")
    assert [r[0] for r in page(df, ["ts", "id"], 3, 4).collect()] == [3, 4, 5, 6]


def test_watermark_default_and_case(spark):
    st = empty_audit(spark)
    keys = {"target_db_name": "dw", "target_schema": "bronze", "target_table": "orders"}
    assert read_watermark(st, keys) == params.DEFAULT_WATERMARK
    st2 = spark.createDataFrame([("Bronze.ORDERS", 1, *[None] * 5, "DW", "Bronze", "ORDERS", "id", "ts", W, None, 0, 0, "SUCCESS", None, W)], st.schema)
    assert read_watermark(st2, keys) == W


def test_publish_watermark_upsert(spark):
    st = publish_state_row(spark, "PUBLIC.product_score", W)
    new = upsert_state(st, publish_state_row(spark, "public.product_score", W + dt.timedelta(days=1)),
                       ["table_name"])
    assert [tuple(r) for r in new.collect()] == [("public.product_score", W + dt.timedelta(days=1))]


def test_audit_row_counts(spark):
    src = spark.createDataFrame([(1, W), (2, W + dt.timedelta(days=1)), (3, None)], "id int, ts timestamp_ntz")
    keys = {"target_db_name": "dw", "target_schema": "b", "target_table": "t"}
    r = audit_row(spark, keys, src, src, "ts", W, dt.datetime(2024, 2, 1)).first()
    assert r["last_source_row_count"] == 1 and r["last_target_row_count"] == 1
    assert r["last_source_max_updated"] == W + dt.timedelta(days=1)
    assert r["last_synced_at"] == dt.datetime(2024, 1, 31, 18)


def test_schema_evolution_adds_nullable_columns(spark):
    tgt = spark.createDataFrame([(1, "a")], "id int, v string")
    src = spark.createDataFrame([(2, "b", 9, {"k": 1})], "id int, v string, extra long, props map<string,int>")
    schema = evolve_schema(tgt.schema, src.schema)
    assert [f.name for f in schema.fields] == ["id", "v", "extra", "props"]
    old = evolve_table(tgt, schema).collect()[0]
    assert old["extra"] is None
    target = StructType([StructField("id", LongType()), StructField("props", StringType()),
                         StructField("missing", IntegerType())])
    r = align_to_target(src, target).collect()[0]
    assert r["id"] == 2 and r["props"] == '{"k":1}' and r["missing"] is None


def test_type_mapping():
    assert spark_type({"data_type": "integer", "column_default": "nextval('s')"}) == IntegerType()
    assert spark_type({"data_type": "bigint", "column_default": "nextval('s')"}) == LongType()
    assert spark_type({"data_type": "numeric", "numeric_precision": 10, "numeric_scale": 2}) == DecimalType(10, 2)
    assert spark_type({"data_type": "numeric"}) == DecimalType(38, 18)
    assert spark_type({"data_type": "timestamp without time zone"}).simpleString() == "timestamp_ntz"
    assert struct_field({"column_name": "j", "data_type": "jsonb", "is_nullable": "NO"}).metadata == {"json": True}


def test_sinks_observe_counts(spark):
    from ambry.operators.sinks import append_rows, replace_table
    d = tempfile.mkdtemp(prefix="ambry-sink-")
    df = spark.createDataFrame([(1, W), (2, W + dt.timedelta(days=1))], "id int, ts timestamp_ntz")
    m = append_rows(df, f"{d}/t", "ts")
    assert m["rows"] == 2 and m["max_ts"] == W + dt.timedelta(days=1)
    append_rows(df, f"{d}/t")
    assert spark.read.parquet(f"{d}/t").count() == 4
    assert replace_table(df.limit(1), f"{d}/t")["rows"] == 1
    assert spark.read.parquet(f"{d}/t").count() == 1


def test_upsert_touched_ranges_rewrites_only_touched(spark):
    import glob

    from pyspark.sql import functions as F

    from ambry.operators.ranges import RANGE_COL, upsert_touched_ranges, write_ranged
    d = tempfile.mkdtemp(prefix="ambry-ranged-")
    base = spark.range(5000).select(F.col("id").alias("k"), F.lit("a").alias("v"),
                                    F.lit(W).cast("timestamp_ntz").alias("ts"))
    write_ranged(base, d, "k", 1000)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{d}/{RANGE_COL}=*/*.parquet")}
    batch = spark.createDataFrame([(1500, "b", W + dt.timedelta(days=1)), (7000, "new", W)],
                                  "k long, v string, ts timestamp_ntz")
    upsert_touched_ranges(spark, d, batch, "k", "ts", 1000)
    out = spark.read.parquet(d)
    assert out.count() == 5001
    assert {r["k"]: r["v"] for r in out.where(F.col("k").isin(1500, 7000, 1501)).collect()} == \
        {1500: "b", 7000: "new", 1501: "a"}
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{d}/{RANGE_COL}=*/*.parquet")}
    untouched = [p for p in before if f"{RANGE_COL}=1/" not in p]
    assert untouched and all(after.get(p) == before[p] for p in untouched)


def test_many_ranges_share_folders(spark):
    """A table of thousands of ranges has a bounded number of folders; an upsert rewrites only the ones it touches."""
    import glob

    from pyspark.sql import functions as F

    from ambry.operators.ranges import read_ranged, upsert_touched_ranges, write_ranged
    d = tempfile.mkdtemp(prefix="ambry-many-ranges-")
    base = spark.range(30_000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(W).cast("timestamp_ntz").alias("ts"))
    write_ranged(base, d, "k", 10)
    files = lambda: {p: os.path.getmtime(p) for p in glob.glob(f"{d}/key_range*/*.parquet")}
    before = files()
    assert len(glob.glob(f"{d}/key_range*")) <= 256 and len(before) <= 256
    batch = spark.createDataFrame([(1500, "b", W + dt.timedelta(days=1)), (40_000, "new", W), (-5, "new", W)], "k long, v string, ts timestamp_ntz")
    upsert_touched_ranges(spark, d, batch, "k", "ts", 10)
    after = files()
    assert sum(after.get(p) != t for p, t in before.items()) == 1 and len(after) == len(before) + 2
    out = read_ranged(spark, d)
    assert out.columns == ["k", "v", "ts"] and out.count() == 30_002
    assert {r.k: r.v for r in out.where("k IN (1499, 1500, 40000, -5)").collect()} == {1499: "a", 1500: "b", 40_000: "new", -5: "new"}
    old = spark.createDataFrame([(1500, "older", W)], "k long, v string, ts timestamp_ntz")
    upsert_touched_ranges(spark, d, old, "k", "ts", 10, newer_only=True)
    assert read_ranged(spark, d).where("k = 1500").first().v == "b"


def test_failed_sync_run_writes_failed_state(spark):
    from pyspark.sql import functions as F

    from ambry.plans.jobs import run_sync
    from ambry.plans.sync import TableMapping
    d = tempfile.mkdtemp(prefix="ambry-fail-")
    m = TableMapping("t", "t", ["id"], "ts")
    bad = spark.createDataFrame([(1, W)], "id int, ts timestamp_ntz").withColumn(
        "id", F.when(F.col("id") == 1, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception):
        run_sync(spark, bad, m, d, 0, W)
    from ambry.plans.jobs import sync_state
    st = sync_state(spark, f"{d}/_log").collect()
    assert st[0]["status"] == "FAILED" and "boom" in st[0]["last_error"]


def test_arrays_become_json_only_for_json_targets(spark):
    from pyspark.sql.types import ArrayType
    src = spark.createDataFrame([(1, [1, 2], [3])], "id int, tags array<int>, raw array<int>")
    target = StructType([StructField("id", IntegerType()),
                         StructField("tags", StringType(), True, {"json": True}),
                         StructField("raw", ArrayType(IntegerType()))])
    r = align_to_target(src, target).collect()[0]
    assert r["tags"] == "[1,2]" and r["raw"] == [3]


def test_load_mappings(tmp_path):
    from ambry.sources.mappings import load_mappings
    p = tmp_path / "map.xml"
    p.write_text('<?xml version="1.0"?><sources>'
                 '<source source_db_name="ops" source_conn_id="c1" target_db_name="dw" target_conn_id="c2">'
                 '<table source_schema="public" source_table="orders" target_schema="bronze_ops" '
                 'target_table="orders" pk_column="id" ts_column="updated_at"/>'
                 '<table source_schema="public" source_table="lines" target_schema="bronze_ops" '
                 'target_table="lines" pk_column="order_id, line_no" ts_column="updated_at"/>'
                 '</source></sources>')
    ms = load_mappings(str(p))
    assert [m.target_table for m in ms] == ["orders", "lines"]
    assert ms[1].pk == ["order_id", "line_no"] and ms[0].extra == {"source_conn_id": "c1", "target_conn_id": "c2"}
    bad = tmp_path / "bad.xml"
    bad.write_text('<sources><source><table source_table="x"/></source></sources>')
    with pytest.raises(ValueError, match="missing"):
        load_mappings(str(bad))


def test_upsert_touched_ranges_empty_batch(spark):
    from pyspark.sql import functions as F

    from ambry.operators.ranges import read_ranged, upsert_touched_ranges, write_ranged
    d = tempfile.mkdtemp(prefix="ambry-ranged-empty-")
    base = spark.range(100).select(F.col("id").alias("k"), F.lit(W).cast("timestamp_ntz").alias("ts"))
    write_ranged(base, d, "k", 10)
    upsert_touched_ranges(spark, d, base.limit(0), "k", "ts", 10)
    assert read_ranged(spark, d).count() == 100
