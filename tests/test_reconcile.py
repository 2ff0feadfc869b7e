"""Range digests, typed loads and JSON columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ambry.operators import digests
from ambry.operators.digests import RANGE, drift, reconcile, row_hash, splitter
from ambry.operators.schema_evolution import align_to_target
from ambry.operators.typed_load import typed_load
from ambry.operators.variants import JSON, as_json, as_variants, described, extracted, json_target
from ambry.plans.jobs import CHANGES, REJECTS, run_reconcile, run_silver, run_sync
from ambry.plans.sync import TableMapping
from ambry.sources.tables import Frames, Tables

W = dt.datetime(2024, 1, 1)
SCHEMA = "id long, a int, b string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("filter_ranges", [1000, 0])
def test_random_drift_is_found_and_repaired(spark, monkeypatch, filter_ranges):
    monkeypatch.setattr(digests, "FILTER_RANGES", filter_ranges)
    rng = random.Random(5)
    source = [(i, rng.choice([1, 2, None]), rng.choice(["x", None])) for i in range(-30, 200)] + [(None, 1, "x")]
    target = [r for r in source if r[0] is None or not 40 <= r[0] < 43]                  # missing
    target = [(i, 9, b) if i in (100, 105) else (i, a, b) for i, a, b in target]     # changed
    target += [(-95, 1, "e"), (None, 2, "y")]                                       # extra, one without a key
    s, t = (spark.createDataFrame(x, SCHEMA) for x in (source, target))
    fixed = reconcile(s, t, ["id"], 10)
    got = {r[RANGE]: (r.source_rows, r.target_rows, r.missing, r.extra, r.changed) for r in fixed.report.collect()}
    assert got == {4: (10, 7, 3, 0, 0), 10: (10, 10, 0, 0, 2), -10: (0, 1, 0, 1, 0), None: (1, 2, 0, 1, 0)}
    assert rows(fixed.table) == rows(s)
    assert reconcile(s, s, ["id"], 10) is None and reconcile(s.limit(0), s.limit(0), ["id"], 10) is None


def test_digests_see_swapped_and_moved_nulls(spark):
    a = spark.createDataFrame([(1, 1, None), (2, None, "x"), (3, 5, "y"), (4, 6, "z")], SCHEMA)
    b = spark.createDataFrame([(1, 1, None), (2, None, "x"), (3, 6, "y"), (4, 5, "z")], SCHEMA)   # same values, other rows
    assert [r[RANGE] for r in drift(a, b, "id", 100, SCHEMA_COLUMNS).collect()] == [0]
    nulls = spark.createDataFrame([(7, None), (None, 7)], "a long, b long")
    assert len({r[0] for r in nulls.select(row_hash(nulls, ["a", "b"])).collect()}) == 2
    twice = a.union(a.limit(1)).union(a.limit(1))   # an exclusive or alone would cancel out
    assert drift(a, twice, "id", 100, SCHEMA_COLUMNS).count() == 1


SCHEMA_COLUMNS = ["id", "a", "b"]


def test_few_ranges_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    ranges = spark.createDataFrame([(2,), (3,), (9,), (None,)], f"{RANGE} long")
    inside = splitter(ranges, "o_orderkey", 100)(orders, True)
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey,200),LessThan(o_orderkey,400)" in plan.replace(" ", "")
    outside = splitter(ranges, "o_orderkey", 100)(orders, False)
    assert inside.count() + outside.count() == orders.count() and inside.count() == orders.where("floor(o_orderkey / 100) IN (2, 3, 9)").count()


def test_vanished_rows_reach_silver(spark, tmp_path):
    store, m = str(tmp_path), TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    t = Tables(spark, "/root/testdata/sf0.001")
    run_sync(spark, t.orders, m, f"{store}/orders", 0, dt.datetime(2001, 8, 2))
    from ambry.plans.sync import mapping_source, standard_mappings
    for n, other in standard_mappings():
        if n in ("customer", "supplier", "nation", "lineitem"):
            run_sync(spark, mapping_source(t, n, other), other, f"{store}/{n}", 0, dt.datetime(2001, 8, 2))
    bronze = Frames(spark, {n: spark.read.parquet(f"{store}/{n}/bronze.{n}/v000000") for n in ("orders", "customer", "supplier", "nation", "lineitem")})
    run_silver(spark, bronze, store, 0)
    left = t.orders.where("o_orderkey % 40 <> 11")
    path, _, report = run_reconcile(spark, left, m, f"{store}/orders", 1, dt.datetime(2001, 8, 3), 200)
    assert report.agg(F.sum("extra")).first()[0] == t.orders.count() - left.count()
    assert rows(spark.read.parquet(path)) == rows(left)
    out = run_silver(spark, bronze, store, 1)
    got = spark.read.parquet(out["daily_orders_summary"]).select("day", "orders", "businesses")
    want = left.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("businesses"))
    assert rows(got) == rows(want)
    assert spark.read.parquet(out["payment_invoice_transaction"]).count() == left.count()
    same = run_reconcile(spark, left, m, f"{store}/orders", 2, dt.datetime(2001, 8, 4), 200)
    assert same[0] == path and same[2] is None and not (tmp_path / "orders" / f"bronze.orders{CHANGES}" / "v000002").exists()


CATALOG = [{"column_name": "id", "data_type": "integer", "column_default": "nextval('s')", "is_nullable": "NO"},
           {"column_name": "name", "data_type": "varchar", "char_max_length": 3}, {"column_name": "n", "data_type": "smallint"},
           {"column_name": "x", "data_type": "double precision"}, {"column_name": "d", "data_type": "date"}, {"column_name": "j", "data_type": "json"},
           {"column_name": "raw", "data_type": "bytea"}]


def test_typed_load(spark):
    raw = spark.createDataFrame([("1", "abc", " 7 ", "1e3", "2024-02-29", '{"a":1}', "ff00", "k"), ("x", "abcd", "40000", "one", "2024-02-30", "{", "zz", "k"),
                                 (None, None, None, None, None, None, None, None), ("2", "äöü", None, "NaN", None, "[1]", None, "k")],
                                "id string, name string, n string, x string, d string, j string, raw string, other string")
    out = typed_load(raw, CATALOG, ["id"])
    assert [f.dataType.simpleString() for f in out.rows.schema] == ["int", "string", "smallint", "double", "date", "string", "binary"]
    assert out.rows.schema["j"].metadata == JSON
    got = {r.id: r for r in out.rows.collect()}
    assert set(got) == {1, 2} and (got[1].n, got[1].x, got[1].d, bytes(got[1].raw)) == (7, 1000.0, dt.date(2024, 2, 29), b"\xff\x00")
    assert {(r.id, r["column"], r.reason, r.value) for r in out.rejects.collect()} == {
        ("x", "id", "not int", "x"), ("x", "name", "longer than 3", "abcd"), ("x", "n", "not smallint", "40000"), ("x", "x", "not double", "one"),
        ("x", "d", "not date", "2024-02-30"), ("x", "j", "not JSON", "{"), ("x", "raw", "not binary", "zz"), (None, "id", "is NULL", None)}
    with pytest.raises(ValueError, match="gone"):
        typed_load(raw, [*CATALOG, {"column_name": "gone", "data_type": "text"}], ["id"])
    assert typed_load(raw.limit(0), CATALOG, ["id"]).rejects.count() == 0


def test_sync_of_a_catalog_described_source(spark, tmp_path):
    raw = spark.createDataFrame([("1", "2024-01-02 00:00:00"), ("2", "2024-01-03 00:00:00"), ("three", "2024-01-03 00:00:00")], "id string, ts string")
    catalog = [{"column_name": "id", "data_type": "bigint"}, {"column_name": "ts", "data_type": "timestamp without time zone", "is_nullable": "NO"}]
    path, _ = run_sync(spark, raw, TableMapping("t", "t", ["id"], "ts"), str(tmp_path), 0, W + dt.timedelta(days=9), catalog=catalog)
    assert rows(spark.read.parquet(path).select("id")) == [(1,), (2,)]
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/bronze.t{REJECTS}/v000000").collect()] == ["three"]


def test_nested_columns_as_json(spark):
    df = spark.createDataFrame([(1, ("u", 5), {"b": 1, "a": 2}, [1, 2]), (2, ("v", None), {}, None)],
                               "id int, who struct<name:string,code:int>, props map<string,int>, path array<int>")
    v = as_variants(df)
    layout = json_target(df.schema)
    stored = align_to_target(as_json(v), layout)
    assert all(isinstance(stored.schema[c].dataType, StringType) and stored.schema[c].metadata == JSON for c in ("who", "props", "path"))
    got = {r.id: r for r in stored.collect()}
    assert (got[1].who, got[1].props, got[1].path) == ('{"code":5,"name":"u"}', '{"a":2,"b":1}', "[1,2]")
    assert (got[2].who, got[2].props, got[2].path) == ('{"code":null,"name":"v"}', "{}", None)
    again = as_json(as_variants(stored))
    assert rows(again) == rows(stored)
    assert described(v).first().who == "OBJECT<code: BIGINT, name: STRING>"
    read = extracted(as_variants(stored), {"code": ("who", "$.code", "int"), "bad": ("who", "$.name", "int"), "b": ("props", "$.b", "long")})
    assert sorted((r.id, r.code, r.bad, r.b) for r in read.collect()) == [(1, 5, None, 1), (2, None, None, None)]
