"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator / job of SURVEY §2, each reading the given tables so that its work
grows with them.  ``ambry.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ambry import params
from ambry.operators.materialize import materialize
from ambry.operators.upsert import conditional_upsert, update_from
from ambry.plans.scoring_run import ScoringRun, previous_scores
from ambry.sources import proxies
from ambry.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ scoring
@query("p3_product_info")
def p3(spark, sf_dir):
    return ScoringRun(spark, sf_dir).product_info


@query("p4_seller_review")
def p4(spark, sf_dir):
    return ScoringRun(spark, sf_dir).seller_review


@query("p5_customer_review")
def p5(spark, sf_dir):
    return ScoringRun(spark, sf_dir).customer_review


@query("p6_order_items")
def p6(spark, sf_dir):
    return ScoringRun(spark, sf_dir).order_items


@query("p7_deal_bowl")
def p7(spark, sf_dir):
    return ScoringRun(spark, sf_dir).deal_bowl


@query("p8_product_views")
def p8(spark, sf_dir):
    return ScoringRun(spark, sf_dir).product_views


@query("p9_product_stats")
def p9(spark, sf_dir):
    return ScoringRun(spark, sf_dir).product_stats


@query("p10_category_states")
def p10(spark, sf_dir):
    return ScoringRun(spark, sf_dir).category_states


@query("p11_product_score")
def p11(spark, sf_dir):
    return ScoringRun(spark, sf_dir, materialized=True).score_rows


def _score_table(spark, sf_dir) -> DataFrame:
    run = ScoringRun(spark, sf_dir, materialized=True)
    new = materialize(run.score_rows, "score-rows")  # offered, and the base of the old scores
    old = previous_scores(new, proxies.src_product(run.t))
    return materialize(conditional_upsert(old, new, "product_id", ["score"], "updated_at", params.AS_OF), "scores")


@query("p12_score_upsert")
def p12(spark, sf_dir):
    return _score_table(spark, sf_dir)


@query("p13_boosted_update")
def p13(spark, sf_dir):
    scores = _score_table(spark, sf_dir)
    boosted = proxies.src_boosted(Tables(spark, sf_dir))
    return update_from(boosted, scores, "product_id", {"base_score": "score"},
                       "modified_at", params.AS_OF)


#: Days before the scoring time at which the earlier runs of the sliding window lie; the second starts within a day.
SLIDING_RUNS = (20.0, 6.5, 0.0)


def _orders_seen(t: Tables, run: int) -> DataFrame:
    """Order statuses as run ``run`` saw them: until the last run some orders still counted, others not yet."""
    from pyspark.sql import functions as F
    o, k = proxies.src_orders(t), F.col("id")
    if run == len(SLIDING_RUNS) - 1:
        return o
    return o.withColumn("package_status_id", F.when(k % 11 == run, params.EXCLUDED_PACKAGE_STATUS).when(k % 13 == run, 1).otherwise(F.col("package_status_id")))


@query("p6_sliding_window")
def p6_sliding(spark, sf_dir):
    """Order items at three successive times: items arrive, days expire, orders come to count and cease to."""
    import datetime as dt
    from functools import reduce

    from pyspark.sql import functions as F

    from ambry.functions import ts_lit
    from ambry.operators.deltas import signed, version_changes
    from ambry.plans.sliding_items import counted_changes, counted_ids, sliding_order_items
    from ambry.session import scratch_path
    t = Tables(spark, sf_dir)
    root, items, out = scratch_path(spark, "sliding-items"), proxies.src_order_items(t), []
    at, window = F.col("created_at"), dt.timedelta(days=params.ORDER_WINDOW_DAYS)
    before = None
    for run, days in enumerate(SLIDING_RUNS):
        as_of = params.AS_OF - dt.timedelta(days=days)
        seen, since = at <= ts_lit(as_of), at >= ts_lit(as_of - window)
        orders = _orders_seen(t, run)
        if before is None:
            day = at >= ts_lit(dt.datetime.combine((as_of - window).date(), dt.time()))
            changes = signed(items.where(seen & day).join(counted_ids(orders), "order_id", "left_semi"), 1)
        else:
            came = items.where(seen & (at > ts_lit(before)))
            turned = version_changes(_orders_seen(t, run - 1), orders, ["id", "package_status_id"])
            held = items.where((at <= ts_lit(before)) & (at >= ts_lit(dt.datetime.combine((as_of - window).date(), dt.time()))))
            changes = counted_changes(signed(came, 1), orders, turned, held)
        edge = items.where(seen & since).join(counted_ids(orders), "order_id", "left_semi")
        out.append(sliding_order_items(spark, root, run, as_of, changes, edge))
        before = as_of
    return reduce(lambda a, b: a.unionByName(b), out)


@query("p5_mergeable_means")
def p5_mergeable(spark, sf_dir):
    """Product ratings after reviews came, moved, were taken back and vanished, from the stored sums and counts."""
    from ambry.operators.deltas import maintain, signed, version_changes
    from ambry.plans.sliding_items import REVIEWS, mean_ratings
    from ambry.sources import fixtures
    from ambry.sources.tables import Frames
    old, new = (proxies.src_customer_review(Frames(spark, {"lineitem": v})) for v in fixtures.line_versions(Tables(spark, sf_dir).lineitem))
    stored = {"reviews": materialize(maintain(REVIEWS, "reviews", {}, signed(old, 1))["reviews"], "review-sums")}
    changes = materialize(version_changes(old, new, new.columns), "review-changes")
    return mean_ratings(maintain(REVIEWS, "reviews", stored, changes)["reviews"], params.AS_OF)


# --------------------------------------------------------------------- sync
def _orders_sync(spark, sf_dir, drop=None):
    from ambry.plans.sync import TableMapping, sync_table
    from ambry.sources import fixtures
    t = Tables(spark, sf_dir)
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    return sync_table(spark, t.orders, fixtures.bronze_orders(t.orders, drop=drop), m,
                      fixtures.audit_state(spark), params.ORDERS_AS_OF)


@query("a1_changed_rows")
def a1(spark, sf_dir):
    from ambry.sources.incremental import changed_rows
    return changed_rows(Tables(spark, sf_dir).orders, "o_orderdate", params.BRONZE_WATERMARK)


@query("f1_page_by_ts")
def f1(spark, sf_dir):
    from ambry.sources.incremental import changed_rows, page
    ch = changed_rows(Tables(spark, sf_dir).orders, "o_orderdate", params.BRONZE_WATERMARK)
    return page(ch, ["o_orderdate", "o_orderkey"], 100, 1000)


@query("f2_page_by_pk")
def f2(spark, sf_dir):
    from ambry.sources.incremental import page
    return page(Tables(spark, sf_dir).orders, ["o_orderkey"], 2000, 1000)


@query("f1_deep_page")
def f1_deep(spark, sf_dir):
    """A page far behind the first, through a page index of small ranges."""
    from ambry.operators.pages import PageIndex
    from ambry.session import scratch_path
    index = PageIndex.build(Tables(spark, sf_dir).orders, ["o_orderdate", "o_orderkey"], scratch_path(spark, "page-index"), 500)
    return index.page(1200, 700)


@query("a2_full_scan")
def a2(spark, sf_dir):
    from ambry.sources.incremental import changed_rows
    return changed_rows(Tables(spark, sf_dir).customer, "updated_at", None)


def _written_orders(spark, sf_dir, replace: bool):
    """Two slices of orders written one after the other; the folder and what each write observed."""
    from pyspark.sql import functions as F

    from ambry.operators.sinks import append_rows, replace_table
    from ambry.session import scratch_path
    orders, path = Tables(spark, sf_dir).orders, scratch_path(spark, "orders-sink")
    slices = [orders.where(F.col("o_orderkey") % 3 == 0), orders.where(F.col("o_orderkey") % 3 == 1)]
    return path, [replace_table(s, path, "o_orderdate") if replace else append_rows(s, path, "o_orderdate") for s in slices]


@query("a7_append_sink")
def a7(spark, sf_dir):
    return spark.read.parquet(_written_orders(spark, sf_dir, False)[0])


@query("a8_snapshot_sink")
def a8(spark, sf_dir):
    return spark.read.parquet(_written_orders(spark, sf_dir, True)[0])


@query("d13_observed_counts")
def d13(spark, sf_dir):
    """What the writes counted on the way, without a pass of its own."""
    rows = [(i, m["rows"], m["max_ts"]) for i, m in enumerate(_written_orders(spark, sf_dir, False)[1])]
    return spark.createDataFrame(rows, "write_no int, n_rows long, max_ts timestamp_ntz")


@query("i7_silver_watermarks")
def i7(spark, sf_dir):
    """Silver watermarks after a step (I7) that read its own (J2, whatever its case) and advanced it to what it saw."""
    from pyspark.sql import functions as F

    from ambry.functions import ts_lit
    from ambry.operators.state import read_watermark, upsert_state
    from ambry.plans.jobs import SILVER_STATE_SCHEMA
    orders = Tables(spark, sf_dir).orders
    state = spark.createDataFrame([("Silver", "Business_Stats", params.SILVER_WATERMARK), ("silver", "order_invoice", params.DIM_EPOCH)], SILVER_STATE_SCHEMA)
    out = state
    for fact in ("business_stats", "hub_performance"):   # the second has no row yet
        since = read_watermark(state, {"target_schema": "silver", "target_table": fact})
        seen = orders.where(F.col("o_orderdate") > ts_lit(since)).agg(F.max("o_orderdate").alias("last_synced_at"))
        out = upsert_state(out, seen.select(F.lit("silver").alias("target_schema"), F.lit(fact).alias("target_table"), "last_synced_at"),
                           ["target_schema", "target_table"])
    return out


@query("p1_sync_orders")
def p1(spark, sf_dir):
    return _orders_sync(spark, sf_dir).target


@query("p1_sync_orders_evolved")
def p1e(spark, sf_dir):
    return _orders_sync(spark, sf_dir, drop=["o_orderpriority"]).target


@query("j6_sync_state")
def j6(spark, sf_dir):
    return _orders_sync(spark, sf_dir).state


@query("j6_run_log")
def j6_log(spark, sf_dir):
    """A run, a crash and a run: the state that the log's events fold to after each."""
    import datetime as dt

    from pyspark.sql import functions as F

    from ambry.operators.runlog import RunLog, fold
    from ambry.plans.jobs import run_sync
    from ambry.plans.sync import TableMapping
    from ambry.session import scratch_path
    orders, store = Tables(spark, sf_dir).orders, scratch_path(spark, "run-log")
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    early = params.BRONZE_WATERMARK + dt.timedelta(hours=params.SYNC_OVERLAP_HOURS)
    run_sync(spark, orders.where(F.col("o_orderdate") <= F.lit(str(early)).cast("timestamp_ntz")), m, store, 1, early)
    broken = orders.withColumn("o_totalprice", F.when(F.col("o_totalprice") >= 0, F.raise_error(F.lit("source is gone"))).otherwise(0.0))
    try:
        run_sync(spark, broken, m, store, 2, params.ORDERS_AS_OF - dt.timedelta(days=1))
    except Exception as e:  # noqa: BLE001 - the crash is what is tested
        if "source is gone" not in str(e):
            raise
    run_sync(spark, orders, m, store, 3, params.ORDERS_AS_OF)
    events, parts = RunLog(spark, f"{store}/_log").events(), []
    for run in (1, 2, 3):
        state = fold(events.where(F.col("run_id") <= run))
        parts.append(state.withColumn("failed_with", F.substring_index(F.regexp_extract("last_error", "source is gone", 0), "\\n", 1)).drop("last_error"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("p2_sync_all")
def p2(spark, sf_dir):
    from functools import reduce

    from ambry.plans.sync import mapping_source, standard_mappings, sync_table
    t = Tables(spark, sf_dir)
    audits = []
    for name, m in standard_mappings():
        r = sync_table(spark, mapping_source(t, name, m), None, m, None, params.ORDERS_AS_OF)
        audits.append(r.audit)
    return reduce(lambda a, b: a.unionByName(b), audits)


def _repair(spark, sf_dir):
    from ambry.operators.digests import reconcile
    from ambry.sources import fixtures
    orders = Tables(spark, sf_dir).orders
    target = materialize(fixtures.drifted_orders(orders), "drifted")
    return target, reconcile(orders, target, ["o_orderkey"], params.DRIFT_KEY_RANGE)


@query("d12_range_drift")
def d12_drift(spark, sf_dir):
    """The key ranges in which a bronze table differs from its source, and by how many rows."""
    _, fixed = _repair(spark, sf_dir)
    return fixed.report if fixed else spark.createDataFrame([], "key_range long, source_rows long, target_rows long, missing long, extra long, changed long")


@query("d12_range_repair")
def d12_repair(spark, sf_dir):
    target, fixed = _repair(spark, sf_dir)
    return fixed.table if fixed else target


def _typed(spark, sf_dir):
    from ambry.operators.typed_load import typed_load
    from ambry.sources import fixtures
    return typed_load(fixtures.raw_orders(Tables(spark, sf_dir).orders), fixtures.RAW_ORDERS_CATALOG, ["o_orderkey"])


@query("a17_typed_rows")
def a17_rows(spark, sf_dir):
    return _typed(spark, sf_dir).rows


@query("a17_rejects")
def a17_rejects(spark, sf_dir):
    return _typed(spark, sf_dir).rejects


@query("a18_json_columns")
def a18(spark, sf_dir):
    """Nested columns synced twice into JSON columns: what is stored and read back by typed paths.  The
    second run brings every tenth event with other values."""
    from pyspark.sql import functions as F

    from ambry.operators.schema_evolution import align_to_target
    from ambry.operators.upsert import applied, changed_pairs, prepared_batch
    from ambry.operators.variants import as_json, as_variants, extracted, json_target
    from ambry.sources import fixtures
    source = fixtures.nested_events(Tables(spark, sf_dir).events)
    layout = json_target(source.schema)
    target = materialize(align_to_target(as_json(as_variants(source)), layout), "json-target")
    later = source.withColumn("who", F.when(F.col("event_id") % 10 == 0, F.col("who").withField("kind", F.lit("again"))).otherwise(F.col("who")))
    batch, small = prepared_batch(align_to_target(as_json(as_variants(later)), layout), ["event_id"], "ts")
    pairs = changed_pairs(target, batch, ["event_id"], small)
    stored = applied(target, pairs.select("after.*"), ["event_id"], small)
    paths = {"kind": ("who", "$.kind", "string"), "code": ("who", "$.code", "bigint"), "bucket": ("props", "$.bucket", "int"), "last_step": ("path", "$[1]", "bigint")}
    read = extracted(as_variants(stored, ["who", "props", "path"]), paths).select("event_id", *paths)
    return read.withColumn("n_changed", pairs.select(F.count(F.lit(1))).scalar())


# ------------------------------------------------------ extract, csv, publish
# Columns out of name order: they are loaded by position.
RETURN_TOTALS_SQL = """
SELECT sum(CAST(l_quantity AS BIGINT)), l_returnflag, max(l_shipdate), count(*)
FROM lines GROUP BY l_returnflag
"""
RETURN_TOTALS = "quantity BIGINT NOT NULL, flag STRING NOT NULL, last_shipped TIMESTAMP_NTZ, n_items INT NOT NULL"


@query("a3_extract_return_totals")
def a3_totals(spark, sf_dir):
    from pyspark.sql.types import StructType

    from ambry.sources.extract import extract_and_load
    return extract_and_load(spark, RETURN_TOTALS_SQL, {"lines": Tables(spark, sf_dir).lineitem},
                            StructType.fromDDL(RETURN_TOTALS), "stg.return_totals")


@query("a3_extract_product_info")
def a3(spark, sf_dir):
    """A stage table loaded by position from a query over another frame."""
    from ambry.plans.scoring import PRODUCT_INFO
    from ambry.sources.extract import extract_and_load
    return extract_and_load(spark, "SELECT * FROM listed", {"listed": ScoringRun(spark, sf_dir).product_info}, PRODUCT_INFO, "stg.product_info")


def view_count_csv(spark, sf_dir) -> str:
    """Write the view counts as a CSV file set, with malformed lines made
    from the other events, into the shared checkpoint folder."""
    from pyspark.sql import functions as F

    from ambry.session import scratch_path
    from ambry.sources.csv_views import write_csv_lines
    t = Tables(spark, sf_dir)
    views = proxies.src_product_views(t)
    # good rows in three spellings: plain, padded, quoted
    k = F.col("product_id")
    good = views.select(
        F.when(k % 3 == 0, F.concat_ws(",", k.cast("string"), F.col("view_count").cast("string")))
         .when(k % 3 == 1, F.concat(F.lit(" "), k.cast("string"), F.lit(" , "),
                                    F.col("view_count").cast("string"), F.lit(" ")))
         .otherwise(F.concat(F.lit('"'), k.cast("string"), F.lit('","'),
                             F.col("view_count").cast("string"), F.lit('"'))).alias("line"))
    other = t.events.where(F.col("event_type") != "view")
    u, e = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    bad = other.select(
        F.when(F.col("event_type") == "click", F.concat_ws(",", u, e, e))        # 3 fields
         .when(F.col("event_type") == "error", u)                               # 1 field
         .when(F.col("event_type") == "purchase", F.concat(F.lit("x"), u, F.lit(","), e))
         .otherwise(F.concat(u, F.lit(","), e, F.lit(".5"))).alias("line"))     # not an int
    path = scratch_path(spark, "view-counts-csv")
    write_csv_lines(good.unionByName(bad), path)
    return path


@query("a4_csv_product_views")
def a4(spark, sf_dir):
    from ambry.plans.scoring import product_views
    from ambry.sources.csv_views import read_view_counts
    return product_views(read_view_counts(spark, view_count_csv(spark, sf_dir)), params.AS_OF)


@query("p14_publish_batches")
def p14(spark, sf_dir):
    from ambry.operators.state import empty_publish_state, publish_state_row
    from ambry.plans.publish import SCORE_TABLE, publish_scores
    state = empty_publish_state(spark).unionByName(
        publish_state_row(spark, SCORE_TABLE.upper(), params.PUBLISH_LAST_SYNC))
    msgs, _ = publish_scores(spark, _score_table(spark, sf_dir), state, params.AS_OF,
                             params.PUBLISH_BATCH_SIZE)
    return msgs


@query("p14_second_run")
def p14_again(spark, sf_dir):
    """After the first publish every eighth score falls by one: only these are sent."""
    import datetime as dt

    from pyspark.sql import functions as F

    from ambry.operators.state import empty_publish_state
    from ambry.plans.publish import publish_scores
    at = params.AS_OF + dt.timedelta(seconds=1)
    later = at + dt.timedelta(hours=1)
    scores = _score_table(spark, sf_dir)
    _, state = publish_scores(spark, scores, empty_publish_state(spark), at)
    offered = scores.withColumn("score", F.when(F.col("product_id") % 8 == 0, F.col("score") - 1).otherwise(F.col("score")).cast("decimal(10,2)"))
    changed = materialize(conditional_upsert(scores, offered, "product_id", ["score"], "updated_at", later), "scores-later")
    return publish_scores(spark, changed, state, later + params.PUBLISH_DELAY, params.PUBLISH_BATCH_SIZE)[0]


@query("j5_publish_state")
def j5(spark, sf_dir):
    """The watermark after publishing, its key matched whatever its case; with the newest score."""
    from pyspark.sql import functions as F

    from ambry.operators.state import empty_publish_state, publish_state_row
    from ambry.plans.publish import SCORE_TABLE, publish_scores
    state = empty_publish_state(spark).unionByName(
        publish_state_row(spark, SCORE_TABLE.upper(), params.PUBLISH_LAST_SYNC)).unionByName(
        publish_state_row(spark, "other.table", params.DIM_EPOCH))
    scores = _score_table(spark, sf_dir)
    new = publish_scores(spark, scores, state, params.AS_OF + params.PUBLISH_DELAY)[1]
    return new.withColumn("newest_score", scores.agg(F.max("updated_at")).scalar())


@query("p2_lineitem_table")
def p2_lineitem(spark, sf_dir):
    """The bronze table that the first lineitem sync loads."""
    from ambry.plans.sync import mapping_source, standard_mappings, sync_table
    m = dict(standard_mappings())["lineitem"]
    return sync_table(spark, mapping_source(Tables(spark, sf_dir), "lineitem", m), None, m, None, params.ORDERS_AS_OF).target


def _first_load(name: str):
    def run(spark, sf_dir):
        from ambry.plans.sync import mapping_source, standard_mappings, sync_table
        m = dict(standard_mappings())[name]
        return sync_table(spark, mapping_source(Tables(spark, sf_dir), name, m), None, m, None, params.ORDERS_AS_OF).target
    return run


for _table in ("orders", "events", "customer", "supplier", "part", "nation"):
    QUERIES[f"p2_{_table}_table"] = _first_load(_table)   # lineitem's is above


@query("s5_moved_rows")
def s5_moved(spark, sf_dir):
    """Rows that move between businesses and days, and NULL businesses: the refreshed fact."""
    from pyspark.sql import functions as F

    from ambry.functions import ts_lit
    from ambry.operators.incremental import refresh_touched
    from ambry.plans.warehouse import business_stats_agg, star_days
    wm, late = params.SILVER_WATERMARK, F.col("updated_at") > ts_lit(params.SILVER_WATERMARK)
    new = star_days(Tables(spark, sf_dir)).withColumn(
        "from_business_id", F.when(F.col("id") % 17 != 0, F.col("from_business_id")))
    # before the watermark, half of the late rows lay with another business and day
    old = (new.where(~late | (F.col("id") % 2 == 0))
           .withColumns({"from_business_id": F.when(late, F.col("to_business_id")).otherwise(F.col("from_business_id")),
                         "day": F.when(late, F.date_sub("day", 100)).otherwise(F.col("day")),
                         "updated_at": F.when(late, ts_lit(wm)).otherwise(F.col("updated_at"))}))
    return refresh_touched(business_stats_agg(old), new, ["from_business_id", "day"], "updated_at", wm, business_stats_agg, old, ["id"])


# ---------------------------------------------------------------- warehouse
def _wh(spark, sf_dir):
    from ambry.plans.warehouse import Warehouse
    return Warehouse(spark, sf_dir)


for _dim in ("business", "store", "agent", "hub", "order", "delivery_status"):
    QUERIES[f"s1_dim_{_dim}"] = (lambda d: lambda spark, sf_dir: _wh(spark, sf_dir).dim(d))(_dim)

_WAREHOUSE_ATTRS = {
    "s2_order_invoice_transaction": "order_invoice_transaction",
    "s3_payment_invoice_transaction": "payment_invoice_transaction",
    "s4_fact_order_status": "fact_order_status",
    "s5_business_stats": "business_stats",
    "s6_daily_orders_summary": "daily_orders_summary",
    "s7_order_invoice": "order_invoice",
    "s8_payment_invoice": "payment_invoice",
    "s9_hub_performance": "hub_performance",
    "g1_business_totals": "business_totals",
    "g2_daily_orders_snapshot": "daily_orders_snapshot",
    "g3_agent_report": "agent_report",
    "g4_daily_order_invoice": "daily_order_invoice",
    "g5_daily_payment_invoice": "daily_payment_invoice",
    "g6_order_global_report": "order_global_report",
    "g7_delivery_status_last_7days": "delivery_status_last_7days",
    "g8_delivery_aging_last_7days": "delivery_aging_last_7days",
}
for _name, _attr in _WAREHOUSE_ATTRS.items():
    QUERIES[_name] = (lambda a: lambda spark, sf_dir: getattr(_wh(spark, sf_dir), a))(_attr)


def _signed(name: str):
    """A silver fact of the old version of its source, brought to the new one by signed deltas alone."""
    def run(spark, sf_dir):
        from ambry.operators.deltas import maintain, signed, version_changes
        from ambry.plans.maintained import facts
        from ambry.sources import fixtures
        t = Tables(spark, sf_dir)
        fact = facts(t)[name]
        old, new = fixtures.order_versions(t.orders) if fact.source == "orders" else fixtures.line_versions(t.lineitem)
        changes = materialize(version_changes(old, new, new.columns), f"changes-{name}")
        stored = {k: materialize(df, f"stored-{k}") for k, df in maintain(fact, name, {}, signed(old, 1)).items()}
        return fact.public(maintain(fact, name, stored, changes)[name])
    return run


for _name, _attr in {"s2": "order_invoice_transaction", "s5": "business_stats", "s6": "daily_orders_summary",
                     "s7": "order_invoice", "s8": "payment_invoice", "s9": "hub_performance"}.items():
    QUERIES[f"{_name}_signed_deltas"] = _signed(_attr)


# ---------------------------------------------------------------- streaming
@query("st1_stream_sync_orders")
def st1(spark, sf_dir):
    """Orders changed since the bronze watermark arrive as several Parquet
    files; the stream upserts them batch by batch into the bronze fixture."""
    from pyspark.sql import functions as F

    from ambry.plans.sync import TableMapping
    from ambry.session import scratch_path
    from ambry.sources import fixtures
    from ambry.sources.incremental import changed_rows
    from ambry.streaming.sync_stream import start_stream_sync
    t = Tables(spark, sf_dir)
    arrivals = scratch_path(spark, "orders-arrivals")
    (changed_rows(t.orders, "o_orderdate", params.BRONZE_WATERMARK)
     .repartitionByRange(3, F.col("o_orderdate")).write.parquet(arrivals))
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    s = start_stream_sync(spark, arrivals, fixtures.bronze_orders(t.orders), m,
                          scratch_path(spark, "bronze-orders"), scratch_path(spark, "orders-stream-ckpt"),
                          max_files_per_trigger=1)
    s.query.awaitTermination()
    return s.latest(spark)


@query("st1_late_rows")
def st1_late(spark, sf_dir):
    """Orders that arrive in three deliveries: a ninth one delivery late, a quarter twice, and outdated copies after
    the rows that replaced them.  The stream is started for each delivery and goes on where it ended."""
    import datetime as dt

    from pyspark.sql import functions as F

    from ambry.plans.sync import TableMapping
    from ambry.session import scratch_path
    from ambry.streaming.late_rows import start_late_sync
    orders = Tables(spark, sf_dir).orders
    k, arrivals, target = F.col("o_orderkey"), scratch_path(spark, "late-arrivals"), scratch_path(spark, "late-orders")
    own = F.pmod(k, F.lit(3))                       # the delivery that a row belongs to
    came = F.least(own + (k % 9 == 0).cast("long"), F.lit(2))
    outdated = (orders.where((k % 5 == 0) & (own < 2)).withColumn("o_totalprice", F.lit(0.0))
                .withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 10 DAYS")))
    m = TableMapping("orders", "orders", ["o_orderkey"], "o_orderdate")
    ckpt = scratch_path(spark, "late-ckpt")
    for n in range(3):
        again = orders.where((came == n - 1) & (k % 4 == 0))
        late = outdated.where(came == n - 1)
        orders.where(came == n).unionByName(again).unionByName(late).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(orders.schema).parquet(arrivals)
        # the test data's order dates are spread over years in every delivery
        start_late_sync(spark, stream, m, target, ckpt, params.BRONZE_KEY_RANGE, dt.timedelta(days=4000)).awaitTermination()
    from ambry.operators.ranges import read_ranged
    return read_ranged(spark, target)


def _daily_counts(spark, sf_dir):
    from pyspark.sql import functions as F

    from ambry.session import scratch_path
    from ambry.streaming.last_days import daily_counts, start_daily_counts
    arrivals, root = scratch_path(spark, "status-arrivals"), scratch_path(spark, "daily-counts")
    star = proxies.star_fact(Tables(spark, sf_dir)).select("id", "timestamp_at", "delivery_status_id")
    star.repartition(4, F.col("id") % 4).write.parquet(arrivals)   # each file has rows of all days
    stream = spark.readStream.schema(star.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
    start_daily_counts(spark, stream, root, scratch_path(spark, "daily-counts-ckpt")).awaitTermination()
    return daily_counts(spark, root)


@query("g7_stream")
def g7_stream(spark, sf_dir):
    """The trailing week's counts from a drained stream."""
    from ambry.streaming.last_days import status_last_days
    return status_last_days(_daily_counts(spark, sf_dir), params.ORDERS_AS_OF)


@query("g8_stream")
def g8_stream(spark, sf_dir):
    from ambry.streaming.last_days import aging_last_days
    return aging_last_days(_daily_counts(spark, sf_dir), params.ORDERS_AS_OF)


@query("d8_source_metrics")
def d8(spark, sf_dir):
    from ambry.operators.state import source_metrics
    return source_metrics(Tables(spark, sf_dir).lineitem, "l_shipdate", params.BRONZE_WATERMARK)


@query("p1_sync_orders_ranges")
def p1r(spark, sf_dir):
    """The P1 sync applied in place to a key-range partitioned bronze table."""
    from ambry.operators.ranges import read_ranged, upsert_touched_ranges, write_ranged
    from ambry.operators.state import read_watermark
    from ambry.session import scratch_path
    from ambry.sources import fixtures
    from ambry.sources.incremental import changed_rows
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "bronze-orders-ranged")
    write_ranged(fixtures.bronze_orders(t.orders), path, "o_orderkey", params.BRONZE_KEY_RANGE)
    since = read_watermark(fixtures.audit_state(spark),
                           {"target_db_name": "dw", "target_schema": "bronze", "target_table": "orders"})
    upsert_touched_ranges(spark, path, changed_rows(t.orders, "o_orderdate", since),
                          "o_orderkey", "o_orderdate", params.BRONZE_KEY_RANGE)
    return read_ranged(spark, path)
