"""Scheduled jobs end to end: each run reads the previous run's versions and
writes its own (SURVEY §3 entries 1 and 3).

Layout under ``store``: ``<table>/v<run_id>`` Parquet folders.  A run is
identified by an increasing ``run_id`` chosen by the scheduler; run ``n``
reads the newest whole version below ``n`` of its targets and state (a sync:
the one that its log names as the last success) and writes version ``n``.  A version is only ever read by later runs, so a failed
run is either retried with the same ``run_id`` (its partial output is
overwritten) or passed over by the next one.

Write order follows the reference: targets first, messages next, and the
publish watermark last (at-least-once delivery).
"""

from __future__ import annotations

import datetime as _dt
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ambry import params
from ambry.operators.batching import write_messages
from ambry.operators.deltas import Fact, maintain, signed
from ambry.operators.digests import reconcile
from ambry.operators.runlog import FAILED, RUNNING, RunLog
from ambry.operators.state import AUDIT_SCHEMA, audit_row, empty_audit, empty_publish_state, read_source_max
from ambry.operators.typed_load import typed_load
from ambry.operators.upsert import conditional_upsert, update_from
from ambry.operators.versioned import exists, last_version, read_version, version_path, write_version
from ambry.plans import scoring
from ambry.plans.maintained import facts, keyed, refresh_keyed, statuses
from ambry.plans.scoring_run import ScoringRun
from ambry.plans.publish import publish_scores
from ambry.plans.sync import TableMapping, sync_table
from ambry.sources import proxies
from ambry.sources.tables import Frames, Tables


def _previous(spark: SparkSession, store: str, table: str, run_id: int,
              initial: DataFrame | None) -> DataFrame | None:
    """The newest whole version that an earlier run wrote; a failed run leaves a gap."""
    v = last_version(spark, f"{store}/{table}", run_id)
    return initial if v is None else read_version(spark, f"{store}/{table}", v)


def _cause(e: Exception) -> str:
    """The error's text, its root cause first: the audit row keeps the beginning."""
    text = str(e)
    causes = [line.removeprefix("Caused by: ") for line in text.splitlines() if line.startswith("Caused by: ")]
    return "\n".join([*causes[-1:], text])


def _has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table with key-range partitions is at ``path``."""
    if not exists(spark, path):
        return False
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return any(f.isDirectory() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))


@dataclass
class ScoringOutputs:
    product_stats: str
    category_states: str
    product_score: str
    boosted_products: str
    messages: str
    publish_state: str


def run_scoring(spark: SparkSession, sf_dir: str, store: str, run_id: int,
                as_of: _dt.datetime = params.AS_OF, boosted: DataFrame | None = None,
                views: DataFrame | None = None, weights: dict | None = None,
                batch_size: int = params.PUBLISH_BATCH_SIZE,
                window_days: int = params.ORDER_WINDOW_DAYS, publish_at: _dt.datetime | None = None,
                sources: dict[str, DataFrame] | None = None) -> ScoringOutputs:
    """P3–P14 as one scheduled run, on the given ``sources`` (``plans/scoring_run.SOURCES``) where there are any.  ``publish_at`` is the time of publishing, later than the
    scores' stamp ``as_of``, so that the next run doesn't send them again (default: just after)."""
    publish_at = publish_at or as_of + _dt.timedelta(microseconds=1)
    if publish_at <= as_of:
        raise ValueError("scores are published after they are stamped")
    run = ScoringRun(spark, sf_dir, as_of, window_days, weights, views, sources=sources)
    p = {t: version_path(f"{store}/{t}", run_id) for t in
         ("product_stats", "category_states", "product_score", "boosted_products", "messages",
          "publish_state")}
    write_version(run.product_stats, f"{store}/product_stats", run_id)
    stats = read_version(spark, f"{store}/product_stats", run_id)
    write_version(scoring.category_states(stats, as_of), f"{store}/category_states", run_id)
    cats = read_version(spark, f"{store}/category_states", run_id)
    offered = scoring.score_rows(scoring.product_score(stats, cats, run.algorithm_parameters), as_of)

    prev_scores = _previous(spark, store, "product_score", run_id,
                            spark.createDataFrame([], scoring.PRODUCT_SCORE))
    table = conditional_upsert(prev_scores, offered, "product_id", ["score"], "updated_at", as_of)
    write_version(table, f"{store}/product_score", run_id)
    table = read_version(spark, f"{store}/product_score", run_id)

    prev_boosted = _previous(spark, store, "boosted_products", run_id, boosted)
    if prev_boosted is not None:
        write_version(update_from(prev_boosted, table, "product_id", {"base_score": "score"},
                                  "modified_at", as_of), f"{store}/boosted_products", run_id)

    prev_pub = _previous(spark, store, "publish_state", run_id, empty_publish_state(spark))
    msgs, new_state = publish_scores(spark, table, prev_pub, publish_at, batch_size)
    write_messages(msgs, p["messages"])
    write_version(new_state, f"{store}/publish_state", run_id)
    return ScoringOutputs(**p)


@contextmanager
def _logged(spark: SparkSession, mapping: TableMapping, store: str, run_id: int, as_of: _dt.datetime,
            initial_state: DataFrame | None):
    """One sync run in the log: RUNNING before, FAILED if it raises; gives the log, the state that earlier
    runs left (a frame of at most one row, in the driver) and what the body calls on success."""
    log = RunLog(spark, f"{store}/_log")
    row, n = log.before(run_id)
    state = initial_state if row is None else spark.createDataFrame([tuple(row)[:-2]], AUDIT_SCHEMA)
    log.append(run_id, n, log.status_row(mapping.described(), RUNNING, as_of))
    try:
        yield log, state if state is not None else empty_audit(spark), None if row is None else row.version, \
            lambda audit, version: log.append(run_id, n + 1, audit, version)
    except Exception as e:
        # FAILED keeps the previous watermark, so the next run re-reads the rows
        log.append(run_id, n + 1, log.status_row(mapping.described(), FAILED, as_of, _cause(e)))
        raise


def sync_state(spark: SparkSession, log_path: str) -> DataFrame:
    """The state rows that a log's events fold to."""
    return RunLog(spark, log_path).state()


def run_sync(spark: SparkSession, source: DataFrame, mapping: TableMapping, store: str,
             run_id: int, as_of: _dt.datetime, initial_target: DataFrame | None = None,
             initial_state: DataFrame | None = None, catalog: list[dict] | None = None) -> tuple[str, str]:
    """P1 as one scheduled run: writes ``<target>/v<run_id>``, what changed since the version before
    (signed images, ``<target>._changes/v<run_id>``) and the run's events into ``_log``.  Without any change
    only the log grows.  With a ``catalog`` (A17) the source's text values are typed by it first, and the rows
    that don't fit go to ``<target>._rejects/v<run_id>``.  It starts from the newest version that a successful run left.  Returns the
    target's and the log's path."""
    tname = f"{mapping.target_schema}.{mapping.target_table}"
    with _logged(spark, mapping, store, run_id, as_of, initial_state) as (log, state, last, succeed):
        if catalog is not None:
            load = typed_load(source, catalog, mapping.pk)
            write_version(load.rejects, f"{store}/{tname}{REJECTS}", run_id)
            source = load.rows
        target = initial_target if last is None else read_version(spark, f"{store}/{tname}", last)
        res = sync_table(spark, source, target, mapping, state, as_of, feed=True)
        if last is not None and res.target.schema == target.schema and res.changes.isEmpty():
            written, version = target, last   # nothing changed: nothing is written
        else:
            if res.changes is not None:
                write_version(res.changes, f"{store}/{tname}{CHANGES}", run_id)
            write_version(res.target, f"{store}/{tname}", run_id, sort_by=[mapping.ts_column])
            # the audit counts the written version (a column-pruned scan), not
            # the upsert plan again
            written, version = read_version(spark, f"{store}/{tname}", run_id), run_id
        succeed(audit_row(spark, mapping.described(), source, written, mapping.ts_column, res.since, as_of,
                          previous_max=read_source_max(state, mapping.state_keys())), version)
    return version_path(f"{store}/{tname}", version), log.root


def run_reconcile(spark: SparkSession, source: DataFrame, mapping: TableMapping, store: str,
                  run_id: int, as_of: _dt.datetime, range_size: int) -> tuple[str, str, DataFrame | None]:
    """Compare a bronze table with its whole source by digests of key ranges and repair what differs,
    rows that vanished from the source included; the changes are fed on like a sync's.  Returns the
    target's and the log's path, and the report (None: nothing differed, nothing was written)."""
    from ambry.operators.schema_evolution import align_to_target, evolve_schema, evolve_table
    from ambry.operators.state import read_watermark

    tname = f"{mapping.target_schema}.{mapping.target_table}"
    with _logged(spark, mapping, store, run_id, as_of, None) as (log, state, last, succeed):
        if last is None:
            raise ValueError(f"{tname} was never synced")
        target = read_version(spark, f"{store}/{tname}", last)
        schema = evolve_schema(target.schema, source.schema)
        fixed = reconcile(align_to_target(source, schema), evolve_table(target, schema), mapping.pk, range_size)
        written, version = target, last
        if fixed is not None:
            write_version(fixed.changes, f"{store}/{tname}{CHANGES}", run_id)
            write_version(fixed.table, f"{store}/{tname}", run_id, sort_by=[mapping.ts_column])
            written, version = read_version(spark, f"{store}/{tname}", run_id), run_id
        succeed(audit_row(spark, mapping.described(), source, written, mapping.ts_column,
                          read_watermark(state, mapping.state_keys()), as_of), version)
    return version_path(f"{store}/{tname}", version), log.root, None if fixed is None else fixed.report


def run_sync_ranged(spark: SparkSession, source: DataFrame, mapping: TableMapping, store: str,
                    run_id: int, as_of: _dt.datetime, key_range: int,
                    initial_state: DataFrame | None = None) -> tuple[str, str]:
    """P1 as one scheduled run on a key-range partitioned target, in place.

    The target ``<store>/<table>`` is written once (first load) and from then
    on only the key ranges touched by each run's changed rows are rewritten
    (``operators/ranges``); its events go to ``_log`` as in
    ``run_sync``.  Suited to serial keys, where changes cluster in recent
    ranges.
    """
    from ambry.operators.ranges import read_ranged, upsert_touched_ranges, write_ranged
    from ambry.operators.state import read_watermark
    from ambry.sources.incremental import changed_rows

    tpath = f"{store}/{mapping.target_schema}.{mapping.target_table}"
    keys = mapping.state_keys()
    with _logged(spark, mapping, store, run_id, as_of, initial_state) as (log, state, _, succeed):
        since = read_watermark(state, keys)
        # an empty first load leaves its marker but no data file
        if _has_data(spark, tpath):
            upsert_touched_ranges(spark, tpath, changed_rows(source, mapping.ts_column, since),
                                  mapping.pk, mapping.ts_column, key_range)
            target = read_ranged(spark, tpath)
        else:
            # first load; an empty source leaves no data file, so the next run
            # simply loads again
            write_ranged(sync_table(spark, source, None, mapping, None, as_of).target, tpath,
                         mapping.pk[0], key_range)
            target = read_ranged(spark, tpath) if _has_data(spark, tpath) else source.limit(0)
        succeed(audit_row(spark, mapping.described(), source, target, mapping.ts_column, since, as_of,
                          previous_max=read_source_max(state, keys)), run_id)
    return tpath, log.root


def run_sync_all(spark: SparkSession, sources: dict[str, tuple[DataFrame, TableMapping]], store: str,
                 run_id: int, as_of: _dt.datetime, parallelism: int = 4,
                 key_range: int | None = None) -> dict[str, tuple[str, str]]:
    """The independent table syncs, ``parallelism`` of them at a time.

    Each sync is its own set of Spark jobs; submitting them from a few driver
    threads lets the scheduler overlap them (small tables do not leave the
    cluster idle while a big one finishes).  A failure in one table does not
    stop the others; it is raised after all have finished.
    """
    from concurrent.futures import ThreadPoolExecutor

    def one(name: str):
        df, m = sources[name]
        if key_range:
            return run_sync_ranged(spark, df, m, f"{store}/{name}", run_id, as_of, key_range)
        return run_sync(spark, df, m, f"{store}/{name}", run_id, as_of)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        futures = {name: pool.submit(one, name) for name in sources}
    errors = {n: f.exception() for n, f in futures.items() if f.exception() is not None}
    if errors:
        raise RuntimeError(f"sync failed for {sorted(errors)}: {next(iter(errors.values()))}")
    return {n: f.result() for n, f in futures.items()}


SILVER_STATE_SCHEMA = "target_schema STRING, target_table STRING, last_synced_at TIMESTAMP_NTZ"


#: Bronze tables that the warehouse reads, and what follows a table's name where its changes are.
WAREHOUSE_TABLES = ("orders", "lineitem", "customer", "supplier", "nation")
CHANGES, REJECTS = "._changes", "._rejects"


def _bronze(store: str, name: str) -> str:
    return f"{store}/{name}/bronze.{name}"


def _changes_since(spark: SparkSession, root: str, stored: int | None, run_id: int) -> tuple[bool, DataFrame | None]:
    """Whether a table that was last brought up to date by run ``stored`` must be built anew, and the
    bronze changes since (None: none).  Without a stored version, or with a bronze version whose
    changes aren't there (a first load), all rows of bronze are the changes."""
    log = RunLog(spark, f"{root.rpartition('/')[0]}/_log")
    new = log.versions(-1 if stored is None else stored, run_id)
    if stored is not None and not new:
        return False, None
    whole = {v for v in new if exists(spark, f"{version_path(root + CHANGES, v)}/_SUCCESS")}
    if stored is None or whole != set(new):
        return True, signed(read_version(spark, root, log.last_version(run_id)), 1)
    feeds = [read_version(spark, root + CHANGES, v) for v in new]
    return False, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def run_silver(spark: SparkSession, bronze: Frames, store: str, run_id: int) -> dict[str, str]:
    """S1–S9 from the changes of bronze since each table's last version; a table whose source didn't
    change keeps that version.  Returns each table's path."""
    out: dict[str, str] = {}

    def one(name: str, source: str, parts: list[str], make) -> None:
        root = f"{store}/silver.{name}"
        last = last_version(spark, root, run_id)
        anew, changes = _changes_since(spark, _bronze(store, source), last, run_id)
        if changes is None:
            out[name] = version_path(root, last)
            return
        stored = {} if anew else {p: read_version(spark, f"{store}/silver.{p}", last) for p in [name, *parts]}
        tables = make(stored, changes)
        for p in [*parts, name]:   # the table itself last: where it is whole, its parts are
            out[p] = write_version(tables[p], f"{store}/silver.{p}", run_id)

    for name, how in keyed(bronze).items():
        one(name, how[0], [], lambda stored, changes, n=name, h=how: {n: refresh_keyed(n, h, stored.get(n), changes)})
    for name, fact in {**facts(bronze), "delivery_statuses": statuses(bronze)}.items():
        def made(stored: dict[str, DataFrame], changes: DataFrame, n: str = name, f: Fact = fact) -> dict[str, DataFrame]:
            tables = maintain(f, n, stored, changes)
            return {**tables, n: f.whole(tables[n])}
        one(name, fact.source, [f"{name}.{m}" for m in fact.distinct], made)
    return out


def run_warehouse(spark: SparkSession, sf_dir: str, store: str, run_id: int,
                  as_of: _dt.datetime, overlap_hours: int = params.SYNC_OVERLAP_HOURS) -> dict[str, str]:
    """Bronze, silver and gold of one scheduled run, in this order.

    The tables that the warehouse needs are synced into bronze unless the sync job already did so under
    this run id.  Silver takes up what changed in bronze since its last run (``run_silver``), so that rows
    that moved between keys or lost theirs are right without a look at the unchanged ones; gold
    snapshots read the stored silver.  The silver state (J2, key ``silver.<fact>``) advances to
    ``as_of - overlap`` after all writes (I7).
    """
    from ambry.functions import ts_lit
    from ambry.operators.state import upsert_state
    from ambry.plans.sync import mapping_source, standard_mappings
    from ambry.plans.warehouse import GOLD_SNAPSHOTS, SILVER_FACTS, Warehouse

    mappings, given = dict(standard_mappings()), Tables(spark, sf_dir)
    logs = {n: RunLog(spark, f"{store}/{n}/_log") for n in WAREHOUSE_TABLES}
    todo = [n for n, log in logs.items() if not log.succeeded(run_id)]
    run_sync_all(spark, {n: (mapping_source(given, n, mappings[n]), mappings[n]) for n in todo}, store, run_id, as_of)
    bronze = Frames(spark, {n: read_version(spark, _bronze(store, n), log.last_version(run_id)) for n, log in logs.items()})

    state = _previous(spark, store, "_silver_state", run_id, spark.createDataFrame([], SILVER_STATE_SCHEMA))
    out = run_silver(spark, bronze, store, run_id)
    stored = {n: spark.read.parquet(p) for n, p in out.items()}
    known = facts(bronze)
    silver = {n: known[n].public(stored[n]) if n in known else stored[n] for n in SILVER_FACTS}
    dims = {n.removeprefix("dim_"): df for n, df in stored.items() if n.startswith("dim_")}
    dims["delivery_status"] = proxies.named_statuses(stored["delivery_statuses"].select("delivery_status_id"))
    wh = Warehouse(spark, sf_dir, as_of=as_of, tables=bronze).use_silver(silver).use_dims(dims)
    for g in GOLD_SNAPSHOTS:
        out[g] = write_version(getattr(wh, g), f"{store}/gold.{g}", run_id)
    synced = as_of - _dt.timedelta(hours=overlap_hours)
    rows = spark.createDataFrame([("silver", f, None) for f in SILVER_FACTS], SILVER_STATE_SCHEMA) \
        .withColumn("last_synced_at", ts_lit(synced))
    out["_silver_state"] = write_version(upsert_state(state, rows, ["target_schema", "target_table"]),
                                         f"{store}/_silver_state", run_id)
    return out
