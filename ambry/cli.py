"""Command line for scheduled runs (``spark-submit -m``-style entry point).

    python -m ambry.cli score     --sf-dir DIR --store DIR --run-id N [--as-of TS]
    python -m ambry.cli sync      --sf-dir DIR --store DIR --run-id N --as-of TS [--tables orders,...]
                                  [--key-range N | --reconcile N]
    python -m ambry.cli warehouse --sf-dir DIR --store DIR --run-id N --as-of TS

A scheduler (cron, a DAG runner) calls one of these per run with an
increasing ``--run-id``; each run reads version ``run_id - 1`` of its outputs
and writes version ``run_id`` under ``--store``.  The master and resources
come from spark-submit; nothing here is cluster specific.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from ambry import params


def _ts(s: str) -> _dt.datetime:
    return _dt.datetime.fromisoformat(s)


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="ambry")
    ap.add_argument("job", choices=["score", "sync", "warehouse"])
    ap.add_argument("--sf-dir", required=True, help="folder with the input Parquet tables")
    ap.add_argument("--store", required=True, help="folder for versioned outputs and state")
    ap.add_argument("--run-id", type=int, required=True)
    ap.add_argument("--as-of", type=_ts, default=None, help="run time (ISO), default per job")
    ap.add_argument("--mappings", default=None, metavar="FILE",
                    help="sync: a mapping file (sources/mappings); its source tables are read from --sf-dir by name")
    ap.add_argument("--tables", default=None, help="sync: comma-separated mapping names")
    ap.add_argument("--sources", default=None, metavar="DIR",
                    help="score: folder with operational tables of your own (plans/scoring_run.SOURCES), one Parquet table each")
    ap.add_argument("--window-days", type=int, default=params.ORDER_WINDOW_DAYS, help="score: days of order items")
    ap.add_argument("--batch-size", type=int, default=params.PUBLISH_BATCH_SIZE)
    ap.add_argument("--parallelism", type=int, default=4, help="sync: tables synced at once")
    ap.add_argument("--key-range", type=int, default=None,
                    help="sync: keep targets partitioned by key ranges of this size and rewrite "
                         "only touched ranges (default: a new full version per run)")
    ap.add_argument("--reconcile", type=int, default=None, metavar="KEYS",
                    help="sync: compare whole tables by digests of ranges of so many keys and repair what differs")
    ap.add_argument("--master", default=None, help="only for local use; spark-submit sets it")
    a = ap.parse_args(argv)

    from ambry.plans import jobs
    from ambry.plans.sync import mapping_source, standard_mappings
    from ambry.session import build_session
    from ambry.sources.tables import Tables

    spark = build_session(a.master, app=f"ambry-{a.job}")
    out: dict = {}
    if a.job == "score":
        from ambry.operators.versioned import exists
        from ambry.plans.scoring_run import SOURCES
        paths = {n: f"{a.sources}/{n}.parquet" for n in SOURCES} if a.sources else {}
        res = jobs.run_scoring(spark, a.sf_dir, a.store, a.run_id, a.as_of or params.AS_OF, batch_size=a.batch_size,
                               window_days=a.window_days, sources={n: spark.read.parquet(p) for n, p in paths.items() if exists(spark, p)})
        out = vars(res)
    elif a.job == "sync":
        t = Tables(spark, a.sf_dir)
        if a.mappings:
            from ambry.sources.mappings import load_mappings
            pairs = [(m.target_table, m, spark.read.parquet(f"{a.sf_dir}/{m.source_table}.parquet")) for m in load_mappings(a.mappings)]
        else:
            pairs = [(name, m, mapping_source(t, name, m)) for name, m in standard_mappings()]
        wanted = set(a.tables.split(",")) if a.tables else None
        sources = {name: (df, m) for name, m, df in pairs if wanted is None or name in wanted}
        if a.reconcile:
            out = {n: jobs.run_reconcile(spark, df, m, f"{a.store}/{n}", a.run_id, a.as_of or params.ORDERS_AS_OF, a.reconcile)[:2]
                   for n, (df, m) in sources.items()}
        else:
            out = jobs.run_sync_all(spark, sources, a.store, a.run_id, a.as_of or params.ORDERS_AS_OF,
                                    parallelism=a.parallelism, key_range=a.key_range)
    else:
        out = jobs.run_warehouse(spark, a.sf_dir, a.store, a.run_id, a.as_of or params.ORDERS_AS_OF)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
