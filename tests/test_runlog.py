"""The run log: events are only appended, state and versions are folded from them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ambry import params
from ambry.operators.runlog import LOG_SCHEMA, RunLog, fold
from ambry.operators.state import DESCRIBED, MEASURED
from ambry.plans.jobs import run_sync, sync_state
from ambry.plans.sync import TableMapping

W = dt.datetime(2024, 1, 1)
M = TableMapping("t", "t", ["id"], "ts", extra={"table_no": 3, "source_conn_id": "ops"})


def rows(spark, *ids, v="a", day=1):
    return spark.createDataFrame([(i, v, W + dt.timedelta(days=day)) for i in ids], "id int, v string, ts timestamp_ntz")


def boom(df):
    return df.withColumn("v", F.when(F.col("id") == 1, F.raise_error(F.lit("boom " * 400))).otherwise(F.col("v")))


def test_run_crash_run(spark, tmp_path):
    store = str(tmp_path)
    at = [W + dt.timedelta(days=d) for d in (2, 3, 4, 5)]
    run_sync(spark, rows(spark, 1, 2), M, store, 20260101, at[0])
    with pytest.raises(Exception, match="boom"):
        run_sync(spark, boom(rows(spark, 1, 3, day=3)), M, store, 20260102, at[1])
    log = RunLog(spark, f"{store}/_log")
    s = log.state().first()
    assert (s.status, s.run_id, s.version, s.last_synced_at, s.last_source_row_count) == ("FAILED", 20260102, 20260101, at[0] - dt.timedelta(hours=6), 2)
    assert s.last_error.startswith("org.apache") or "boom" in s.last_error
    assert len(s.last_error) == params.ERROR_TEXT_LIMIT
    # a process that dies leaves RUNNING only, and maybe a table that was written whole
    log.append(20260103, 4, log.status_row(M.described(), "RUNNING", at[2]))
    rows(spark, 99).write.parquet(f"{store}/bronze.t/v20260103")
    s = log.state().first()
    assert (s.status, s.version, s.last_synced_at) == ("RUNNING", 20260101, at[0] - dt.timedelta(hours=6))
    path, _ = run_sync(spark, rows(spark, 1, 2).unionByName(rows(spark, 3, day=3)), M, store, 20260104, at[3])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]    # not 99
    s = log.state().first()
    assert [s[c] for c in DESCRIBED] == ["bronze.t", 3, "ops", "source", "public", "t", None, "dw", "bronze", "t", "id", "ts"]
    assert (s.status, s.version, s.last_error, s.last_source_row_count) == ("SUCCESS", 20260104, None, 1)
    assert [(r.run_id, r.status) for r in log.events().orderBy("seq").collect()] == [
        (20260101, "RUNNING"), (20260101, "SUCCESS"), (20260102, "RUNNING"), (20260102, "FAILED"), (20260103, "RUNNING"),
        (20260104, "RUNNING"), (20260104, "SUCCESS")]
    assert log.versions(20260101, 20260104) == [20260104] and log.last_version(20260103) == 20260101
    assert log.succeeded(20260104) and not log.succeeded(20260102)


def test_a_run_is_repeated_under_its_id(spark, tmp_path):
    store = str(tmp_path)
    run_sync(spark, rows(spark, 1), M, store, 0, W + dt.timedelta(days=2))
    for v in ("b", "c"):    # the second attempt starts from version 0 as the first did
        path, log = run_sync(spark, rows(spark, 1, v=v, day=3), M, store, 1, W + dt.timedelta(days=4))
        assert [r.v for r in spark.read.parquet(path).collect()] == [v]
    assert sync_state(spark, log).first().last_source_row_count == 1


def test_fold_without_a_success_and_over_targets(spark):
    described = lambda t: tuple(None if c != "target_table" else t for c in DESCRIBED)
    event = lambda run, seq, t, status, at, wm=None, n=None, v=None: (run, seq, v, *described(t), wm, wm, n, n, status, None, at)
    events = spark.createDataFrame([event(0, 0, "a", "RUNNING", W), event(0, 1, "A", "SUCCESS", W, W, 5, 0), event(1, 2, "a", "RUNNING", W + dt.timedelta(1)),
                                    event(0, 0, "b", "RUNNING", W), event(0, 1, "b", "FAILED", W)], LOG_SCHEMA)
    got = {r.target_table.lower(): r for r in fold(events).collect()}
    assert (got["a"].status, got["a"].last_synced_at, got["a"].last_source_row_count, got["a"].version) == ("RUNNING", W, 5, 0)
    assert (got["b"].status, got["b"].last_synced_at, got["b"].last_target_row_count, got["b"].version) == ("FAILED", params.DEFAULT_WATERMARK, 0, None)
    assert set(MEASURED) < set(fold(events).columns)
