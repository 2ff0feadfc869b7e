"""The trailing-week snapshots as streaming aggregates (G7, G8; ours).

Order-status rows are counted per day and status as they arrive, in event time: a
day's counts are updated for as long as rows of it may come, and leave the state once the
watermark has passed them, so the state never holds more than the days in reach.  The
updated counts of a micro-batch replace those of their days in a small table; both
snapshots read the table's last days.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ambry.functions import days_before, ts_lit
from ambry.operators.versioned import last_version, read_version, write_version

SCHEMA = "day DATE, delivery_status_id INT, orders BIGINT"


def start_daily_counts(spark: SparkSession, stream: DataFrame, table_root: str, checkpoint: str, reach_days: int = 8,
                       available_now: bool = True) -> StreamingQuery:
    """Count ``stream`` (timestamp_at, delivery_status_id) per day and status into the versioned table
    at ``table_root``; rows more than ``reach_days`` behind the newest are too late and are left out.

    Micro-batch k writes version k from the newest version below it, so a batch that is repeated
    after a failure overwrites what it left.
    """
    # event time must be a TIMESTAMP; the session's time zone is UTC (session.BASE_CONF), where days are as they were
    counts = (stream.withColumn("timestamp_at", F.col("timestamp_at").cast("timestamp")).withWatermark("timestamp_at", f"{reach_days} days")
              .groupBy(F.window("timestamp_at", "1 day"), F.col("delivery_status_id"))
              .agg(F.count(F.lit(1)).alias("orders"))
              .select(F.to_date("window.start").alias("day"), F.col("delivery_status_id").cast("int").alias("delivery_status_id"), "orders"))

    def put(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        last = last_version(s, table_root, batch_id)
        old = s.createDataFrame([], SCHEMA) if last is None else read_version(s, table_root, last)
        # a day and status once each: the update if there is one.  Both are small and meet in one partition before they
        # are grouped: one task that groups partition after partition keeps the memory of each until it ends
        both = old.withColumn("new", F.lit(0)).unionByName(batch.withColumn("new", F.lit(1))).repartition(1)
        kept = both.groupBy("day", "delivery_status_id").agg(F.max_by("orders", "new").alias("orders"))
        write_version(kept, table_root, batch_id)

    w = counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def daily_counts(spark: SparkSession, table_root: str) -> DataFrame:
    last = last_version(spark, table_root, 1 << 62)
    return spark.createDataFrame([], SCHEMA) if last is None else read_version(spark, table_root, last)


def status_last_days(counts: DataFrame, as_of: _dt.datetime, days: int = 7) -> DataFrame:
    """G7 from the daily counts; ``as_of`` is a midnight."""
    return counts.where(F.col("day") >= F.to_date(days_before(as_of, days))).select("day", "delivery_status_id", "orders")


def aging_last_days(counts: DataFrame, as_of: _dt.datetime, days: int = 7, delivered: int = 1) -> DataFrame:
    """G8 from the daily counts."""
    age = F.datediff(F.to_date(ts_lit(as_of)), "day")
    bucket = F.when(age <= 1, "0-1").when(age <= 3, "2-3").when(age <= 7, "4-7")
    return (status_last_days(counts, as_of, days).where(F.col("delivery_status_id") != delivered)
            .groupBy(bucket.alias("age_bucket")).agg(F.sum("orders").alias("orders")))
