"""Bronze sync as a stream whose rows may come late, twice or out of order (ST1, J4; ours).

The scheduled sync reads an overlap of some hours again.  As a stream the overlap is
event time: the watermark trails the newest row by it, a row that comes again within it is
dropped by the state (``dropDuplicatesWithinWatermark``), and the state forgets what the
watermark has passed.  A micro-batch rewrites only the key ranges that it touches, and a row takes
the place of a stored one only if it isn't older, so that late arrivals give what a batch
over all rows would.  A micro-batch that is repeated after a failure gives the same table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ambry import params
from ambry.operators.materialize import materialize
from ambry.operators.ranges import upsert_touched_ranges, write_ranged
from ambry.operators.upsert import latest_per_key
from ambry.operators.versioned import exists
from ambry.plans.sync import TableMapping

_EVENT = "__event"


def start_late_sync(spark: SparkSession, stream: DataFrame, mapping: TableMapping, target: str, checkpoint: str,
                    key_range: int, overlap: _dt.timedelta = _dt.timedelta(hours=params.SYNC_OVERLAP_HOURS),
                    available_now: bool = True) -> StreamingQuery:
    """Keep the key-range partitioned table at ``target`` up to date with ``stream``.  Rows more than
    ``overlap`` behind the newest one are too late, as they are for the scheduled sync."""
    # event time must be a TIMESTAMP; the session's time zone is UTC
    fresh = (stream.withColumn(_EVENT, F.col(mapping.ts_column).cast("timestamp"))
             .withWatermark(_EVENT, f"{int(overlap.total_seconds())} seconds")
             .dropDuplicatesWithinWatermark([*mapping.pk, mapping.ts_column]).drop(_EVENT))

    def put(batch: DataFrame, _: int) -> None:
        s = batch.sparkSession
        if exists(s, f"{target}/_SUCCESS"):
            upsert_touched_ranges(s, target, batch, mapping.pk, mapping.ts_column, key_range, newer_only=True)
            return
        first = materialize(latest_per_key(batch, mapping.pk, mapping.ts_column), "late-batch")   # the stream's plan runs once
        if not first.isEmpty():
            write_ranged(first, target, mapping.pk[0], key_range)

    w = fresh.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
