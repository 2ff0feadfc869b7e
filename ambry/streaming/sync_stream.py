"""Bronze sync as a Structured Streaming query.

The reference re-reads rows newer than a timestamp watermark (minus a 6-hour
overlap) on a schedule.  As a stream, the file source's checkpoint records
which input files were processed, so nothing is re-read and no overlap is
needed; each micro-batch is upserted (I1) into the target.

Micro-batch ``k`` reads target version ``k`` and writes version ``k + 1``,
then appends ``k + 1`` to the ``_commits`` table next to the versions.  A
batch retried after a failure reads the same input version and overwrites
the same, not yet used, output version, so the sink is idempotent
(exactly-once together with the checkpoint).  A restarted stream continues
with the next batch id, whose input version the previous batch wrote; the
initial version 0 is written only on the very first start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ambry.operators.schema_evolution import align_to_target, evolve_schema, evolve_table
from ambry.operators.upsert import upsert
from ambry.operators.versioned import exists, read_version, write_version
from ambry.plans.sync import TableMapping


def _commits_path(target_root: str) -> str:
    return f"{target_root.rstrip('/')}/_commits"


def _record(spark: SparkSession, target_root: str, version: int) -> None:
    (spark.range(1).select(F.lit(version).alias("version"))
     .write.mode("append").parquet(_commits_path(target_root)))


def latest_version(spark: SparkSession, target_root: str) -> int | None:
    if not exists(spark, _commits_path(target_root)):
        return None
    return spark.read.parquet(_commits_path(target_root)).agg(F.max("version")).first()[0]


class StreamSync:
    """A running stream and the folder of the target versions it commits."""

    def __init__(self, target_root: str):
        self.query: StreamingQuery | None = None
        self.target_root = target_root

    def latest(self, spark: SparkSession) -> DataFrame:
        return read_version(spark, self.target_root, latest_version(spark, self.target_root))


def start_stream_sync(spark: SparkSession, source_dir: str, initial_target: DataFrame,
                      mapping: TableMapping, target_root: str, checkpoint: str,
                      max_files_per_trigger: int | None = None,
                      available_now: bool = True) -> StreamSync:
    """Start (or restart) the stream; version 0 of the target is ``initial_target``."""
    if latest_version(spark, target_root) is None:
        write_version(initial_target, target_root, 0)
        _record(spark, target_root, 0)
    handle = StreamSync(target_root)
    source_schema = spark.read.parquet(source_dir).schema
    reader = spark.readStream.schema(source_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        current = read_version(s, target_root, batch_id)
        schema = evolve_schema(current.schema, batch.schema)
        new = upsert(evolve_table(current, schema), align_to_target(batch, schema),
                     mapping.pk, mapping.ts_column)
        write_version(new, target_root, batch_id + 1, sort_by=[mapping.ts_column])
        _record(s, target_root, batch_id + 1)

    w = stream.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    handle.query = w.start()
    return handle
