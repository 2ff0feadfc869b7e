"""Cut lineage by writing a table into the shared checkpoint folder.

A written Parquet table survives executor loss, keeps column pruning and
filter push-down for every later reader, and is what the reference does at
the same points (it stores stage tables).  ``localCheckpoint`` is never used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambry import params
from ambry.session import scratch_path


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    # the schema is known: reading the files' footers would cost a job
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str) -> DataFrame:
    return _written(df, name)[0]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``, from the file system's own summary (no job)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def broadcast_if_small(df: DataFrame, name: str, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Write ``df`` once and broadcast it when its files have at most ``max_bytes``
    (``params.BROADCAST_MAX_BYTES``).

    For the small side of a join against a huge table (batch keys against a
    bronze target, touched keys against a source, dimensions of a star).  Left to AQE, both shuffle
    map stages would start together and the huge side would be shuffled
    before the join turns into a broadcast; deciding up front from the
    written copy's size (a proven bound that grows with the rows' width, and costs no job) avoids that.
    Beyond the bound the caller keeps a shuffled join.  Returns ``(side, broadcast)``.
    """
    m, path = _written(df, name)
    if stored_bytes(df.sparkSession, path) <= (params.BROADCAST_MAX_BYTES if max_bytes is None else max_bytes):
        return F.broadcast(m), True
    return m, False
