"""Versioned Parquet tables: the write half of an upsert without MERGE.

Spark cannot overwrite a table it is reading, so every upsert writes the new
state as a new version folder and the run id (or stream batch id) names the
version.  A version is only read by the next run, never by the run writing
it, so a failed run is retried by writing the same version again
(``overwrite`` of a folder nobody reads yet).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v{version:06d}"


def write_version(df: DataFrame, root: str, version: int, sort_by: list[str] | None = None,
                  partition_by: list[str] | None = None) -> str:
    """Write one version; ``sort_by`` (e.g. the ts column) keeps Parquet
    row-group min/max tight so later watermark scans skip most row groups."""
    path = version_path(root, version)
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there; any other trouble with its store is raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def last_version(spark: SparkSession, root: str, before: int) -> int | None:
    """The newest version below ``before`` that was written whole.  The folder is listed once."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    found = sorted((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), reverse=True)
    return next((v for v in found if v < before and exists(spark, f"{version_path(root, v)}/_SUCCESS")), None)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(version_path(root, version))
