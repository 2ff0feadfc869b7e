"""Read the given Parquet tables.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers simply select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Frames:
    """Attribute access to given frames, by table name, in place of ``Tables``."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        self.spark = spark
        self.frames = frames

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["frames"][name]
        except KeyError:
            raise AttributeError(name) from None


class Tables:
    """Attribute access to the tables of one scale-factor folder.

    Each table is opened once per instance (one file listing and footer
    read), and every use shares the same relation.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._open: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name not in self._open:
                self._open[name] = read_table(self.spark, self.sf_dir, name)
            return self._open[name]
        raise AttributeError(name)
