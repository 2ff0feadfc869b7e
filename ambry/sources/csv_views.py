"""View-count CSV source.

Rows must have exactly two fields and both must parse as integers after
trimming; everything else is dropped silently.  The header line is skipped.
The parse is built-in expressions only (``try_cast``), no Python per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = "product_id STRING, view_count STRING"


def read_view_counts(spark: SparkSession, path: str) -> DataFrame:
    raw = (spark.read.schema(RAW)
           .option("header", "true")
           .option("mode", "DROPMALFORMED")     # short and long rows
           .option("enforceSchema", "true")
           .csv(path))
    parsed = raw.select(
        F.expr("try_cast(trim(product_id) AS INT)").alias("product_id"),
        F.expr("try_cast(trim(view_count) AS INT)").alias("view_count"))
    # the stage has no key; product_stats checks its own
    return parsed.where(F.col("product_id").isNotNull() & F.col("view_count").isNotNull())


def write_csv_lines(lines: DataFrame, path: str, header: str = "product_id,view_count") -> None:
    """Write pre-formatted text lines as CSV files, each with the header."""
    (lines.select(F.col("line").alias(header))
     .write.mode("overwrite").option("header", "true").option("sep", "\t")
     .option("quote", "\u0001").option("escapeQuotes", "false")
     .option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
