"""Query extract with positional load (A3).

The reference runs a SQL text on the source and inserts the result rows into
the target by column position.  Here the SQL runs on Spark over named input
frames, and the result is mapped onto the target contract by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ambry.operators.contracts import apply_contract


def extract_and_load(spark: SparkSession, sql: str, inputs: dict[str, DataFrame],
                     target: StructType, table: str) -> DataFrame:
    for name, df in inputs.items():
        df.createOrReplaceTempView(name)
    return apply_contract(spark.sql(sql), target, table, positional=True)
