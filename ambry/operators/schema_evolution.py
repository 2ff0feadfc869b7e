"""Target schema creation and additive evolution.

The target only ever gains columns: a source column unknown to the target is
appended (nullable, old rows NULL); nothing is dropped, renamed, widened or
reordered.  Changed rows are then projected onto the target layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType


def create_target_schema(source_schema: StructType, pk: list[str]) -> StructType:
    """Target layout from the source layout; keys are NOT NULL."""
    return StructType([StructField(f.name, f.dataType, f.nullable and f.name not in pk, f.metadata)
                       for f in source_schema.fields])


def evolve_schema(target_schema: StructType, source_schema: StructType) -> StructType:
    """Append source columns missing from the target (nullable)."""
    have = {f.name for f in target_schema.fields}
    added = [StructField(f.name, f.dataType, True, f.metadata)
             for f in source_schema.fields if f.name not in have]
    return StructType(list(target_schema.fields) + added)


def evolve_table(target: DataFrame, new_schema: StructType) -> DataFrame:
    """Existing target rows under the evolved layout (new columns NULL)."""
    have = set(target.columns)
    return target.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in new_schema.fields])


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def align_to_target(rows: DataFrame, target_schema: StructType) -> DataFrame:
    """Target column order, casts, JSON encoding, missing → NULL.

    Struct and map values become JSON text when the target column is a
    string; arrays become JSON text only for JSON-flagged target columns
    (``metadata={'json': True}``) and otherwise stay arrays.  Source columns
    unknown to the target are ignored.
    """
    src = {f.name: f.dataType for f in rows.schema.fields}
    cols = []
    for f in target_schema.fields:
        if f.name not in src:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata))
            continue
        c, st = F.col(f.name), src[f.name]
        if isinstance(f.dataType, StringType) and (
                isinstance(st, (StructType, MapType))
                or (isinstance(st, ArrayType) and f.metadata.get("json"))):
            c = F.to_json(c)
        elif st != f.dataType:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata))  # the JSON flag stays with the stored table
    return rows.select(*cols)
