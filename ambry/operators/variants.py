"""Semi-structured columns as VARIANT.

Structs, maps and arrays of a source and JSON text of a target meet as VARIANT: parsed once,
described by one aggregate over all rows, read by typed paths, and written back as JSON text
where the target's column is flagged as JSON.  Equal values have equal text whatever the order
of their fields was, so a second run sees no change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType, VariantType

JSON = {"json": True}


def to_variant(c: Column, kind) -> Column:
    """A nested column, or JSON text, as VARIANT; text that is no JSON becomes NULL."""
    if isinstance(kind, VariantType):
        return c
    if isinstance(kind, StringType):
        return F.try_parse_json(c)
    return F.try_parse_json(F.to_json(c, {"ignoreNullFields": "false"}))


def nested_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)) or f.metadata.get("json")]


def as_variants(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``df`` with its nested and JSON columns as VARIANT."""
    names = nested_columns(df.schema) if columns is None else columns
    return df.withColumns({c: to_variant(F.col(c), df.schema[c].dataType) for c in names})


def as_json(df: DataFrame) -> DataFrame:
    """``df`` with its VARIANT columns as JSON text, flagged, fields in the order of their names."""
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name, metadata=JSON) if isinstance(f.dataType, VariantType) else F.col(f.name) for f in df.schema])


def json_target(schema: StructType) -> StructType:
    """The layout of a target that stores ``schema``'s nested columns as JSON text."""
    nested = set(nested_columns(schema))
    return StructType([StructField(f.name, StringType(), f.nullable, JSON) if f.name in nested else f for f in schema])


def described(df: DataFrame) -> DataFrame:
    """One row: the schema that all rows' values of each VARIANT column have in common."""
    names = [f.name for f in df.schema if isinstance(f.dataType, VariantType)]
    return df.agg(*[F.schema_of_variant_agg(c).alias(c) for c in names])


def extracted(df: DataFrame, paths: dict[str, tuple[str, str, str]]) -> DataFrame:
    """``df`` with a typed column for each name -> (VARIANT column, path, type); what doesn't fit is NULL."""
    return df.withColumns({name: F.try_variant_get(F.col(c), path, kind) for name, (c, path, kind) in paths.items()})
