"""Catalog type descriptors → Spark types (A17, SURVEY §1.3).

The reference maps PostgreSQL catalog descriptors to target DDL.  Sources
read through Spark already carry Spark types; this mapping serves sources
described by a catalog listing (e.g. a JDBC ``information_schema`` read).
"""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, BooleanType, DataType, DateType, DayTimeIntervalType,
                               DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               ShortType, StringType, StructField, TimestampNTZType,
                               TimestampType)

# Unbounded numeric has no Spark equivalent; this is our (lossy) choice.
UNBOUNDED_NUMERIC = DecimalType(38, 18)

# ---------------------------------------------------------------- fixed values
# Catalog type names and the Spark type each maps to.
SIMPLE_TYPES: dict[str, DataType] = {
    "integer": IntegerType(),
    "int4": IntegerType(),
    "bigint": LongType(),
    "int8": LongType(),
    "smallint": ShortType(),
    "int2": ShortType(),
    "boolean": BooleanType(),
    "timestamp with time zone": TimestampType(),
    "jsonb": StringType(),
    "json": StringType(),
    "date": DateType(),
    "double precision": DoubleType(),
    "real": FloatType(),
    "bytea": BinaryType(),
    "uuid": StringType(),
    "text": StringType(),
    "interval": DayTimeIntervalType(),
}
# ------------------------------------------------------------ end fixed values


def spark_type(desc: dict) -> DataType:
    """Spark type for one catalog column descriptor.

    ``desc`` has ``data_type`` and optionally ``numeric_precision``,
    ``numeric_scale``, ``character_maximum_length``, ``column_default``.
    A serial default (``nextval``) is an integer/bigint key.
    """
    t = str(desc.get("data_type", "")).lower().strip()
    default = str(desc.get("column_default") or "")
    if "nextval" in default:
        return LongType() if t in ("bigint", "int8") else IntegerType()
    if t in ("character varying", "varchar", "character", "char"):
        return StringType()
    if t in ("numeric", "decimal"):
        p, s = desc.get("numeric_precision"), desc.get("numeric_scale")
        return DecimalType(int(p), int(s or 0)) if p else UNBOUNDED_NUMERIC
    if t in SIMPLE_TYPES:
        return SIMPLE_TYPES[t]
    if t.startswith("timestamp"):
        return TimestampNTZType()
    if t == "array":
        raise ValueError("ARRAY column without element type; describe it with a Spark ArrayType")
    raise ValueError(f"unsupported catalog type {t!r}")


def is_json(desc: dict) -> bool:
    return str(desc.get("data_type", "")).lower() in ("json", "jsonb")


def struct_field(desc: dict) -> StructField:
    nullable = str(desc.get("is_nullable", "YES")).upper() != "NO"
    meta = {"json": True} if is_json(desc) else {}
    return StructField(desc["column_name"], spark_type(desc), nullable, meta)
