"""Typed load of a catalog-described source, with what doesn't fit in a second output.

Raw values come as text.  The catalog's listing of the columns decides each type,
``try_cast`` does the casts in one pass, and a row with any value that doesn't fit goes
to the rejects instead, one row per bad column with the value and the reason; a load never
fails and never loses a row silently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from ambry.functions.types import is_json, struct_field
from ambry.operators.materialize import materialize

_BAD = "__bad"


def _length(desc: dict) -> int | None:
    n = desc.get("character_maximum_length", desc.get("char_max_length"))
    return int(n) if n else None


def _checked(desc: dict) -> tuple[Column, list[tuple[Column, str]]]:
    """A column's typed value, and (condition, reason) of what rejects its row."""
    field = struct_field(desc)
    raw = F.col(f"`{field.name}`").cast("string")
    reasons = []
    if is_json(desc):
        value = raw
        reasons.append((raw.isNotNull() & F.try_parse_json(raw).isNull(), "not JSON"))
    elif isinstance(field.dataType, StringType):
        value = raw
        if n := _length(desc):
            reasons.append((F.char_length(raw) > n, f"longer than {n}"))
    elif isinstance(field.dataType, BinaryType):
        value = F.try_to_binary(raw, F.lit("hex"))
    else:
        value = F.trim(raw).try_cast(field.dataType)
    if not isinstance(field.dataType, StringType):
        reasons.append((raw.isNotNull() & value.isNull(), f"not {field.dataType.simpleString()}"))
    if not field.nullable:
        reasons.append((raw.isNull(), "is NULL"))
    return value.alias(field.name, metadata=field.metadata), reasons


@dataclass
class TypedLoad:
    """``rows``: the rows that fit, typed; ``rejects``: the key columns as text, column, reason, value."""
    rows: DataFrame
    rejects: DataFrame


def schema_of(catalog: list[dict]) -> StructType:
    return StructType([struct_field(d) for d in catalog])


def typed_load(raw: DataFrame, catalog: list[dict], keys: list[str]) -> TypedLoad:
    """``raw`` typed by ``catalog`` (one description a column, as a catalog lists them).

    The raw rows are read once and written with their verdict; columns that the catalog doesn't name
    are left out, and those that ``raw`` lacks fail the load.
    """
    missing = [d["column_name"] for d in catalog if d["column_name"] not in raw.columns]
    if missing:
        raise ValueError(f"not in the source: {missing}")
    checked = [(d["column_name"], *_checked(d)) for d in catalog]
    bad = [F.when(F.coalesce(when, F.lit(False)), F.struct(F.lit(name).alias("column"), F.lit(reason).alias("reason"),
                                                           F.col(f"`{name}`").cast("string").alias("value")))
           for name, _, reasons in checked for when, reason in reasons]
    found = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast("array<struct<column:string,reason:string,value:string>>")
    tagged = raw.select(F.struct(*[F.col(f"`{k}`").cast("string").alias(k) for k in keys]).alias("__key"), found.alias(_BAD),
                        *[value for _, value, _ in checked])
    tagged = materialize(tagged, "typed-load")
    rows = tagged.where(F.size(_BAD) == 0).select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in schema_of(catalog)])
    rejects = (tagged.where(F.size(_BAD) > 0).select("__key.*", F.explode(_BAD).alias("b"))
               .select(*keys, "b.column", "b.reason", "b.value"))
    return TypedLoad(rows, rejects)
