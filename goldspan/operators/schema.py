"""Schemas: inferred from samples or from whole columns, compared, enforced."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.names import FIELD_TYPES

_SCALARS = [
    # bool before int: a Python bool is an int too
    (bool, T.BooleanType()),
    (int, T.LongType()),
    (float, T.DoubleType()),
    (str, T.StringType()),
    (datetime.datetime, T.TimestampType()),
]


def spark_type(declared: str) -> str:
    """Spark type of a declared field type; nested and object fields become text."""
    return FIELD_TYPES.get(declared.lower(), "string")


def _type_of(value: Any) -> T.DataType:
    if value is None:
        return T.StringType()
    if hasattr(value, "item") and not isinstance(value, (list, dict)):
        value = value.item()  # a numpy scalar
    for python_type, spark in _SCALARS:
        if isinstance(value, python_type):
            return spark
    if isinstance(value, Mapping):
        return infer_from_sample(value)
    if isinstance(value, list):
        kinds = [_type_of(v) for v in value]
        if not kinds or any(type(k) is not type(kinds[0]) for k in kinds):
            return T.ArrayType(T.StringType())  # empty or mixed: text
        return T.ArrayType(kinds[0])
    raise TypeError(f"no field type for {type(value).__name__}")


def infer_from_sample(record: Mapping[str, Any]) -> T.StructType:
    """Schema of one sample record: nulls are text, a list has its first item's type."""
    return T.StructType([T.StructField(name, _type_of(value)) for name, value in record.items()])


def infer_json_column(df: DataFrame, column: str) -> DataFrame:
    """One row ``schema``: the type that holds every JSON text of a column.

    The aggregate merges types on the executors, so drift anywhere in the
    column is seen, not just in the first record. Broken texts are left out.
    """
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column))).alias("schema"))


def check_crosswalk(columns: list[str], crosswalk: list[str]) -> list[str]:
    """The crosswalk fields, if each is a text naming a column."""
    for field in crosswalk:
        if not isinstance(field, str):
            raise TypeError(f"crosswalk field {field!r} must be a string")
        if field not in columns:
            raise ValueError(f"crosswalk field {field!r} is not in the record")
    return list(crosswalk)


def staging_schema(record: Mapping, staging: str, crosswalk: list[str],
                   flexible: bool = False, export: bool = False) -> dict:
    """Declaration of a staging table: its fields and the crosswalk named after it."""
    return {
        "mdmStagingType": staging,
        "mdmCrosswalkTemplate": {
            "mdmCrossreference": {staging: check_crosswalk(list(record), crosswalk)}},
        "mdmStagingMapping": {"schema": infer_from_sample(record).simpleString()},
        "mdmFlexible": flexible,
        "mdmExportData": export,
    }


def model_types(fields: list[Mapping]) -> dict:
    """Field tree -> {name: type}; nested and object fields hold a dict of their own."""
    out = {}
    for field in fields:
        kind = field["mdmMappingDataType"].upper()
        inside = field.get("mdmFields") or []
        out[field["mdmName"]] = model_types(inside) if kind in ("NESTED", "OBJECT") else kind.lower()
    return out


def declared_fields(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(dotted name, type name) of every leaf of a Spark schema."""
    out = []
    for field in schema:
        name, kind = prefix + field.name, field.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            out += declared_fields(kind, name + ".")
        else:
            out.append((name, kind.simpleString()))
    return out


def enforce(df: DataFrame, types: Mapping[str, str], errors: str = "mdmErrors") -> DataFrame:
    """Columns cast to the declared types; a bad value becomes null plus an error entry.

    An existing error list is kept in front of the new entries.
    """
    casts: dict[str, Column] = {}
    found: list[Column] = [F.col(errors)] if errors in df.columns else []
    nothing = F.array().cast("array<string>")
    for name, declared in types.items():
        if name not in df.columns:
            casts[name] = F.lit(None).cast(spark_type(declared))
            continue
        casts[name] = F.col(name).try_cast(spark_type(declared))
        bad = F.col(name).isNotNull() & casts[name].isNull()
        found.append(F.when(bad, F.array(F.lit(f"TYPE:{name}"))).otherwise(nothing))
    others = [F.col(c) for c in df.columns if c not in casts and c != errors]
    return df.select(
        *others, *[c.alias(n) for n, c in casts.items()], F.concat(nothing, *found).alias(errors))


def model_from_sample(record: Mapping, catalog: Mapping[str, str], ignore_field_type: bool = False) -> list[dict]:
    """What creating a model from a sample would do, one report row per field.

    Names are lower-cased; list and object fields are refused; a field that the
    catalog already has under another type is a conflict unless told to ignore
    it. An action is create, reuse, conflict or refused.
    """
    report = []
    for original, value in record.items():
        name = original.lower()
        kind = _type_of(value)
        declared = {"bigint": "long", "timestamp": "date"}.get(kind.simpleString(), kind.simpleString())
        if isinstance(kind, (T.ArrayType, T.StructType)):
            action, declared = "refused", "nested"
        elif name not in catalog:
            action = "create"
        elif catalog[name].lower() == declared or ignore_field_type:
            action = "reuse"
        else:
            action = "conflict"
        report.append({"field": name, "type": declared, "action": action})
    return report


def compare_fields(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """Full outer join of two field lists (field, type): what is missing, extra or in conflict."""
    a = actual.select("field", F.col("type").alias("actual_type"))
    d = declared.select("field", F.col("type").alias("declared_type"))
    status = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("declared_type").isNull(), "extra")
        .when(F.col("actual_type") != F.col("declared_type"), "conflict")
        .otherwise("same")
    )
    return a.join(d, "field", "full").withColumn("status", status)
