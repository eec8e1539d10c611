"""Records in the forms a sender may hold them in."""

from __future__ import annotations

import functools
import json
import math
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: all fields, the wider number, else text. Whole numbers that a double
    would change are seen to by ``exact_type``."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        types = {f.name: f.dataType for f in a}
        for field in b:
            types[field.name] = common_type(types.get(field.name, field.dataType), field.dataType)
        return StructType([T.StructField(name, kind) for name, kind in types.items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _open_nulls(kind: T.DataType, value) -> T.DataType:
    """``kind`` with no type yet where the value is null: other records have their say."""
    if value is None:
        return T.NullType()
    if isinstance(kind, StructType):
        return StructType([T.StructField(f.name, _open_nulls(f.dataType, value[f.name])) for f in kind])
    return T.ArrayType(T.NullType()) if isinstance(kind, T.ArrayType) and all(v is None for v in value) else kind


def _closed(kind: T.DataType) -> T.DataType:
    """What is null in every record is text."""
    if isinstance(kind, StructType):
        return StructType([T.StructField(f.name, _closed(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_closed(kind.elementType))
    return T.StringType() if isinstance(kind, T.NullType) else kind


def exact_type(kind: T.DataType, values: list) -> T.DataType:
    """``kind`` with every double that would change one of the whole numbers among ``values`` replaced by a decimal that
    holds them all, or by text where 38 digits do not."""
    if isinstance(kind, StructType):
        found = [v for v in values if isinstance(v, dict)]
        return StructType([T.StructField(f.name, exact_type(f.dataType, [v[f.name] for v in found if f.name in v])) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(exact_type(kind.elementType, [x for v in values if isinstance(v, list) for x in v]))
    numbers = [v for v in values if isinstance(v, (int, float)) and not isinstance(v, bool)]
    if isinstance(kind, T.LongType):
        if all(-(1 << 63) <= v < 1 << 63 for v in numbers):
            return kind
        return T.DecimalType(38, 0) if all(abs(v) < 10 ** 38 for v in numbers) else T.StringType()
    if not isinstance(kind, T.DoubleType) or not any(isinstance(v, int) and (abs(v) > 1 << 1023 or int(float(v)) != v) for v in numbers):
        return kind
    parts = [Decimal(repr(v)).normalize().as_tuple() for v in numbers if not isinstance(v, float) or math.isfinite(v)]
    scale = max(0, *(-p.exponent for p in parts))
    whole = max(len(p.digits) + p.exponent for p in parts)
    finite = all(not isinstance(v, float) or math.isfinite(v) for v in numbers)
    return T.DecimalType(38, scale) if finite and max(0, whole) + scale <= 38 else T.StringType()


def records_frame(spark: SparkSession, data, schema: StructType | str | None = None) -> DataFrame:
    """One frame from a JSON text, a dict, a list of dicts, a pandas or a Spark frame.

    Records may differ: the frame has every field of every record, in a type
    that holds all its values. The Python forms are small hand-held payloads. Bulk JSON belongs in files
    or in a text column: see ``json_column``.
    """
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, str):
        data = json.loads(data)
    if isinstance(data, dict):
        data = [data]
    if isinstance(data, list):
        if not data:
            return spark.createDataFrame([], schema or StructType([]))
        texts = spark.createDataFrame([(json.dumps(d),) for d in data], "record string")
        if schema is None:
            from goldspan.operators.schema import infer_from_sample
            schema = exact_type(_closed(functools.reduce(common_type, (_open_nulls(infer_from_sample(d), d) for d in data))), data)
        return json_column(texts, "record", schema)
    return spark.createDataFrame(data, schema=schema)


def json_column(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """Text rows holding one JSON object each, as typed columns."""
    return df.select(F.from_json(F.col(column), schema).alias("_r")).select("_r.*")


def empty_typed(spark: SparkSession, fields: dict[str, str]) -> DataFrame:
    """No rows, with a model's columns; nested and object fields are kept as text."""
    from goldspan.operators.schema import spark_type
    ddl = ", ".join(f"`{name}` {spark_type(kind)}" for name, kind in fields.items())
    return spark.createDataFrame([], ddl)
