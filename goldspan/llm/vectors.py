"""Vectors that can be compared with others of their length: not null, all components finite."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_whole(vector: str) -> Column:
    """Not null, not empty, and no component null, NaN or infinite."""
    value = F.col(vector)
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return value.isNotNull() & (F.size(value) > 0) & ~F.coalesce(odd, F.lit(True))


def widths(df: DataFrame, vector: str) -> dict[int, int]:
    """How many vectors there are of each length; one row for each length comes to the driver."""
    found = df.where(is_whole(vector)).groupBy(F.size(vector).alias("width")).agg(F.count(F.lit(1)).alias("many")).collect()
    return {r["width"]: r["many"] for r in sorted(found)}


def sample(df: DataFrame, ident: str, rows: int) -> pd.DataFrame:
    """At most ``rows`` rows, those whose ids have the least hashes; on the driver, as the number is fixed."""
    return df.orderBy(F.xxhash64(F.col(ident).cast("string")), ident).limit(rows).toPandas()


def matrix(column, dtype=np.float64) -> np.ndarray:
    """A column of equally long arrays as rows of a matrix."""
    return np.array([np.asarray(x, dtype) for x in column], dtype) if len(column) else np.zeros((0, 0), dtype)


def unpack(column, dtype, width: int) -> np.ndarray:
    """A column of byte strings as rows of a matrix."""
    return np.frombuffer(b"".join(column), dtype).reshape(-1, width)
