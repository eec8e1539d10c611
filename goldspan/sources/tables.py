"""Catalog tables and stored step outputs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.session import path_exists, remove_path


def read_table(
    table: DataFrame,
    columns: list[str] | None = None,
    restriction: str | None = None,
    sample_percentage: float | None = None,
    seed: int = 0,
    sample_key: list[str] | None = None,
) -> DataFrame:
    """Rows a SQL condition keeps, a sample of them, and the named columns.

    Each option works alone; the restriction may use columns that are not kept.
    A row is in the sample if the first 32 bits of the MD5 of ``seed`` and its
    ``sample_key`` (all columns without one), joined by "|", are below the given
    share, so the sample does not depend on how the table is stored. Rows with
    equal keys stay or go together; nulls are left out of the joined text.
    """
    if restriction:
        table = table.where(restriction)
    if sample_percentage is not None:
        if not 0 <= sample_percentage <= 100:
            raise ValueError("sample_percentage is between 0 and 100")
        below = math.ceil(sample_percentage / 100 * 2**32)
        if below < 2**32:
            key = [F.col(c).cast("string") for c in sample_key] if sample_key else [F.to_json(F.struct("*"))]
            table = table.where(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *key)), 1, 8) < F.lit(f"{below:08x}"))
    return table.select(*columns) if columns else table


class StepOutputs:
    """Named step results kept as files: save, load, exists, remove."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str, form: str) -> str:
        if form not in ("parquet", "json"):
            raise ValueError(f"unsupported format {form!r}; parquet or json")
        return f"{self.root}/{name}.{form}"

    def save(self, df: DataFrame, name: str, form: str = "parquet") -> None:
        df.write.mode("overwrite").format(form).save(self._path(name, form))

    def load(self, name: str, form: str = "parquet", columns: list[str] | None = None, schema=None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        df = reader.format(form).load(self._path(name, form))
        return df.select(*columns) if columns else df

    def exists(self, name: str, form: str = "parquet") -> bool:
        return path_exists(self.spark, self._path(name, form))

    def remove(self, name: str, form: str = "parquet") -> bool:
        return remove_path(self.spark, self._path(name, form))
