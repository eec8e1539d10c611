"""How a query is declared: a function of the tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The tables of one folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def view(self, *names: str) -> SparkSession:
        """Register tables as views of the session and return it."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
        return self.spark


@dataclass(frozen=True)
class Job:
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(Tables(spark, sf_dir))


JOBS: dict[str, Job] = {}


def job(name: str, sql: str | None = None):
    """Register a query; ``sql`` is left out where SQL cannot say the same."""
    def register(fn):
        if name in JOBS:
            raise ValueError(f"{name} is registered twice")
        JOBS[name] = Job(fn, sql)
        return fn
    return register
