"""Read-only SQL over registered tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException, ParseException


# functions that call any static method of the JVM
REFLECTION = {"reflect", "java_method", "try_reflect"}


class TableNotFound(LookupError):
    pass


def _functions(plan) -> set[str]:
    """The functions that a parsed plan calls, sub-queries included, in lower case and without their schemas."""
    found = set()

    def look(node: dict) -> dict:
        if str(node.get("class", "")).endswith(".UnresolvedFunction"):
            found.add(node["nameParts"].strip("[]").split(", ")[-1].lower())
        return node

    json.loads(plan.toJSON(), object_hook=look)
    return found


def check_select(spark: SparkSession, query: str) -> str:
    """The query without a closing semicolon, if it is one SELECT or WITH query.

    Spark's own parser decides: whatever cannot stand as a sub-query (inserts,
    drops, settings, a second statement) is refused, and so are calls of JVM
    methods, by what the parser found and not by the text.
    """
    text = query.strip().removesuffix(";").strip()
    if not text:
        raise ValueError("the query is empty")
    if text.split(None, 1)[0].split("(")[0].upper() not in ("SELECT", "WITH"):
        raise ValueError("only SELECT and WITH queries are allowed")
    inside = f"SELECT * FROM (\n{text}\n) AS _q"
    try:
        called = _functions(spark._jsparkSession.sessionState().sqlParser().parsePlan(inside))
    except ParseException as error:
        raise ValueError("only one SELECT or WITH query is allowed") from error
    if called & REFLECTION:
        raise ValueError(f"{', '.join(sorted(called & REFLECTION))} is not allowed in a query")
    try:
        spark.sql(inside)
    except AnalysisException as error:
        # duplicate output names are fine for a query, not for a sub-query
        if "AMBIGUOUS" not in str(error.getCondition()) and "ALREADY_EXISTS" not in str(error.getCondition()):
            raise
    return text


def run_sql(spark: SparkSession, query: str, database: str | None = None, **tables: DataFrame) -> DataFrame:
    """Run a SELECT with the given frames usable in it by name.

    Other names are looked up in ``database``. Names are resolved here, at
    once, so the session's own database is back when this returns.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    before = spark.catalog.currentDatabase()
    if database is not None:
        spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(check_select(spark, query))
    finally:
        spark.catalog.setCurrentDatabase(before)


class TableCache:
    """Named frames of a session, with SELECT-only access."""

    def __init__(self, spark: SparkSession, frames: list[tuple[DataFrame, str]] = ()):
        self.spark = spark
        self._kept: dict[str, DataFrame] = {}
        self.add_many(frames)

    def _known(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def add(self, name: str, df: DataFrame, keep: bool = False) -> None:
        """Add or replace a table; ``keep`` caches its rows on the executors until it goes."""
        self._release(name)
        if keep:
            self._kept[name] = df.persist()
        df.createOrReplaceTempView(name)

    def add_many(self, frames: list[tuple[DataFrame, str]], keep: bool = False) -> None:
        for df, name in frames:
            self.add(name, df, keep)

    def append(self, name: str, df: DataFrame) -> None:
        """Rows in the existing table's columns; further columns of ``df`` are left out."""
        if not self._known(name):
            raise TableNotFound(f"table {name!r} does not exist")
        existing = self.spark.table(name)
        missing = [c for c in existing.columns if c not in df.columns]
        if missing:
            raise ValueError(f"cannot append to {name!r}: columns {missing} are missing")
        keep = name in self._kept
        self.add(name, existing.unionByName(df.select(*existing.columns)), keep)

    def _release(self, name: str) -> None:
        if name in self._kept:
            self._kept.pop(name).unpersist()

    def delete(self, name: str) -> None:
        self._release(name)
        self.spark.catalog.dropTempView(name)

    def query(self, query: str) -> DataFrame:
        return self.spark.sql(check_select(self.spark, query))

    def close(self, names: list[str]) -> None:
        for name in names:
            self.delete(name)
