"""Numbered versions of a small state, each one file that appears in one rename."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from goldspan.session import path_exists, remove_path

State = dict[str, Any]


class Manifest:
    """The state of a table, as the latest version below ``folder`` has it; ``start`` before there is one.

    A version appears after the files it names and all at once, so a reader, a
    restart or a replayed step finds the table as of some version, whatever
    failed meanwhile.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, start: State):
        self.spark, self.folder, self.schema, self.start = spark, folder, schema, start

    def versions(self) -> dict[int, State]:
        """Those that are still there, by number."""
        if not path_exists(self.spark, self.folder):
            return {}
        found = self.spark.read.schema(f"{self.schema}, version int").json(self.folder).collect()
        return {r["version"]: {k: v for k, v in r.asDict().items() if k != "version"} for r in found}

    def latest(self) -> tuple[int, State]:
        versions = self.versions()
        number = max(versions, default=0)
        return number, versions.get(number, self.start)

    def publish(self, change: Callable[[State], State]) -> tuple[int, State]:
        """Writes the next version, made from the latest one; made anew if another writer was faster."""
        for _ in range(20):
            number, before = self.latest()
            after = change(before)
            row = [tuple(after[k] for k in self.start)]
            try:
                self.spark.createDataFrame(row, self.schema).coalesce(1).write.mode("errorifexists").json(f"{self.folder}/version={number + 1}")
                return number + 1, after
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                if self.latest()[0] == number:  # a version that was begun and never ended
                    self.remove(number + 1)
        raise RuntimeError(f"{self.folder}: other writers were always faster")

    def remove(self, number: int) -> None:
        remove_path(self.spark, f"{self.folder}/version={number}")
