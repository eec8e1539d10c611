"""Deleting records without rewriting their files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.plans.filters import apply_filter
from goldspan.session import remove_path
from goldspan.sources.manifest import Manifest, State


class FoldedMeanwhile(RuntimeError):
    """Records were deleted while the table was being folded."""


class DeletableTable:
    """A parquet table below ``root`` whose records are marked as deleted by file and row.

    A delete writes the places of what it matches and nothing else; reading
    leaves these rows out by an anti-join; ``fold`` rewrites the files without
    them. A manifest names the files and the marks that count, so a delete shows
    as a whole, and so does a fold.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifest = Manifest(spark, f"{self.root}/manifests", "parts array<string>, marks array<string>", {"parts": [], "marks": []})

    def _new(self, kind: str) -> str:
        return f"{kind}/{uuid.uuid4().hex[:12]}"

    def append(self, df: DataFrame) -> None:
        part = self._new("parts")
        df.write.parquet(f"{self.root}/{part}")
        self.manifest.publish(lambda s: {**s, "parts": [*s["parts"], part]})

    def _live(self, state: State) -> DataFrame:
        """The records that are left, each with the file it lies in (below the root) and its row there."""
        if not state["parts"]:
            raise ValueError(f"{self.root} has no records yet")
        rows = self.spark.read.option("mergeSchema", str(len(state["parts"]) > 1).lower()).parquet(*[f"{self.root}/{p}" for p in state["parts"]])
        # the same path whatever the table's root is called from where
        file = F.concat_ws("/", F.slice(F.split("_metadata.file_path", "/"), -3, 3))
        placed = rows.withColumns({"_file": file, "_row": F.col("_metadata.row_index")})
        if not state["marks"]:
            return placed
        marks = self.spark.read.schema("_file string, _row long").parquet(*[f"{self.root}/{m}" for m in state["marks"]])
        return placed.join(marks, ["_file", "_row"], "left_anti")

    def read(self) -> DataFrame:
        return self._live(self.manifest.latest()[1]).drop("_file", "_row")

    def delete(self, query, tables: Mapping[str, DataFrame] | None = None) -> int:
        """Deletes every record the search matches; its values may come from other tables. Returns how many went.

        An undecided (null) match keeps the record. The table is read once.
        """
        mark = self._new("marks")
        matched = apply_filter(self._live(self.manifest.latest()[1]), query, tables).select("_file", "_row")
        matched.write.parquet(f"{self.root}/{mark}")
        gone = self.spark.read.parquet(f"{self.root}/{mark}").count()
        if gone:
            self.manifest.publish(lambda s: {**s, "marks": [*s["marks"], mark]})
        return gone

    def fold(self) -> None:
        """Writes what is left into new files and drops the old ones and the marks, but for those the last state needs.

        Fails, and changes nothing, when records are deleted meanwhile; what is appended meanwhile stays.
        """
        old = self.manifest.versions()
        number, before = self.manifest.latest()
        part = self._new("parts")
        self._live(before).drop("_file", "_row").write.parquet(f"{self.root}/{part}")

        def change(now: State) -> State:
            if now["marks"] != before["marks"]:
                raise FoldedMeanwhile(f"{self.root}: fold it again")
            return {"parts": [part, *[p for p in now["parts"] if p not in before["parts"]]], "marks": []}

        _, after = self.manifest.publish(change)
        needed = {x for s in (before, after) for x in (*s["parts"], *s["marks"])}
        for version, state in old.items():
            if version < number:
                for name in {*state["parts"], *state["marks"]} - needed:
                    remove_path(self.spark, f"{self.root}/{name}")
                self.manifest.remove(version)
