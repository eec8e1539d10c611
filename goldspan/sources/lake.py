"""The parquet lake: one folder per space and table, partitioned below it.

Staging spaces hold ``source=<connector>_<staging>/ingest_date=<day>``; the
other spaces hold ``name=<model or view>/ingest_date=<day>`` where the part
below the name is optional. Reading a source is a folder, reading a day or a
month a partition filter: Spark settles both before it opens a file.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.names import LAKE_SPACES, SCAN_KEYS
from goldspan.operators.windows import first_rows
from goldspan.session import path_exists

MANIFEST = ("batch string, batch_id string, sources array<string>, total_records long, total_requests long, "
            "started string, ended string")
FILE = "_file"
STAGING_SPACES = ["staging", "staging_master", "staging_rejected"]


def source_name(connector: str, staging: str) -> str:
    return f"{connector}_{staging}"


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, space: str) -> str:
        if space not in LAKE_SPACES:
            raise ValueError(f"unknown lake space {space!r}; one of {LAKE_SPACES}")
        return f"{self.root}/{space}"

    def _owner(self, space: str) -> str:
        return "source" if space.startswith("staging") else "name"

    def write(self, df: DataFrame, space: str, partitions: Iterable[str], mode: str = "append") -> None:
        """Store ``df``, whose columns include the partition columns.

        The rebalance hint gathers each partition's rows so that few files are
        written, and lets Spark split a partition that is too large for a task.
        """
        partitions = list(partitions)
        df.hint("rebalance", *partitions).write.mode(mode).partitionBy(*partitions).parquet(self.path(space))

    def scan(
        self,
        space: str,
        table: str,
        columns: list[str] | None = None,
        prefix: str | None = None,
        renames: Mapping[str, str] | None = None,
        max_hits: int | None = None,
        callback: Callable | None = None,
        callback_schema: str | None = None,
        drifted: bool = False,
    ) -> DataFrame | None:
        """Records of one model, view or staging table; None when it has no folder.

        columns     kept columns; the record keys are always added
        prefix      leading part of the ingest date: a year, a month or a day
        renames     old name -> new name, after the scan
        callback    function on each file's records as one pandas frame, after the renames; ``callback_schema`` is its result
        max_hits    first N records in key order, of what the callback left
        drifted     files may differ in columns: read every footer and merge them
        """
        folder = f"{self.path(space)}/{self._owner(space)}={table}"
        found = [self._read(folder, drifted)] if path_exists(self.spark, folder) else []
        found += self._batches(space, table, drifted) if space in STAGING_SPACES else []
        if not found:
            return None
        if callback is not None:
            found = [part.withColumn(FILE, F.col("_metadata.file_path")) for part in found]
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
        if prefix is not None:
            df = df.where(F.col("ingest_date").cast("string").startswith(prefix))
        if not (columns and "ingest_date" in columns):
            df = df.drop("ingest_date")
        if columns is not None:
            df = df.select(*with_keys(columns), *([FILE] if callback is not None else []))
        if renames:
            df = df.withColumnsRenamed(dict(renames))
        if callback is not None:
            df = map_files(df, callback, callback_schema, FILE)
        if max_hits is not None:
            df = first_records(df, max_hits)
        return df

    def _read(self, folder: str, drifted: bool) -> DataFrame:
        return self.spark.read.option("mergeSchema", str(drifted).lower()).parquet(folder)

    def _batches(self, space: str, table: str, drifted: bool) -> list[DataFrame]:
        """The table's records of batches that have ended, if there are any; they have ``batch_id`` and ``sequence``."""
        folder, manifests = f"{self.root}/batches/source={table}", f"{self.root}/manifests"
        if not (path_exists(self.spark, folder) and path_exists(self.spark, manifests)):
            return []
        ended = self.spark.read.schema(MANIFEST).json(f"{manifests}/*").where(F.array_contains("sources", table)).select("batch")
        if ended.isEmpty():
            return []
        versions = f"{self.root}/declarations/source={table}"
        changed = drifted or path_exists(self.spark, versions) and self.spark.read.schema("version int").json(versions).count() > 1
        # batch and day are folders: the join prunes them before a file is opened
        rows = self._read(folder, changed).where(F.col("space") == space).join(ended, "batch", "left_semi").drop("batch", "part", "space")
        return [rows.drop("mdmErrors") if space == "staging" else rows]

    def staging(self, connector: str, staging: str, **options) -> DataFrame:
        """A staging table is its new, mastered and rejected records together."""
        found = []
        for space in STAGING_SPACES:
            part = self.scan(space, source_name(connector, staging), **options)
            if part is not None:
                found.append(part.withColumn("space", F.lit(space)))
        if not found:
            raise ValueError(f"no staging folder below {self.root}")
        return union_drifted(found)

    def view(self, name: str, intake: bool = False, **options) -> DataFrame | None:
        return self.scan("view_cds" if intake else "view", name, **options)

    def rejected(self, model: str, **options) -> DataFrame | None:
        return self.scan("golden_rejected", model, **options)


def with_keys(columns: Iterable[str]) -> list[str]:
    """The asked columns plus the record keys, each once, in this order."""
    return list(dict.fromkeys([*columns, *SCAN_KEYS]))


def union_drifted(frames: list[DataFrame]) -> DataFrame:
    """Union by name of frames whose columns differ; columns sorted by name."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.select(*sorted(merged.columns))


def first_records(df: DataFrame, n: int) -> DataFrame:
    keys = [k for k in SCAN_KEYS if k in df.columns] or df.columns
    return first_rows(df, keys, n)


def _placed(df: DataFrame, file: str | None) -> tuple[DataFrame, str, list[str]]:
    """``df`` with the place of each row in its file, the column with the file's name, the columns a callback sees."""
    if file is None:
        file, df = FILE, df.withColumn(FILE, F.col("_metadata.file_path"))
    return df.withColumn("_place", F.monotonically_increasing_id()), file, [c for c in df.columns if c != file]


def map_files(df: DataFrame, callback: Callable, schema=None, file: str | None = None) -> DataFrame:
    """``callback(pandas frame) -> pandas frame`` on all rows of a file at once, whatever Arrow batches they come in.

    ``df`` scans files, or has the file's name in the column ``file``, which the
    callback does not see. A file is one group: its writer bounds its size; for
    files of any size see ``map_file_pages``. The rows keep the order they have in the file.
    """
    placed, file, rest = _placed(df, file)

    def run(frame):
        return callback(frame.sort_values("_place", ignore_index=True)[rest])

    return placed.groupBy(file).applyInPandas(run, schema or df.select(*rest).schema)


def map_file_pages(df: DataFrame, callback: Callable, schema=None, order_by: Sequence[str | Column] = (), file: str | None = None) -> DataFrame:
    """``callback(pandas frames) -> pandas frames`` on all rows of a file, page after page, both as iterators.

    The callback is called once for each file. Spark puts the file's rows in the order
    ``order_by``, equal ones and by default all as they lie in the file, on disk where
    memory ends; Python holds a page (Arrow batch) at a time, however large the file is.
    ``df`` and ``file`` as for ``map_files``.
    """
    placed, file, rest = _placed(df, file)

    def run(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from callback(page[rest] for page in pages)

    ordered = placed.repartition(file).sortWithinPartitions(file, *order_by, "_place")  # the grouping keeps this order
    return ordered.groupBy(file).applyInPandas(run, schema or df.select(*rest).schema)


def map_batches(df: DataFrame, callback: Callable, schema) -> DataFrame:
    """``callback(pandas frame) -> pandas frame`` on every Arrow batch of a result, its page."""
    def run(batches):
        for batch in batches:
            yield callback(batch)
    return df.mapInPandas(run, schema)
