"""Continuous intake, merge, de-duplication and counts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.operators.master import merge_narrow as merge_latest
from goldspan.operators.rules import Rule, errors_of
from goldspan.session import remove_path
from goldspan.sources.manifest import Manifest, State
from goldspan.streaming.sources import disk_backed_state, event_time, run_available, write_batch


def intake(stream: DataFrame, rules: Sequence[Rule], root: str, errors: str = "mdmErrors") -> DataFrame:
    """Validate and store arriving records; the stored table has ``batch_id`` and the errors.

    Account for it with ``sinks.batch_summary``.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(errors_of(batch, rules, errors), f"{root}/records", batch_id)

    run_available(stream, each, f"{root}/checkpoint")
    return stream.sparkSession.read.parquet(f"{root}/records")


class LatestTable:
    """The newest record per id of a stream.

    A micro-batch is reduced to its newest record per id and stored as a delta:
    a batch costs its own size, not the table's. Reading merges base and deltas;
    ``compact`` folds the deltas into a new base. A manifest names the base, the
    deltas behind it and the last batch that is in. One stream feeds a table; it
    may be compacted at the same time.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "mdmId", counter: str = "mdmCounterForEntity",
                 deleted: str | None = "mdmDeleted"):
        self.spark, self.root = spark, root.rstrip("/")
        self.key, self.counter, self.deleted = key, counter, deleted
        self.manifest = Manifest(spark, f"{self.root}/manifests", "base string, deltas array<string>, last long", {"base": None, "deltas": [], "last": -1})

    def state(self) -> State:
        return self.manifest.latest()[1]

    def feed(self, stream: DataFrame) -> None:
        def each(batch: DataFrame, batch_id: int) -> None:
            if batch_id <= self.state()["last"]:
                return  # replayed: it is in already
            # deleted winners stay in the delta: they must beat older versions
            newest = merge_latest(batch, self.key, self.counter, deleted=None)
            folder = f"deltas/{batch_id}-{uuid.uuid4().hex[:8]}"
            newest.write.parquet(f"{self.root}/{folder}")
            self.manifest.publish(lambda s: {**s, "deltas": [*s["deltas"], folder], "last": batch_id})

        run_available(stream, each, f"{self.root}/checkpoint")

    def _rows(self, state: State) -> DataFrame:
        parts = [f"{self.root}/{f}" for f in (state["base"], *state["deltas"]) if f]
        if not parts:
            raise ValueError(f"{self.root} has not been fed yet")
        return self.spark.read.parquet(*parts)

    def read(self) -> DataFrame:
        return merge_latest(self._rows(self.state()), self.key, self.counter, self.deleted)

    def compact(self) -> State:
        """Folds the deltas into a new base.

        What the state before this one consists of stays, for readers that have
        begun; what only older versions name is removed, and those versions too.
        """
        old = self.manifest.versions()
        number, before = self.manifest.latest()
        folder = f"bases/{uuid.uuid4().hex[:8]}"
        merge_latest(self._rows(before), self.key, self.counter, deleted=None).write.parquet(f"{self.root}/{folder}")
        _, after = self.manifest.publish(lambda s: {**s, "base": folder, "deltas": [d for d in s["deltas"] if d not in before["deltas"]]})
        needed = {f for s in (before, after) for f in (s["base"], *s["deltas"])}
        for version, state in old.items():
            if version < number:
                for name in {state["base"], *state["deltas"]} - needed - {None}:
                    remove_path(self.spark, f"{self.root}/{name}")
                self.manifest.remove(version)
        return after


def dedupe(stream: DataFrame, key: str, ts: str, delay: str, root: str, salts: int = 32) -> DataFrame:
    """Each id once, repeats within ``delay`` dropped even when they come late.

    An id repeated very often would send all its copies to one task. Repeats
    are therefore dropped per id and salt first: at most ``salts`` copies of an
    id go on to the second step. The salt only spreads work: whatever it is, the
    second step sees every id and keeps one record. ``salts=0`` leaves it out.
    """
    unique = event_time(stream, ts).withWatermark(ts, delay)
    if salts:
        salted = unique.withColumn("_salt", F.spark_partition_id() % salts)
        unique = salted.dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    unique = unique.dropDuplicatesWithinWatermark([key])
    with disk_backed_state(stream.sparkSession):
        run_available(unique, lambda b, i: write_batch(b, f"{root}/unique", i), f"{root}/checkpoint")
    return stream.sparkSession.read.parquet(f"{root}/unique").drop("batch_id")


def date_histogram(stream: DataFrame, ts: str, interval: str, delay: str, root: str,
                   by: Sequence[str] = ()) -> DataFrame:
    """Counts per interval as records arrive: the newest count of every window.

    Update mode emits a window whenever it changes, so windows still open are
    part of the answer too.
    """
    counted = (event_time(stream, ts).withWatermark(ts, delay)
               .groupBy(F.window(ts, interval), *by).agg(F.count(F.lit(1)).alias("doc_count"))
               .select(F.col("window.start").alias("bucket"), *by, "doc_count"))
    with disk_backed_state(stream.sparkSession):
        run_available(counted, lambda b, i: write_batch(b, f"{root}/windows", i), f"{root}/checkpoint", "update")
    stored = stream.sparkSession.read.parquet(f"{root}/windows")
    return stored.groupBy("bucket", *by).agg(F.max_by("doc_count", "batch_id").alias("doc_count"))
