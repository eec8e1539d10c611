"""Delivery of a model's new records to a subscriber."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.session import path_exists
from goldspan.streaming.sources import run_available, stream_of, write_batch


class Subscription:
    """Records of (connector, model) delivered once each, in arrival batches.

    The checkpoint below ``root`` is the position. Pausing is not running;
    playing again goes on after the last finished batch. Every batch is stored
    under its id, so a batch replayed after a failure is delivered as the same
    batch. The ledger counts each batch as delivered or discarded. What is
    pending comes in batches of ``max_files`` files or about ``max_bytes``.
    """

    def __init__(self, spark: SparkSession, source: str, root: str, connector: str, model: str,
                 max_files: int | None = None, max_bytes: int | None = None):
        self.spark = spark
        self.source = source
        self.root = f"{root.rstrip('/')}/{connector}/{model}"
        self.bounds = {"max_files": max_files, "max_bytes": max_bytes}

    def _advance(self, stream: DataFrame, each: Callable[[DataFrame, int], DataFrame], state: str) -> None:
        def step(batch: DataFrame, batch_id: int) -> None:
            counted = each(batch, batch_id).agg(F.count(F.lit(1)).alias("n_records")).withColumn("state", F.lit(state))
            write_batch(counted, f"{self.root}/ledger", batch_id)

        run_available(stream, step, f"{self.root}/checkpoint")

    def play(self, callback: Callable[[DataFrame, int], None] | None = None) -> None:
        """Deliver what is pending: to ``callback``, or to the delivered table.

        A batch for a callback is computed once more to be counted.
        """
        def deliver(batch: DataFrame, batch_id: int) -> DataFrame:
            if callback is not None:
                callback(batch, batch_id)
                return batch
            write_batch(batch, f"{self.root}/delivered", batch_id)
            return self.spark.read.parquet(f"{self.root}/delivered/batch_id={batch_id}")

        self._advance(stream_of(self.spark, self.source, **self.bounds), deliver, "delivered")

    def clear(self) -> None:
        """Move past what is pending without delivering it. No column is read: the files' footers have the counts."""
        nothing = stream_of(self.spark, self.source, **self.bounds).select(F.lit(1).alias("one"))
        self._advance(nothing, lambda batch, _: batch, "discarded")

    def delivered(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/delivered").drop("batch_id")

    def batches(self) -> DataFrame:
        """The ledger: ``batch_id``, ``n_records``, ``state`` of every batch so far."""
        return self.spark.read.parquet(f"{self.root}/ledger").select("batch_id", "n_records", "state")

    def info(self) -> DataFrame:
        """One row: records delivered, discarded and pending."""
        total = self.spark.read.parquet(self.source).agg(F.count(F.lit(1)).alias("n_total"))
        if not path_exists(self.spark, f"{self.root}/ledger"):
            return total.select(F.lit(0).cast("long").alias("delivered"), F.lit(0).cast("long").alias("discarded"),
                                F.col("n_total").alias("pending"))
        ledger = self.batches().agg(
            *[F.coalesce(F.sum(F.when(F.col("state") == s, F.col("n_records"))), F.lit(0)).alias(s)
              for s in ("delivered", "discarded")])
        seen = F.col("delivered") + F.col("discarded")
        return ledger.select("delivered", "discarded", (total.scalar() - seen).alias("pending"))
