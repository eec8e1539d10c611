"""File streams over hub tables."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.session import is_file


# What a micro-batch reads at most, unless the caller says otherwise: a backlog of any size comes in pieces.
BATCH_BYTES = 32 << 30


def stream_of(spark: SparkSession, path: str, schema=None, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """A parquet folder, or one parquet file, as a stream of its files.

    A micro-batch takes ``max_files`` files or about ``max_bytes`` (default:
    ``BATCH_BYTES``), whichever is given; at least one file.
    """
    if max_files and max_bytes:
        raise ValueError("a batch is bounded by files or by bytes")
    reader = spark.readStream.schema(schema if schema is not None else spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes or BATCH_BYTES)
    if is_file(spark, path):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with a zone: times without one are read as session time."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """Store one micro-batch under its id: a replayed batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


@contextmanager
def disk_backed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB: it may outgrow the heap."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_available(df: DataFrame, each_batch, checkpoint: str, mode: str = "append"):
    """Process what has arrived, batch by batch, and stop. Rerun to go on from there."""
    query = (df.writeStream.foreachBatch(each_batch).outputMode(mode)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
