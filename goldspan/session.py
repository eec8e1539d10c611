"""Session helpers: where durable intermediate data goes."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None


def _shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without one: it gets a temporary folder. On a
    cluster an unset folder is an error, as a machine-local folder would not
    be seen by the executors.
    """
    global _local_base
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="goldspan-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def workspace(spark: SparkSession, label: str) -> str:
    """A new, unused folder name in the shared folder."""
    return f"{_shared_folder(spark)}/goldspan/{label}-{uuid.uuid4().hex[:12]}"


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for jobs that shuffle about ``input_bytes`` on ``cores`` cores.

    Shuffle partitions of about 128 MiB, at least two per core. Beyond 100,000
    partitions their bookkeeping costs more than it saves, so they grow instead
    (1 GiB at 100 TB; sorts and aggregates spill). Adaptive execution merges
    partitions that turn out small and splits those that turn out large.
    """
    wanted = max(2 * cores, min(math.ceil(input_bytes / (128 << 20)), 100_000))
    return {
        "spark.sql.shuffle.partitions": str(wanted),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a crowded join partition even when that costs one more shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # whole texts go to Python functions in batches of this size
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        "spark.sql.session.timeZone": "UTC",
    }


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It cuts the lineage, outlives lost executors, and lets later steps read
    only the columns they need.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def is_file(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jpath) and fs.getFileStatus(jpath).isFile()


def remove_path(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(jpath, True)
