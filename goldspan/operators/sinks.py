"""Writing records: staging and model tables, step results. Batches are in ``operators.intake``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldspan.operators.master import check_crosswalk_unique
from goldspan.operators.rules import Rule, errors_of
from goldspan.operators.schema import check_crosswalk
from goldspan.operators.sqlapi import check_select
from goldspan.operators.windows import sequence_numbers
from goldspan.session import stored
from goldspan.sources.lake import Lake, source_name

def batch_slices(df: DataFrame, order: Sequence[str], step_size: int = 500) -> DataFrame:
    """``df`` cut into consecutive slices of ``step_size`` rows in ``order``, a total order.

    Adds ``sequence`` (from 1), and ``cumulative`` (records up to and with the
    slice). Rows are numbered inside slabs of the order and shifted by the sizes
    of the slabs before; there is no single-task sort.
    """
    if step_size < 1:
        raise ValueError("step_size is at least 1")
    rows, shifts = sequence_numbers(df, order)
    sequence = F.floor((F.col("_row") + F.col("_shift")) / step_size).cast("long") + 1
    # one row per slab: windows.SLABS bounds its size
    shifted = rows.join(F.broadcast(shifts), "_slab").withColumn("sequence", sequence)
    return shifted.select(
        *df.columns, "sequence", F.least(F.col("sequence") * step_size, F.col("_total")).alias("cumulative"))


def batch_summary(df: DataFrame, batch: str = "batch_id", sequence: str = "sequence",
                  started: str | None = None, ended: str | None = None) -> DataFrame:
    """Per batch: records, requests (distinct sequence numbers), first and last time."""
    times = [F.min(started).alias("started")] if started else []
    times += [F.max(ended).alias("ended")] if ended else []
    # requests first: the second step counts slices, not rows, so a batch that
    # holds most rows is reduced where they lie
    per_request = df.groupBy(batch, sequence).agg(F.count(F.lit(1)).alias("_n"), *times)
    outer = [F.min("started").alias("started")] if started else []
    outer += [F.max("ended").alias("ended")] if ended else []
    return per_request.groupBy(batch).agg(
        F.sum("_n").alias("total_records"), F.count(F.lit(1)).alias("total_requests"), *outer)


def write_staging(lake: Lake, df: DataFrame, connector: str, staging: str, crosswalk: Sequence[str],
                  ingest_date: str, force: bool = False, mode: str = "append") -> None:
    """Append records to a staging table, partitioned on source and ingest day. ``df`` is computed once."""
    check_crosswalk(df.columns, list(crosswalk))
    tagged = df.withColumn("source", F.lit(source_name(connector, staging)))
    if ingest_date != "ingest_date":
        tagged = tagged.withColumn("ingest_date", F.to_date(ingest_date))
    rows = tagged if force else check_crosswalk_unique(stored(tagged, "intake"), crosswalk)
    lake.write(rows, "staging", ["source", "ingest_date"], mode)


def write_model(df: DataFrame, path: str, delete_old_records: bool = False) -> None:
    df.write.mode("overwrite" if delete_old_records else "append").parquet(path)


def write_validated(df: DataFrame, rules: Sequence[Rule], path: str,
                    errors: str = "mdmErrors") -> tuple[DataFrame, DataFrame]:
    """Check every record once and store golden and rejected side by side."""
    checked = errors_of(df, rules, errors)
    outcome = F.when(F.size(errors) > 0, "rejected").otherwise("golden")
    checked.withColumn("outcome", outcome).write.partitionBy("outcome").parquet(path)
    both = df.sparkSession.read.parquet(path)
    golden = both.where("outcome = 'golden'").drop("outcome", errors)
    return golden, both.where("outcome = 'rejected'").drop("outcome")


def process_sql(spark: SparkSession, query: str, path: str, clear_target: bool = False,
                deduplicate: bool = False, send_realtime: bool = False) -> DataFrame:
    """Store a query's result in a model table.

    ``deduplicate`` drops rows equal in every column; sending the records on
    in real time forces it.
    """
    result = spark.sql(check_select(spark, query))
    if deduplicate or send_realtime:
        result = result.distinct()
    write_model(result, path, clear_target)
    return spark.read.parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)
