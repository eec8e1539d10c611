"""Log and task tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldspan.names import LOG_LEVELS, LOG_ORDER


def stored_level(level: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in LOG_LEVELS.items() for x in pair])
    return F.element_at(names, F.upper(level))


def severity(level: Column) -> Column:
    ranks = F.create_map(*[x for i, n in enumerate(LOG_ORDER) for x in (F.lit(n), F.lit(i))])
    return F.element_at(ranks, stored_level(level))


def at_least_level(df: DataFrame, level: str, minimum: str) -> DataFrame:
    """Rows as severe as ``minimum`` or more, with the stored level name."""
    floor = LOG_ORDER.index(LOG_LEVELS[minimum.upper()])
    return df.withColumn(level, stored_level(F.col(level))).where(severity(F.col(level)) >= floor)


def task_rollup(df: DataFrame, task: str, status: str, order: str, retry_count: int) -> DataFrame:
    """Per task: its latest status, its failures, and whether it is still to be retried.

    Failed and cancelled runs count as failures; a task with more of them than
    ``retry_count`` is exhausted. ``finished`` means completed or exhausted.
    """
    failed = F.col(status).isin("FAILED", "CANCELED")
    per_task = df.groupBy(task).agg(
        F.max_by(status, F.struct(order, status)).alias("last_status"),
        F.sum(failed.cast("long")).alias("failures"),
    )
    exhausted = (F.col("last_status") != "COMPLETED") & (F.col("failures") > retry_count)
    return per_task.withColumn("exhausted", exhausted).withColumn(
        "finished", (F.col("last_status") == "COMPLETED") | F.col("exhausted"))


def all_done(rollup: DataFrame) -> DataFrame:
    """One row: tasks per outcome, and whether every one is finished."""
    return rollup.agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.count_if(F.col("last_status") == "COMPLETED").alias("n_completed"),
        F.count_if("exhausted").alias("n_exhausted"),
        F.bool_and("finished").alias("done"),
    )
