"""Joins that must hold when one key has very many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldspan.operators.windows import by_slabs, carry, earlier, inside


def left_join_many(one: DataFrame, many: DataFrame, on: Sequence[str]) -> DataFrame:
    """``one LEFT JOIN many`` where a key of ``one`` may match a large part of ``many``.

    Spark can split a crowded partition only on the kept side of an outer
    join. The inner part, which it can split on either side, and the rows
    without a match, found against distinct keys, are joined apart.
    """
    matched = one.join(many, list(on))
    alone = one.join(many.select(*on).distinct(), list(on), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def interval_join(df: DataFrame, value: str, intervals: DataFrame, low: str, high: str, width: float) -> DataFrame:
    """Rows of ``df`` with every interval [low, high) that holds their value.

    A null end is open; a null value is in no interval. Both sides meet in
    cells: an interval in those of ``width``, doubled until it touches two or
    three of them, a row in one cell of each such size. The join is then an
    equality on the cell plus the exact test, so Spark hashes it, broadcasts
    the intervals when they are small and splits crowded cells when they are not.
    """
    lo, hi, at = F.col(low), F.col(high), F.col(value)
    doubled = F.greatest(F.lit(0), F.ceil(F.log2((hi - lo).cast("double") / width)).cast("int"))
    sized = intervals.where(lo.isNull() | hi.isNull() | (lo < hi)).withColumn(
        "_level", F.when(lo.isNull() | hi.isNull(), -1).otherwise(doubled))
    # one row per size: as many as times a width can be doubled, whatever the number of intervals
    levels = sorted(r["_level"] for r in sized.select("_level").distinct().collect())
    size = F.lit(float(width)) * F.pow(F.lit(2.0), F.col("_level"))
    cell = lambda c: F.floor(c / size).cast("long")
    open_ = F.col("_level") < 0
    spread = sized.withColumn("_cell", F.explode(F.when(open_, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(cell(lo), cell(hi)))))
    placed = df.where(at.isNotNull()).withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn(
        "_cell", F.when(open_, F.lit(0).cast("long")).otherwise(cell(at)))
    holds = (lo.isNull() | (at >= lo)) & (hi.isNull() | (at < hi))
    return placed.join(spread, ["_level", "_cell"]).where(holds).drop("_level", "_cell")


def latest_before(
    df: DataFrame, other: DataFrame, by: str, at: str, columns: Sequence[str], tie_break: str,
) -> DataFrame:
    """Each row of ``df`` with the newest strictly earlier row of ``other`` for its key.

    Both tables are laid in one order, at equal times the asking rows first, so
    that every picked row before a row is strictly earlier. Crowded keys are
    searched slab by slab (see ``operators.windows``), and one row per slab
    carries the newest row of the slabs before. ``tie_break`` is unique in each table.
    """
    picked = F.struct(F.col(at).alias("_at"), *[F.col(c).alias(f"previous_{c}") for c in columns])
    asking = df.withColumns({"_turn": F.lit(0), "_tie": F.col(tie_break)})
    # a null key equals nothing, and a null time is earlier than none: such rows are not found
    given = other.where(F.col(by).isNotNull() & F.col(at).isNotNull()).select(by, at, F.lit(1).alias("_turn"), F.col(tie_break).alias("_tie"), picked.alias("_pick"))
    order = [at, "_turn", "_tie"]
    before = (Window.unboundedPreceding, -1)

    def plain(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(by).orderBy(*order).rowsBetween(*before)
        return rows.withColumn("_best", F.max("_pick").over(window)).where("_turn = 0")

    def cut(rows: DataFrame) -> DataFrame:
        searched = rows.withColumn("_near", F.max("_pick").over(inside([by], order).rowsBetween(*before))).where("_turn = 0")
        newest = rows.groupBy(by, "_slab").agg(F.max("_pick").alias("_newest"))
        carried = newest.select(by, "_slab", F.max("_newest").over(earlier([by])).alias("_carry"))
        return carry(searched, carried, [by]).withColumn("_best", F.coalesce("_near", "_carry")).drop("_near", "_carry")

    found = by_slabs(asking.unionByName(given, allowMissingColumns=True), [by], order, plain, cut)
    return found.select(*df.columns, *[f"_best.previous_{c}" for c in columns])
