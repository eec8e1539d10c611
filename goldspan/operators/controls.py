"""What a record query may ask besides its filter: fields, order, pages, ranges, deletes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from goldspan.names import VALUES
from goldspan.operators.windows import cut_of, first_rows, with_slab
from goldspan.plans.filters import apply_filter, decided, record_getter
from goldspan.session import workspace


def pick_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """The named dotted fields, each under its last name part."""
    get = record_getter(df.columns)
    return df.select(*[get(f).alias(f.removesuffix(".raw").split(".")[-1]) for f in fields])


def hits_only(df: DataFrame, values: str = VALUES) -> DataFrame:
    """The records' own fields; records whose value struct is absent are dropped."""
    return df.where(F.col(values).isNotNull()).select(f"{values}.*")


def sort_records(df: DataFrame, sort_by: str, sort_order: str = "ASC") -> DataFrame:
    """One sort field; nulls come last in both directions."""
    field = record_getter(df.columns)(sort_by)
    return df.orderBy(field.desc_nulls_last() if sort_order.upper() == "DESC" else field.asc_nulls_last())


def page(df: DataFrame, order: list[str], offset: int = 0, page_size: int = 100) -> DataFrame:
    return first_rows(df, order, page_size, offset)


def at_most(df: DataFrame, order: list[str], max_hits: float = math.inf) -> DataFrame:
    """Exactly min(max_hits, all) records, the first ones in ``order``."""
    return df if max_hits == math.inf else first_rows(df, order, int(max_hits))


def count_hits(df: DataFrame, query, tables=None) -> DataFrame:
    return apply_filter(df, query, tables).agg(F.count(F.lit(1)).alias("total_hits"))


def golden_type(model: str) -> str:
    return model if model.endswith("Golden") else model + "Golden"


def all_of_type(tables: dict[str, DataFrame], model: str) -> DataFrame:
    return tables[golden_type(model)]


def repeated_ids(df: DataFrame, key: str = "mdmId") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_unique(df: DataFrame, key: str = "mdmId") -> DataFrame:
    """``df`` itself; fails when an id repeats."""
    if not repeated_ids(df, key).isEmpty():
        raise ValueError(f"there are repeated records: {key} is not unique")
    return df


def record_errors(df: DataFrame, key: str = "mdmId", errors: str = "mdmErrors") -> DataFrame:
    return df.where(F.size(errors) > 0).select(key, errors)


def survivors(df: DataFrame, query, tables=None) -> DataFrame:
    """What is left after deleting every record the search matches; its values may come from other tables.

    An undecided (null) match keeps the record.
    """
    return decided(df, query, tables).where(~F.col("_matches")).drop("_matches")


def delete_to(df: DataFrame, query, path: str, tables=None) -> tuple[DataFrame, int]:
    """Write the survivors to a new path: the table as it is now, and how many went, counted in the same pass.

    Files are never rewritten in place: a failed job leaves the old table whole.
    ``operators.deletes`` deletes without writing the survivors.
    """
    seen = Observation()
    counted = decided(df, query, tables).observe(seen, F.count_if("_matches").alias("gone"))
    counted.where(~F.col("_matches")).drop("_matches").write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path), seen.get["gone"]


def delete_model_records(tables: dict[str, DataFrame], model: str, now) -> dict[str, DataFrame]:
    """Golden, master and rejected records last updated at or before ``now`` are removed.

    Returns the surviving tables; records without an update time stay.
    """
    out = {}
    for suffix in ("Golden", "Master", "Rejected"):
        df = tables[model + suffix]
        doomed = F.col("mdmLastUpdated") <= F.lit(now)
        kept = df.where(~F.coalesce(doomed, F.lit(False)))
        path = workspace(df.sparkSession, f"delete-{model}{suffix}")
        kept.write.parquet(path)
        out[model + suffix] = df.sparkSession.read.parquet(path)
    return out


# --- key ranges -----------------------------------------------------------------

def key_bounds(df: DataFrame, key: str, query=None, multiplier: float | None = None) -> DataFrame:
    """One row: smallest and largest key. A multiplier widens both by it and 10."""
    if query is not None:
        df = apply_filter(df, query)
    low, high = F.min(key), F.max(key)
    if multiplier is not None:
        low = (low * F.lit(multiplier)).cast("long") - 10
        high = (high * F.lit(multiplier)).cast("long") + 10
    return df.agg(low.alias("min_key"), high.alias("max_key"))


def key_ranges(bounds: DataFrame, slices: int) -> DataFrame:
    """Inclusive key ranges that cover everything once, from a bounds row.

    An open head ends just below the smallest key; slices of equal width
    follow; an open tail starts at the largest key. When the bounds are equal
    the upper one counts as one more.
    """
    low = F.col("min_key")
    high = F.when(F.col("max_key") == low, low + 1).otherwise(F.col("max_key"))
    b = bounds.where("min_key is not null").select(low.alias("lo"), high.alias("hi"))
    step = F.floor((F.col("hi") - F.col("lo")) / F.lit(slices)).cast("long") + 1
    none = F.lit(None).cast("long")
    starts = F.filter(F.sequence(F.col("lo"), F.col("hi"), step), lambda s: s < F.col("hi"))
    middle = F.transform(
        starts, lambda s: F.struct(s.alias("range_from"), (F.least(s + step, F.col("hi")) - 1).alias("range_to")))
    head = F.array(F.struct(none.alias("range_from"), (F.col("lo") - 1).alias("range_to")))
    tail = F.array(F.struct(F.col("hi").alias("range_from"), none.alias("range_to")))
    return b.select(F.posexplode(F.concat(head, middle, tail)).alias("slice", "r")).select("slice", "r.*")


def slice_of(key: Column, low: int | None, high: int | None, slices: int) -> Column:
    """The slice number ``key_ranges`` gives a key, by arithmetic instead of a range join.

    Null for a null key; a table without keys has no bounds and no slices.
    """
    if low is None or high is None:
        return F.lit(None).cast("int")
    high = low + 1 if high == low else high
    step = (high - low) // slices + 1
    last = -(-(high - low) // step) + 1
    middle = F.floor((key - low) / step).cast("int") + 1
    return F.when(key < low, 0).when(key >= high, last).otherwise(middle)


def range_scan(df: DataFrame, key: str, slices: int) -> DataFrame:
    """The whole table with the range of the key each row lies in, as ``slice``; nothing is moved.

    Bounds come from a sample of the keys, so busy key regions get narrow
    ranges, which equal-width slices do not. The number of ranges is about
    ``slices``; rows without a key lie in the first.
    """
    if not 0 < slices < 9999:
        raise ValueError("slices is between 1 and 9998")
    cut = cut_of(df, [], [key], slices)
    first = min((i + 1 for i, b in enumerate(cut.bounds) if b[0] != 2), default=1)
    return with_slab(df, cut, name="slice").withColumn("slice", F.greatest(F.col("slice"), F.lit(first)) - first)


def rejected_of_staging(rejected: DataFrame, source: str, fields: list[str]) -> DataFrame:
    """Rejected records of one staging table, with the columns derived from ``fields``.

    A column of the staging record is kept when it holds ``<field>_``.
    """
    names = rejected.schema["mdmStagingRecord"].dataType.names
    kept = [n for n in names if any(f + "_" in n for f in fields)]
    return rejected.where(F.col("mdmStagingEntityName") == source).select(
        "mdmId", *[F.col(f"mdmStagingRecord.`{n}`").alias(n) for n in kept])
