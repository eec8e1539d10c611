"""From staging tables to golden records: map, check, merge, reject, reprocess."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.functions.keys import join_same
from goldspan.names import STAGING_TIE_BREAK
from goldspan.operators.rules import Rule, errors_of
from goldspan.operators.schema import spark_type
from goldspan.plans.filters import decided
from goldspan.session import workspace


def duplicate_keys(df: DataFrame, crosswalk: Sequence[str]) -> DataFrame:
    """Crosswalk keys that occur more than once, with their counts."""
    return df.groupBy(*crosswalk).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_crosswalk_unique(df: DataFrame, crosswalk: Sequence[str], force: bool = False) -> DataFrame:
    if not force and not duplicate_keys(df, crosswalk).isEmpty():
        raise ValueError(f"crosswalk {list(crosswalk)} repeats; use force to send anyway")
    return df


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, (T.MapType, T.VariantType))


def _greatest_first(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [(F.to_json(F.struct(c)) if _holds_map(df.schema[c].dataType) else F.col(c)).desc_nulls_last() for c in columns]


def merge_latest(
    df: DataFrame,
    key: str = "mdmId",
    counter: str = STAGING_TIE_BREAK,
    deleted: str | None = "mdmDeleted",
) -> DataFrame:
    """One record per id: the greatest counter wins, then a deleted winner drops out.

    Golden records are told apart by ``names.GOLDEN_TIE_BREAK`` instead.

    Equal counters are settled by the remaining columns in name order (the
    greatest, nulls least, maps and the like by their JSON), so the result never
    depends on the order of arrival. The greatest counter and how often it
    occurs come from hash aggregates over id and counter alone; the records are
    hashed to that, and only those that tie are sorted. An id with very many
    versions, tied or not, is reduced in each task before it meets itself.
    """
    rest = sorted(c for c in df.columns if c not in (key, counter))
    counts = df.groupBy(key, counter).agg(F.count(F.lit(1)).alias("_times"))
    greatest = counts.groupBy(key).agg(F.max(counter).alias(counter))
    top = join_same(counts, greatest, [key, counter]).hint("shuffle_hash")
    alone, tied = (join_same(df, top.where(F.col("_times") == 1 if single else F.col("_times") > 1), [key, counter]).select(key, counter, *rest)
                   for single in (True, False))
    order = _greatest_first(df, rest)
    plain = [c for c in rest if not _holds_map(df.schema[c].dataType)]
    salt = F.pmod(F.xxhash64(*plain), F.lit(32)) if plain else F.lit(0)
    for by in ([key, salt], [key]):  # the first of each salt, then the first of those
        tied = tied.withColumn("_nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order or [F.lit(1)]))).where("_nth = 1").drop("_nth")
    latest = alone.unionByName(tied)
    if deleted is not None:
        latest = latest.where(~F.coalesce(F.col(deleted), F.lit(False)))
    return latest.select(*df.columns)


def merge_narrow(df: DataFrame, key: str = "mdmId", counter: str = STAGING_TIE_BREAK, deleted: str | None = "mdmDeleted") -> DataFrame:
    """The records of ``merge_latest``, read and sent once.

    All records are sorted, which is cheaper as long as they are narrow. Each task keeps its first record of
    an id before they are sent, so an id with very many versions is reduced before it meets itself.
    """
    order = _greatest_first(df, [counter, *sorted(c for c in df.columns if c not in (key, counter))])
    latest = df.withColumn("_nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_nth = 1")
    if deleted is not None:
        latest = latest.where(~F.coalesce(F.col(deleted), F.lit(False)))
    return latest.select(*df.columns)


def map_fields(df: DataFrame, mapping: Mapping[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Staging fields as model fields: {model field: (staging field, declared type)}."""
    mapped = [F.col(src).try_cast(spark_type(kind)).alias(name) for name, (src, kind) in mapping.items()]
    return df.select(*keep, *mapped)


def union_sources(sources: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """{connector: {staging: mapped frame}} as one frame with its origin in two columns."""
    frames = [
        df.withColumns({"connector": F.lit(connector), "staging": F.lit(staging)})
        for connector, stagings in sources.items() for staging, df in stagings.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def validate(df: DataFrame, rules: Sequence[Rule], errors: str = "mdmErrors") -> tuple[DataFrame, DataFrame]:
    """(golden, rejected): records no rule fired on, and the others with their errors.

    Both read the same checked frame. Writing it once, partitioned on whether
    it has errors, avoids checking twice: see ``sinks.write_validated``.
    """
    checked = errors_of(df, rules, errors)
    return checked.where(F.size(errors) == 0).drop(errors), checked.where(F.size(errors) > 0)


def reprocess(
    rejected: DataFrame, rules: Sequence[Rule], delete_records: bool = False, errors: str = "mdmErrors",
) -> tuple[DataFrame, DataFrame]:
    """Check rejected records again: (records that pass now, rejected table afterwards).

    With ``delete_records`` the passing records leave the rejected table (a
    move); without, the table keeps every record (a copy).
    """
    checked = errors_of(rejected.drop(errors), rules, errors)
    accepted = checked.where(F.size(errors) == 0).drop(errors)
    return accepted, checked.where(F.size(errors) > 0) if delete_records else rejected


def reprocess_records(tables: Mapping[str, DataFrame], model: str, record_type: str = "ALL") -> DataFrame:
    """The records a reprocess of a model reads: ALL, Golden or Rejected."""
    if record_type not in ("ALL", "Golden", "Rejected"):
        raise ValueError("record_type is ALL, Golden or Rejected")
    kinds = ["Golden", "Rejected"] if record_type == "ALL" else [record_type]
    frames = [tables[model + k].withColumn("record_type", F.lit(k)) for k in kinds]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class Reprocessed(NamedTuple):
    """Records that pass now and those that do not (with their errors), each with the ``record_type`` it had, and the
    model's tables afterwards."""

    accepted: DataFrame
    failed: DataFrame
    golden: DataFrame
    rejected: DataFrame


def reprocess_model(
    tables: Mapping[str, DataFrame], model: str, rules: Sequence[Rule], copy_or_move: str = "move", record_type: str = "ALL",
    query=None, errors: str = "mdmErrors",
) -> Reprocessed:
    """Check a model's Golden or Rejected records, or both, again; ``query`` picks those it matches.

    A move takes the picked records out of their tables: what passes is golden
    afterwards, what does not is rejected. A copy leaves both tables as they
    are. The query may take values from other ``tables``. The rules run once:
    the records are stored by outcome, and every result is read from there.
    """
    if copy_or_move not in ("copy", "move"):
        raise ValueError("copy_or_move is copy or move")
    other = {"Golden": "Rejected", "Rejected": "Golden"}.get(record_type)
    rows = reprocess_records(tables, model, record_type)
    old = f"{errors}_before"
    rows = rows.withColumnRenamed(errors, old) if errors in rows.columns else rows.withColumn(old, F.lit(None).cast("array<string>"))
    picked = decided(rows, query, tables, "_picked") if query is not None else rows.withColumn("_picked", F.lit(True))
    checked = errors_of(picked, rules, errors)
    outcome = F.when(~F.col("_picked"), "left").when(F.size(errors) > 0, "failed").otherwise("accepted")
    path = workspace(rows.sparkSession, "reprocess")
    settled = checked.withColumn("outcome", outcome).drop("_picked")
    settled.write.partitionBy("outcome").parquet(path)
    stored_ = rows.sparkSession.read.schema(settled.schema).parquet(path)
    part = lambda name: stored_.where(F.col("outcome") == name).drop("outcome")
    accepted, failed = part("accepted").drop(errors, old), part("failed").drop(old)
    if copy_or_move == "copy":
        return Reprocessed(accepted, failed, tables[model + "Golden"], tables[model + "Rejected"])
    stay = {k: part("left").where(F.col("record_type") == k).drop("record_type", errors).withColumnRenamed(old, errors) for k in ("Golden", "Rejected")}
    if other:
        stay[other] = tables[model + other]
    golden = stay["Golden"].drop(errors).unionByName(accepted.drop("record_type"), allowMissingColumns=True)
    rejected = stay["Rejected"].unionByName(failed.drop("record_type"), allowMissingColumns=True)
    return Reprocessed(accepted, failed, golden, rejected)


def reject_report(rejected: DataFrame, by: Sequence[str] = (), errors: str = "mdmErrors") -> DataFrame:
    return rejected.select(*by, F.explode(errors).alias("error")).groupBy(*by, "error").agg(
        F.count(F.lit(1)).alias("n"))


# --- connectors -----------------------------------------------------------------

def connector_stats(df: DataFrame, connector: str, staging: str) -> DataFrame:
    """Records per staging table of each connector."""
    return df.groupBy(connector, staging).agg(F.count(F.lit(1)).alias("n_records"))


def staging_to_connectors(df: DataFrame, connector: str, staging: str) -> DataFrame:
    """Staging name -> sorted connector names.

    The pairs are made distinct first, so an array holds connector names, never records.
    """
    pairs = df.select(staging, connector).distinct()
    return pairs.groupBy(staging).agg(F.sort_array(F.collect_list(connector)).alias("connectors"))


def connectors_of_staging(df: DataFrame, connector: str, staging: str, name: str) -> DataFrame:
    """Every connector that owns a staging table of this name; none is an error."""
    found = df.where(F.col(staging) == name).select(connector).distinct()
    if found.isEmpty():
        raise ValueError(f"no connector has a staging table {name!r}")
    return found


def stagings_of_connector(df: DataFrame, connector: str, staging: str, name: str) -> DataFrame:
    return df.where(F.col(connector) == name).select(staging).distinct().orderBy(staging)


def prefixed_staging(df: DataFrame, connectors: DataFrame, prefix: str | None) -> DataFrame:
    """Staging names qualified by connector name or id (or left as they are).

    A connector without a known name leaves the qualified name null.
    """
    if prefix is None:
        return df.withColumn("qualified", F.col("staging"))
    if prefix == "connector_id":
        return df.withColumn("qualified", F.concat(F.col("connector_id").cast("string"), F.lit("_"), "staging"))
    if prefix != "connector_name":
        raise ValueError("prefix is connector_name, connector_id or None")
    known = connectors.select("connector_id", "connector_name").distinct()
    named = df.join(known, "connector_id", "left")
    return named.withColumn("qualified", F.concat("connector_name", F.lit("_"), "staging")).select(*df.columns, "qualified")
