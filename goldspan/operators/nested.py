"""Nested documents, nested lists and path trees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldspan.session import stored

_END = "the text ends here 5f0c21d7"  # second element of a list whose first one is the text: nothing follows it


def _json_of(column: str) -> Column:
    """The JSON text, trimmed, or null if it is none: no single value, or a number beyond double range."""
    text = F.trim(F.col(column), F.lit(" \t\r\n"))
    listed = F.expr("CAST(_listed AS ARRAY<VARIANT>)")
    single = (F.size(listed) == 2) & (F.try_variant_get(F.col("_listed"), "$[1]", "string") == _END)
    # digits or exponents that long are rare: only then the numbers outside of strings are looked at
    long_ = text.rlike("[eE][+]?[0-9]{3}|[0-9]{309}")
    numbers = F.regexp_extract_all(F.regexp_replace(text, r'"(?:[^"\\]++|\\.)*+"', '""'), F.lit(r"-?[0-9][0-9.]*(?:[eE][-+]?[0-9]+)?"), F.lit(0))
    beyond = long_ & F.exists(numbers, lambda x: F.abs(x.cast("double")) == float("inf"))
    return F.when(F.coalesce(single, F.lit(False)) & ~F.coalesce(beyond, F.lit(False)), text)


def _children() -> Column:
    """Of a document or list in ``_node``: place, key (null in a list) and JSON text of what it holds, in its order."""
    def held(kind: str) -> Column:
        plain, typed = (F.from_json("_node", kind.format(t)) for t in ("string", "variant"))
        keys, plain, typed = (F.map_keys(plain), F.map_values(plain), F.map_values(typed)) if kind.startswith("map") else (None, plain, typed)
        # only strings lose their quotes in a text column
        texts = F.zip_with(plain, typed, lambda p, v: F.when(F.schema_of_variant(v) == "STRING", F.to_json(v)).otherwise(F.coalesce(p, F.lit("null"))))
        if keys is None:
            return F.transform(texts, lambda t, i: F.struct(i.alias("place"), F.lit(None).cast("string").alias("key"), t.alias("text")))
        pairs = F.arrays_zip(keys.alias("key"), texts.alias("text"))
        return F.transform(pairs, lambda p, i: F.struct(i.alias("place"), p["key"].alias("key"), p["text"].alias("text")))

    return F.when(F.col("_node").startswith("{"), held("map<string,{}>")).otherwise(held("array<{}>"))


def find_keys(df: DataFrame, column: str, key: str, keep: list[str]) -> DataFrame:
    """Every value of a key at any depth of a JSON column, in document order.

    One row per value: the kept columns, ``position`` (from 0; a document's own
    value before those inside it) and ``value`` as JSON without blanks. A text
    that names the key but is not JSON, repeats a key within one document, or
    holds numbers beyond double range, is reported: one row with null position
    and value. Null texts, and those that do not name the key, give no row.

    The documents are opened level by level until nothing is left that names the
    key: each level's finds and what is still to be opened are stored, so a
    level costs one pass over what the level before left.
    """
    def may_hold(text: Column) -> Column:
        # a key may be written with escapes, so texts with a backslash go on too
        return text.contains(f'"{key}"') | text.contains("\\")

    kept = F.struct(*[F.col(c) for c in keep]).alias("_kept")
    candidates = df.where(may_hold(F.col(column))).select(kept, F.col(column).alias("_text")).withColumn(
        "_listed", F.try_parse_json(F.concat(F.lit("["), "_text", F.lit(f', "{_END}"]'))))
    opened = stored(candidates.select(
        "_kept", F.monotonically_increasing_id().alias("_doc"), F.array().cast("array<int>").alias("_path"), _json_of("_text").alias("_node")), "find-keys")
    broken = opened.where("_node IS NULL").select("_kept.*", F.lit(None).cast("long").alias("position"), F.lit(None).cast("string").alias("value"))
    found, nodes = [], opened.where(F.col("_node").rlike("^[{\\[]"))
    while not nodes.isEmpty():
        each = nodes.select("_kept", "_doc", "_path", F.explode(_children()).alias("_child"))
        text = F.col("_child.text")
        level = stored(each.select(
            "_kept", "_doc", "_path", F.col("_child.place").alias("_place"), text.alias("_text"), F.coalesce(F.col("_child.key") == key, F.lit(False)).alias("_found"),
            (text.rlike("^[{\\[]") & may_hold(text)).alias("_open")).where("_found OR _open"), "find-keys")
        found.append(level.where("_found").select("_kept", "_doc", F.concat("_path", F.array(F.lit(-1))).alias("_path"), "_text"))
        nodes = level.where("_open").select("_kept", "_doc", F.concat("_path", F.array("_place")).alias("_path"), F.col("_text").alias("_node"))
    if not found:
        return broken
    place = F.row_number().over(Window.partitionBy("_doc").orderBy("_path")).cast("long") - 1
    values = reduce(DataFrame.unionByName, found).select("_kept.*", place.alias("position"), F.col("_text").alias("value"))
    return values.unionByName(broken)


def unroll(column: Column, kind: T.DataType) -> Column:
    """An array of arrays of any depth as one flat array."""
    while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        column, kind = F.flatten(column), kind.elementType
    return column


def unroll_list(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    flat = unroll(F.col(column), df.schema[column].dataType)
    return df.select(*keep, F.posexplode(flat).alias("position", "value"))


def path_tree(df: DataFrame, path: str) -> DataFrame:
    """Folders of a list of file paths, with the files below each at any depth."""
    parts = F.split(F.col(path), "/")
    folders = F.when(F.size(parts) > 1, F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/")))
    return (df.select(F.explode(folders).alias("folder"))
            .groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"))
            .withColumn("depth", F.size(F.split("folder", "/"))))
