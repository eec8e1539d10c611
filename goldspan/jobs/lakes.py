"""Scans of a lake, a catalog table and stored outputs.

The lake is laid out once per session and table folder, from the events and
customers: staging records by source and day in three spaces, golden and
rejected records of one model, and a view.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import functions as F

from goldspan.jobs.base import Tables, job
from goldspan.operators.rules import Rule
from goldspan.operators.master import validate
from goldspan.session import workspace
from goldspan.sources.lake import Lake, union_drifted
from goldspan.sources.records import empty_typed, json_column, records_frame
from goldspan.sources.tables import StepOutputs, read_table

_laid_out: dict[tuple[str, str], Lake] = {}


def lake_of(t: Tables) -> Lake:
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _laid_out:
        lake = Lake(t.spark, workspace(t.spark, "lake"))
        value = F.col("value")
        space = F.when(value < 20, "staging").when(value < 100, "staging_master").otherwise("staging_rejected")
        events = t.events.select(
            F.col("event_id").alias("mdmCounterForEntity"), F.concat(F.lit("e"), "event_id").alias("mdmId"),
            (value < 1).alias("mdmDeleted"), F.col("ts").alias("mdmLastUpdated"), "user_id", "value", "props",
            F.concat(F.lit("web_"), "event_type").alias("source"), F.to_date("ts").alias("ingest_date"), space.alias("space"))
        for name in ("staging", "staging_master", "staging_rejected"):
            part = events.where(F.col("space") == name).drop("space")
            if name == "staging_rejected":
                part = part.withColumn("mdmErrors", F.array(F.lit("VALUE_COMPARE:value"))).drop("props")
            lake.write(part, name, ["source", "ingest_date"])
        customers = t.customer.withColumns({
            "mdmCounterForEntity": F.col("c_custkey"), "mdmId": F.concat(F.lit("c"), "c_custkey"), "name": F.lit("customer")})
        golden, rejected = validate(customers, [Rule("VALUE_COMPARE", "c_acctbal", ("<", 0.0))])
        lake.write(golden, "golden", ["name"])
        lake.write(rejected, "golden_rejected", ["name"])
        view = customers.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            "mdmCounterForEntity", "mdmId", "c_name", "n_name", "c_mktsegment", F.lit("customer_nation").alias("name"))
        lake.write(view.drop("c_mktsegment"), "view", ["name"])
        # the view's intake space: an older file without the nation, a newer one with it
        older = F.col("c_mktsegment") == "BUILDING"
        lake.write(view.where(older).drop("n_name", "c_mktsegment"), "view_cds", ["name"])
        lake.write(view.where(~older).drop("c_mktsegment"), "view_cds", ["name"])
        _laid_out[key] = lake
    return _laid_out[key]


@job("src_lake_scan", """SELECT c_custkey AS "mdmCounterForEntity", 'c' || c_custkey AS "mdmId", c_name, c_acctbal FROM customer WHERE c_acctbal >= 0""")
def _(t: Tables):
    return lake_of(t).scan("golden", "customer").select("mdmCounterForEntity", "mdmId", "c_name", "c_acctbal")


@job("src_staging_union", """SELECT 'e' || event_id AS "mdmId", CASE WHEN value < 20 THEN 'staging' WHEN value < 100 THEN 'staging_master'
     ELSE 'staging_rejected' END AS space, CASE WHEN value < 100 THEN props END AS props, value >= 100 AS has_errors
     FROM events WHERE event_type = 'click'""")
def _(t: Tables):
    rows = lake_of(t).staging("web", "click")
    return rows.select("mdmId", "space", "props", F.col("mdmErrors").isNotNull().alias("has_errors"))


@job("src_view_scan", """SELECT 'c' || c_custkey AS "mdmId", c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t: Tables):
    return lake_of(t).view("customer_nation").select("mdmId", "c_name", "n_name")


@job("src_file_pattern", """SELECT 'e' || event_id AS "mdmId", value FROM events
     WHERE event_type = 'view' AND value < 20 AND CAST(ts AS DATE) = DATE '2024-01-17'""")
def _(t: Tables):
    return lake_of(t).scan("staging", "web_view", prefix="2024-01-17").select("mdmId", "value")


@job("src_columns", """SELECT user_id, event_id AS "mdmCounterForEntity", 'e' || event_id AS "mdmId" FROM events
     WHERE event_type = 'signup' AND value < 20""")
def _(t: Tables):
    return lake_of(t).scan("staging", "web_signup", columns=["user_id", "mdmId", "user_id"])


@job("src_rename", """SELECT c_name AS customer, c_acctbal AS balance, c_custkey AS "mdmCounterForEntity", 'c' || c_custkey AS "mdmId"
     FROM customer WHERE c_acctbal >= 0""")
def _(t: Tables):
    return lake_of(t).scan("golden", "customer", columns=["c_name", "c_acctbal"], renames={"c_name": "customer", "c_acctbal": "balance"})


@job("src_drift_union", """SELECT 'c' || c_custkey AS "mdmId", c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN n_name END AS n_name,
     CAST(NULL AS DOUBLE) AS s_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
     UNION ALL SELECT 's' || s_suppkey, NULL, NULL, s_acctbal FROM supplier""")
def _(t: Tables):
    """Files of one table that differ in columns, and a frame with other columns again."""
    drifted = lake_of(t).view("customer_nation", intake=True, drifted=True).drop("mdmCounterForEntity")
    other = t.supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("mdmId"), "s_acctbal")
    return union_drifted([drifted, other])


@job("src_max_hits", """SELECT event_id AS "mdmCounterForEntity", 'e' || event_id AS "mdmId" FROM events
     WHERE event_type = 'error' AND value < 20 ORDER BY event_id LIMIT 75""")
def _(t: Tables):
    return lake_of(t).scan("staging", "web_error", columns=[], max_hits=75)


@job("src_file_callback", """SELECT 'e' || event_id AS "mdmId", CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
     WHERE event_type = 'purchase' AND value < 20""")
def _(t: Tables):
    def parse(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"mdmId": frame["mdmId"], "k": [json.loads(p)["k"] for p in frame["props"]]})

    return lake_of(t).scan("staging", "web_purchase", columns=["props"], callback=parse, callback_schema="mdmId string, k long")


@job("src_empty_typed", """SELECT c_custkey AS k, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS VARCHAR) AS tree FROM customer""")
def _(t: Tables):
    """A typed empty table takes part in a union like any other."""
    nothing = empty_typed(t.spark, {"k": "LONG", "price": "DOUBLE", "tree": "NESTED"})
    return nothing.unionByName(t.customer.select(F.col("c_custkey").alias("k")), allowMissingColumns=True)


@job("src_rejected_scan", """SELECT 'c' || c_custkey AS "mdmId", c_acctbal, 'VALUE_COMPARE:c_acctbal' AS errors FROM customer WHERE c_acctbal < 0""")
def _(t: Tables):
    return lake_of(t).rejected("customer").select("mdmId", "c_acctbal", F.array_join("mdmErrors", ";").alias("errors"))


@job("src_table_read", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05")
def _(t: Tables):
    return read_table(t.lineitem, ["l_orderkey", "l_quantity"], "l_returnflag = 'R' AND l_discount > 0.05")


@job("src_table_sample", """SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'
     AND substr(md5('7|' || l_orderkey || '|' || l_linenumber), 1, 8) < '1999999a'""")
def _(t: Tables):
    """A tenth of a table, by its key: the same rows however the table is stored."""
    return read_table(t.lineitem, ["l_orderkey", "l_quantity"], "l_returnflag = 'R'", sample_percentage=10.0, seed=7,
                      sample_key=["l_orderkey", "l_linenumber"])


@job("src_json_records", """SELECT doc_id, lang, n_chars, 'text' AS form FROM documents""")
def _(t: Tables):
    """JSON texts of a whole table read as typed records; the hand-held forms give the same frame."""
    texts = t.documents.select(F.to_json(F.struct("doc_id", "lang", "n_chars")).alias("record"))
    schema = "doc_id long, lang string, n_chars long"
    one = {"doc_id": 1, "lang": "en", "n_chars": 2}
    forms = [json.dumps([one]), one, [one], pd.DataFrame([one])]
    if any(records_frame(t.spark, f).schema.simpleString() != records_frame(t.spark, one).schema.simpleString() for f in forms):
        raise AssertionError("the record forms disagree")
    return json_column(texts, "record", schema).withColumn("form", F.lit("text"))


@job("src_targets_read", """SELECT n_name, count(*) AS n, count(*) AS n_json FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def _(t: Tables):
    outputs = StepOutputs(t.spark, workspace(t.spark, "outputs"))
    counts = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n"), F.max("s_acctbal").alias("top"))
    outputs.save(counts, "suppliers")
    outputs.save(counts.select("n_name", F.col("n").alias("n_json")), "suppliers", "json")
    stored = outputs.load("suppliers", columns=["n_name", "n"])
    return stored.join(outputs.load("suppliers", "json", schema="n_name string, n_json long"), "n_name")
