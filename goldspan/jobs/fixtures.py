"""Shapes the provided tables lack, derived from them row by row.

Each builder has its SQL twin as text, to be put in a WITH clause. Nested
records are built from a record's own columns, so no group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldspan.jobs.base import Tables

# --- staging records with metadata (lineitem) -----------------------------------

STAGED_SQL = """
staged AS (
  SELECT l_orderkey || '-' || l_linenumber AS "mdmId",
         CAST(epoch(l_shipdate) AS BIGINT) * 1000000 + l_partkey AS "mdmCounterForEntity",
         l_returnflag = 'R' AS "mdmDeleted", l_shipdate AS "mdmLastUpdated", l_suppkey, l_quantity,
         l_extendedprice, l_discount, l_tax, l_linestatus
  FROM lineitem)"""


def staged(t: Tables) -> DataFrame:
    """Line items as staging records: several versions per id, some deleted."""
    seconds = F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("mdmId"),
        (seconds * 1000000 + F.col("l_partkey")).alias("mdmCounterForEntity"),
        (F.col("l_returnflag") == "R").alias("mdmDeleted"),
        F.col("l_shipdate").alias("mdmLastUpdated"),
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus")


# --- documents with their lines as nested elements --------------------------------

LINES_SQL = """
line AS (
  SELECT doc_id, source, no, body, regexp_replace(lower(split_part(body, ' ', 1)), '[^a-z]', '', 'g') AS head,
         nullif(split_part(body, ',', 2), '') AS mark, CAST(length(body) AS INTEGER) AS n_chars,
         CAST(length(body) % 180 - 90 AS DOUBLE) AS lat, CAST(no * 7 % 360 - 180 AS DOUBLE) AS lon
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS body,
               generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents))"""


def lined(t: Tables, *wanted: str) -> DataFrame:
    """Documents whose ``lines`` are structs: number, body, head word, mark, size, spot.

    ``wanted`` keeps some of these fields, as a scan of stored elements would.
    """
    def line(body, i):
        no = i + 1
        fields = {
            "no": no,
            "body": body,
            "head": F.regexp_replace(F.lower(F.split_part(body, F.lit(" "), F.lit(1))), "[^a-z]", ""),
            "mark": F.nullif(F.split_part(body, F.lit(","), F.lit(2)), F.lit("")),
            "n_chars": F.length(body),
            "spot": F.struct((F.length(body) % 180 - 90).cast("double").alias("lat"),
                             (no * 7 % 360 - 180).cast("double").alias("lon")),
        }
        return F.struct(*[fields[n].alias(n) for n in wanted or fields])

    return t.documents.select("doc_id", "source", F.transform(F.split("text", "\n"), line).alias("lines"))


# --- customers with missing values, a point, an envelope ---------------------------

SPARSE_SQL = """
sparse AS (
  SELECT c_custkey, c_name, c_nationkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal
  FROM customer)"""


def sparse(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", "c_name", "c_nationkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))


GEO_SQL = """
placed AS (
  SELECT c_custkey, CAST(c_custkey % 180 - 90 AS DOUBLE) AS lat,
         CAST(c_nationkey * 14 - 180 AS DOUBLE) AS lon FROM customer)"""


def placed(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.struct(
        (F.col("c_custkey") % 180 - 90).cast("double").alias("lat"),
        (F.col("c_nationkey") * 14 - 180).cast("double").alias("lon")).alias("point"))


HITS_SQL = """
hits AS (
  SELECT 'c' || c_custkey AS "mdmId", 'customerGolden' AS "mdmEntityType", c_custkey, c_name, c_nationkey,
         c_acctbal, c_mktsegment, c_acctbal >= 0 AS has_values,
         CASE WHEN c_acctbal < 1000 AND c_mktsegment = 'MACHINERY' THEN 'LOW:BALANCE;BAD:SEGMENT'
              WHEN c_acctbal < 1000 THEN 'LOW:BALANCE'
              WHEN c_mktsegment = 'MACHINERY' THEN 'BAD:SEGMENT' ELSE '' END AS errors
  FROM customer)"""


def hits(t: Tables) -> DataFrame:
    """Customers in the golden envelope; debtors have no values, some have errors."""
    fields = F.struct("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    low, bad = F.col("c_acctbal") < 1000, F.col("c_mktsegment") == "MACHINERY"
    return t.customer.select(
        F.concat(F.lit("c"), "c_custkey").alias("mdmId"),
        F.lit("customerGolden").alias("mdmEntityType"),
        F.array_compact(F.array(F.when(low, "LOW:BALANCE"), F.when(bad, "BAD:SEGMENT"))).alias("mdmErrors"),
        F.when(F.col("c_acctbal") >= 0, fields).alias("mdmGoldenFieldAndValues"))


# --- log and task rows (events) -----------------------------------------------------

LOG_SQL = """
log AS (
  SELECT event_id, user_id, ts,
         CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'WARNING'
                         WHEN 'signup' THEN 'INFO' WHEN 'click' THEN 'DEBUG' ELSE 'ERROR' END AS level,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED'
                         WHEN 'signup' THEN 'READY' WHEN 'click' THEN 'RUNNING' ELSE 'CANCELED' END AS status
  FROM events)"""


def log(t: Tables) -> DataFrame:
    def by_type(error, purchase, signup, click, other):
        e = F.col("event_type")
        return (F.when(e == "error", error).when(e == "purchase", purchase).when(e == "signup", signup)
                .when(e == "click", click).otherwise(other))

    return t.events.select(
        "event_id", "user_id", "ts",
        by_type("CRITICAL", "WARNING", "INFO", "DEBUG", "ERROR").alias("level"),
        by_type("FAILED", "COMPLETED", "READY", "RUNNING", "CANCELED").alias("status"))
