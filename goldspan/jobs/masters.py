"""Master-data steps: crosswalks, merge, mapping, validation, connectors, logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldspan.jobs import fixtures as fx
from goldspan.jobs.base import Tables, job
from goldspan.jobs.rules import CONTACTS_SQL, contacts
from goldspan.operators import master as m
from goldspan.operators import envelope, opslog
from goldspan.operators.rules import Rule, errors_of
from goldspan.operators.sinks import write_validated
from goldspan.plans.filters import Predicate, Search, has_type, term
from goldspan.session import workspace


@job("rec_staging", """SELECT 'shop_orders-' || o_orderkey AS "mdmId", o_orderkey AS "mdmCounterForEntity", 'shop' AS "mdmConnectorId",
     o_orderstatus = 'P' AS "mdmDeleted", o_totalprice FROM orders""")
def _(t: Tables):
    """Orders as staging records."""
    return staged_orders(t).select("mdmId", "mdmCounterForEntity", "mdmConnectorId", "mdmDeleted", "o_totalprice")


def staged_orders(t: Tables):
    return envelope.staging_records(
        t.orders, "shop", "orders", ["o_orderkey"], "o_orderkey", "o_orderdate", F.col("o_orderstatus") == "P")


ORDER_FIELDS = ["o_orderkey", "o_totalprice", "o_orderpriority"]


@job("rec_golden", """SELECT 'shop_orders-' || o_orderkey AS "mdmId", 'orderGolden' AS "mdmEntityType", o_orderkey AS "mdmStagingCounter",
     CAST(o_orderkey AS VARCHAR) AS natural_key, o_orderpriority AS priority, CAST(0 AS INTEGER) AS n_previous FROM orders WHERE o_orderstatus <> 'P'""")
def _(t: Tables):
    """Merged staging records in the golden envelope, read by enveloped names."""
    merged = m.merge_latest(staged_orders(t))
    golden = envelope.golden_records(merged, "order", "t1", "orders", ["o_orderkey"], ORDER_FIELDS)
    return golden.select(
        "mdmId", "mdmEntityType", "mdmStagingCounter", F.col("mdmCrosswalk")["orders"][0].alias("natural_key"),
        F.col("mdmGoldenFieldAndValues.o_orderpriority").alias("priority"), F.size("mdmPreviousIds").alias("n_previous"))


@job("rec_rejected", """SELECT 'shop_orders-' || o_orderkey AS "mdmId", 'shop_orders' AS "mdmStagingEntityName", 'EQUALS:o_orderpriority' AS error,
     o_totalprice AS price FROM orders WHERE o_orderpriority = '5-LOW'""")
def _(t: Tables):
    """Staging records a rule rejects, as rows of the model's rejected table."""
    checked = errors_of(staged_orders(t), [Rule("EQUALS", "o_orderpriority", ("5-LOW",))]).where(F.size("mdmErrors") > 0)
    rejected = envelope.rejected_records(checked, "order", "t1", "orders", ["o_orderkey"], ORDER_FIELDS)
    return rejected.select("mdmId", "mdmStagingEntityName", F.col("mdmErrors")[0].alias("error"),
                           F.col("mdmStagingRecord.o_totalprice").alias("price"))


@job("mdm_crosswalk_dups", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t: Tables):
    return m.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


LATEST_SQL = """
latest AS (SELECT * FROM staged QUALIFY row_number() OVER (PARTITION BY "mdmId" ORDER BY "mdmCounterForEntity" DESC,
  l_discount DESC, l_extendedprice DESC, l_linestatus DESC, l_quantity DESC, l_suppkey DESC, l_tax DESC,
  "mdmDeleted" DESC, "mdmLastUpdated" DESC) = 1)"""
LATEST_COLUMNS = '"mdmId", "mdmCounterForEntity", l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus'


@job("mdm_merge_latest", f'WITH {fx.STAGED_SQL}, {LATEST_SQL} SELECT {LATEST_COLUMNS} FROM latest WHERE NOT "mdmDeleted"')
def _(t: Tables):
    return m.merge_latest(fx.staged(t)).select(*LATEST_COLUMNS.replace('"', "").split(", "))


@job("mdm_map_staging", """SELECT p_partkey AS product_id, CAST(floor(p_retailprice) AS BIGINT) AS whole_price,
     TRY_CAST(p_name AS DOUBLE) AS not_a_number, p_type AS kind FROM part""")
def _(t: Tables):
    priced = t.part.withColumn("p_retailprice", F.floor("p_retailprice"))
    return m.map_fields(priced, {
        "product_id": ("p_partkey", "long"), "whole_price": ("p_retailprice", "long"),
        "not_a_number": ("p_name", "double"), "kind": ("p_type", "enum")})


@job("mdm_union_sources", """
SELECT 'crm' AS connector, 'customers' AS staging, c_custkey AS party, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'erp', 'suppliers', s_suppkey, s_name, s_acctbal, NULL FROM supplier
UNION ALL SELECT 'erp', 'customers', c_custkey, upper(c_name), NULL, NULL FROM customer""")
def _(t: Tables):
    crm = m.map_fields(t.customer, {"party": ("c_custkey", "long"), "name": ("c_name", "string"),
                                    "balance": ("c_acctbal", "double"), "segment": ("c_mktsegment", "string")})
    suppliers = m.map_fields(t.supplier, {"party": ("s_suppkey", "long"), "name": ("s_name", "string"),
                                          "balance": ("s_acctbal", "double")})
    loud = t.customer.select(F.col("c_custkey").alias("party"), F.upper("c_name").alias("name"))
    return m.union_sources({"crm": {"customers": crm}, "erp": {"suppliers": suppliers, "customers": loud}})


def contact_rules(t: Tables) -> list[Rule]:
    rich = t.supplier.where("s_acctbal > 6000")
    return [
        Rule("IS_EMPTY", "note"),
        Rule("IS_EMAIL", "email", negate=True),
        Rule("IS_NOT_NUMBER_ONLY", "phone"),
        Rule("LOOKUP", "c_nationkey", ("s_nationkey",), table=rich),
    ]


CHECKED_SQL = CONTACTS_SQL + """,
checked AS (
  SELECT *, concat_ws(';', CASE WHEN note IS NULL OR trim(note) = '' THEN 'IS_EMPTY:note' END,
    CASE WHEN NOT contains(email, '@') THEN 'IS_EMAIL:email' END,
    CASE WHEN contains(phone, '-') THEN 'IS_NOT_NUMBER_ONLY:phone' END,
    CASE WHEN c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 6000) THEN 'LOOKUP:c_nationkey' END) AS errors
  FROM contacts)"""


@job("mdm_validate", f"""WITH {CHECKED_SQL} SELECT c_custkey, CASE WHEN errors = '' THEN 'golden' ELSE 'rejected' END AS kind, errors FROM checked""")
def _(t: Tables):
    checked = errors_of(contacts(t), contact_rules(t))
    kind = F.when(F.size("mdmErrors") == 0, "golden").otherwise("rejected")
    return checked.select("c_custkey", kind.alias("kind"), F.array_join("mdmErrors", ";").alias("errors"))


@job("mdm_validate_stored", f"""WITH {CHECKED_SQL} SELECT errors = '' AS golden, count(*) AS n FROM checked GROUP BY 1""")
def _(t: Tables):
    """Both outcomes written in one pass over the records, then counted."""
    golden, rejected = write_validated(contacts(t), contact_rules(t), workspace(t.spark, "validated"))
    count = F.count(F.lit(1)).alias("n")
    return golden.agg(count).select(F.lit(True).alias("golden"), "n").unionByName(
        rejected.agg(count).select(F.lit(False).alias("golden"), "n"))


@job("mdm_reprocess_rejected", f"""WITH {CHECKED_SQL} SELECT c_custkey,
     CASE WHEN contains(errors, 'IS_EMPTY') OR contains(errors, 'LOOKUP') THEN 'rejected' ELSE 'accepted' END AS outcome
     FROM checked WHERE errors <> ''""")
def _(t: Tables):
    """The e-mail and phone rules are dropped; what passes now is moved out of the rejected table."""
    rules = contact_rules(t)
    _golden, rejected = m.validate(contacts(t), rules)
    accepted, left = m.reprocess(rejected, [rules[0], rules[3]], delete_records=True)
    return accepted.select("c_custkey", F.lit("accepted").alias("outcome")).unionByName(
        left.select("c_custkey", F.lit("rejected").alias("outcome")))


@job("mdm_reprocess_type", """SELECT record_type, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM
     (SELECT CASE o_orderstatus WHEN 'P' THEN 'Rejected' ELSE 'Golden' END AS record_type, o_totalprice FROM orders) GROUP BY 1""")
def _(t: Tables):
    tables = {"orderGolden": t.orders.where("o_orderstatus <> 'P'"), "orderRejected": t.orders.where("o_orderstatus = 'P'")}
    rows = m.reprocess_records(tables, "order", "ALL")
    return rows.groupBy("record_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@job("mdm_reprocess_filter", """
WITH r AS (SELECT o_orderkey, o_totalprice, o_orderpriority, CASE o_orderstatus WHEN 'P' THEN 'Rejected' ELSE 'Golden' END AS kind,
             o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS picked FROM orders)
SELECT CASE WHEN NOT picked THEN kind WHEN o_totalprice > 200000 OR o_orderpriority = '5-LOW' THEN 'Rejected' ELSE 'Golden' END AS kind,
  count(*) AS n, round(sum(o_totalprice), 2) AS total FROM r GROUP BY 1""")
def _(t: Tables):
    """Orders of some customers, golden and rejected alike, are checked by new rules and move to where they belong now."""
    tables = {"orderGolden": t.orders.where("o_orderstatus <> 'P'"), "orderRejected": t.orders.where("o_orderstatus = 'P'"), "customer": t.customer}
    segment = Search(must=[has_type("customer"), term("c_mktsegment", "BUILDING")])
    picked = Search(must=[Predicate("TERMS_FILTER", "o_custkey", values_field="c_custkey", values_query=segment)])
    rules = [Rule("VALUE_COMPARE", "o_totalprice", (">", 200000.0)), Rule("EQUALS", "o_orderpriority", ("5-LOW",))]
    after = m.reprocess_model(tables, "order", rules, query=picked)
    both = after.golden.select("o_totalprice", F.lit("Golden").alias("kind")).unionByName(after.rejected.select("o_totalprice", F.lit("Rejected").alias("kind")))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@job("mdm_reject_report", f"""WITH {CHECKED_SQL} SELECT c_mktsegment, error, count(*) AS n FROM
     (SELECT c_mktsegment, unnest(string_split(errors, ';')) AS error FROM checked WHERE errors <> '') GROUP BY 1, 2""")
def _(t: Tables):
    _golden, rejected = m.validate(contacts(t), contact_rules(t))
    return m.reject_report(rejected, ["c_mktsegment"])


# --- connectors: one per nation, a staging table per market segment -------------------

ENTITIES_SQL = "entities AS (SELECT n_name AS connector, n_nationkey, c_mktsegment AS staging FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def entities(t: Tables):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("connector"), "n_nationkey", F.col("c_mktsegment").alias("staging"))


@job("mdm_connector_stats", f"WITH {ENTITIES_SQL} SELECT connector, staging, count(*) AS n_records FROM entities GROUP BY 1, 2")
def _(t: Tables):
    return m.connector_stats(entities(t), "connector", "staging")


@job("mdm_staging_to_connectors", f"""WITH {ENTITIES_SQL} SELECT staging, string_agg(DISTINCT connector, ',' ORDER BY connector) AS connectors
     FROM entities GROUP BY 1""")
def _(t: Tables):
    return m.staging_to_connectors(entities(t), "connector", "staging").withColumn("connectors", F.array_join("connectors", ","))


@job("mdm_find_by_staging", f"WITH {ENTITIES_SQL} SELECT DISTINCT connector FROM entities WHERE staging = 'MACHINERY'")
def _(t: Tables):
    return m.connectors_of_staging(entities(t), "connector", "staging", "MACHINERY")


@job("mdm_list_stagings", f"WITH {ENTITIES_SQL} SELECT DISTINCT staging FROM entities WHERE connector = 'NATION_7' ORDER BY 1")
def _(t: Tables):
    return m.stagings_of_connector(entities(t), "connector", "staging", "NATION_7")


@job("fn_staging_prefix", """SELECT c_custkey, n_name || '_' || c_mktsegment AS by_name, c_nationkey || '_' || c_mktsegment AS by_id
     FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t: Tables):
    stagings = t.customer.select("c_custkey", F.col("c_nationkey").alias("connector_id"), F.col("c_mktsegment").alias("staging"))
    connectors = t.nation.select(F.col("n_nationkey").alias("connector_id"), F.col("n_name").alias("connector_name"))
    named = m.prefixed_staging(stagings, connectors, "connector_name").select("c_custkey", "connector_id", "staging", F.col("qualified").alias("by_name"))
    return m.prefixed_staging(named, connectors, "connector_id").select("c_custkey", "by_name", F.col("qualified").alias("by_id"))


# --- logs and tasks ---------------------------------------------------------------------

@job("ops_log_level", f"""WITH {fx.LOG_SQL} SELECT event_id, CASE level WHEN 'WARNING' THEN 'WARN' ELSE 'ERROR' END AS level
     FROM log WHERE level IN ('WARNING', 'ERROR', 'CRITICAL')""")
def _(t: Tables):
    return opslog.at_least_level(fx.log(t).select("event_id", "level"), "level", "WARN")


ROLLUP_SQL = fx.LOG_SQL + """,
rollup AS (
  SELECT user_id, max_by(status, (ts, status)) AS last_status, count(*) FILTER (status IN ('FAILED', 'CANCELED')) AS failures
  FROM log GROUP BY user_id)"""


@job("ops_task_rollup", f"""WITH {ROLLUP_SQL} SELECT user_id, last_status, failures,
     last_status <> 'COMPLETED' AND failures > 28 AS exhausted, last_status = 'COMPLETED' OR failures > 28 AS finished FROM rollup""")
def _(t: Tables):
    return opslog.task_rollup(fx.log(t), "user_id", "status", "ts", retry_count=28)


@job("ops_all_done", f"""WITH {ROLLUP_SQL} SELECT count(*) AS n_tasks, count(*) FILTER (last_status = 'COMPLETED') AS n_completed,
     count(*) FILTER (last_status <> 'COMPLETED' AND failures > 28) AS n_exhausted,
     bool_and(last_status = 'COMPLETED' OR failures > 28) AS done FROM rollup""")
def _(t: Tables):
    return opslog.all_done(opslog.task_rollup(fx.log(t), "user_id", "status", "ts", retry_count=28))
