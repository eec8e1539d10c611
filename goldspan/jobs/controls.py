"""Query controls: fields, order, pages, counts, deletes, key ranges, templates."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from goldspan.jobs import fixtures as fx
from goldspan.jobs.base import Tables, job
from goldspan.operators import controls as q
from goldspan.operators.deletes import DeletableTable
from goldspan.plans.aggregations import run
from goldspan.plans.filters import Predicate, Search, apply_filter, between, has_type, term
from goldspan.plans.request import aggregations, find
from goldspan.plans.named import bind_search, run_sql_template
from goldspan.session import workspace


@job("qry_fields", f"""WITH {fx.HITS_SQL} SELECT CASE WHEN has_values THEN c_name END AS c_name,
     CASE WHEN has_values THEN c_acctbal END AS c_acctbal, "mdmId" FROM hits""")
def _(t: Tables):
    return q.pick_fields(fx.hits(t), ["mdmGoldenFieldAndValues.c_name.raw", "mdmGoldenFieldAndValues.c_acctbal", "mdmId"])


@job("qry_only_hits", f"""WITH {fx.HITS_SQL} SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
     FROM hits WHERE has_values""")
def _(t: Tables):
    return q.hits_only(fx.hits(t))


@job("qry_sort", f"WITH {fx.SPARSE_SQL} SELECT c_custkey, c_acctbal FROM sparse ORDER BY c_acctbal DESC NULLS LAST")
def _(t: Tables):
    return q.sort_records(fx.sparse(t), "c_acctbal", "DESC").select("c_custkey", "c_acctbal")


@job("qry_page", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100 OFFSET 300""")
def _(t: Tables):
    return q.page(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], offset=300, page_size=100)


@job("qry_scan_all", "SELECT event_id, user_id, value FROM events WHERE value >= 20")
def _(t: Tables):
    return apply_filter(t.events, between("value", 20.0)).select("event_id", "user_id", "value")


@job("qry_limit", "SELECT event_id, value FROM events WHERE value >= 20 ORDER BY event_id LIMIT 250")
def _(t: Tables):
    return q.at_most(apply_filter(t.events, between("value", 20.0)).select("event_id", "value"), ["event_id"], 250)


@job("qry_count", "SELECT count(*) AS total_hits FROM lineitem WHERE l_returnflag = 'A' AND l_quantity <= 10")
def _(t: Tables):
    return q.count_hits(t.lineitem, Search(must=[term("l_returnflag", "A"), between("l_quantity", None, 10.0)]))


@job("qry_all_of_type", f'WITH {fx.HITS_SQL} SELECT "mdmId", "mdmEntityType" FROM hits')
def _(t: Tables):
    return q.all_of_type({"customerGolden": fx.hits(t)}, "customer").select("mdmId", "mdmEntityType")


@job("qry_safe_check", f'WITH {fx.STAGED_SQL} SELECT "mdmId", count(*) AS n FROM staged GROUP BY 1 HAVING count(*) > 1')
def _(t: Tables):
    return q.repeated_ids(fx.staged(t))


@job("qry_errors", f"""WITH {fx.HITS_SQL} SELECT "mdmId", errors AS "mdmErrors" FROM hits WHERE errors <> ''""")
def _(t: Tables):
    return q.record_errors(fx.hits(t)).withColumn("mdmErrors", F.array_join("mdmErrors", ";"))


@job("qry_delete", f"""WITH {fx.SPARSE_SQL} SELECT c_custkey, c_mktsegment, c_acctbal FROM sparse
     WHERE NOT coalesce(c_acctbal >= 3000 AND NOT coalesce(c_mktsegment = 'FURNITURE', false), false)""")
def _(t: Tables):
    gone = Search(must=[between("c_acctbal", 3000.0)], must_not=[term("c_mktsegment", "FURNITURE")])
    left, _count = q.delete_to(fx.sparse(t), gone, workspace(t.spark, "delete"))
    return left.select("c_custkey", "c_mktsegment", "c_acctbal")


@job("qry_delete_marks", """
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' OR o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE')) AS gone FROM orders
WHERE o_orderstatus <> 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE')""")
def _(t: Tables):
    """Orders deleted by a field and by values from another table, folded in between; no record is rewritten for a delete."""
    table = DeletableTable(t.spark, workspace(t.spark, "orders"))
    table.append(t.orders.where("o_orderkey % 2 = 0"))
    table.append(t.orders.where("o_orderkey % 2 <> 0"))
    gone = table.delete(term("o_orderstatus", "P"))
    table.fold()
    segment = Search(must=[has_type("customer"), term("c_mktsegment", "FURNITURE")])
    gone += table.delete(Predicate("TERMS_FILTER", "o_custkey", values_field="c_custkey", values_query=segment), {"customer": t.customer})
    return table.read().select("o_orderkey", "o_totalprice", F.lit(gone).cast("long").alias("gone"))


@job("qry_delete_golden", """
WITH base AS (SELECT o_orderkey, o_orderstatus,
                CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderdate END AS updated FROM orders)
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Golden' WHEN 'O' THEN 'Master' ELSE 'Rejected' END AS kind
FROM base WHERE NOT coalesce(updated <= TIMESTAMP '1998-06-30 00:00:00', false)""")
def _(t: Tables):
    """Orders stand for the three record types of one model, some without an update time."""
    updated = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderdate"))
    base = t.orders.select("o_orderkey", "o_orderstatus", updated.alias("mdmLastUpdated"))
    kinds = {"Golden": "F", "Master": "O", "Rejected": "P"}
    tables = {f"order{k}": base.where(F.col("o_orderstatus") == s) for k, s in kinds.items()}
    left = q.delete_model_records(tables, "order", datetime.datetime(1998, 6, 30))
    frames = [left[f"order{k}"].select("o_orderkey", F.lit(k).alias("kind")) for k in kinds]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@job("qry_bounds", f"""WITH {fx.STAGED_SQL}
     SELECT CAST(trunc(min(l_suppkey) * 1.5) AS BIGINT) - 10 AS min_key, CAST(trunc(max(l_suppkey) * 1.5) AS BIGINT) + 10 AS max_key
     FROM staged WHERE "mdmDeleted" """)
def _(t: Tables):
    return q.key_bounds(fx.staged(t), "l_suppkey", term("mdmDeleted", True), 1.5)


RANGES_SQL = """
b AS (SELECT min(o_orderkey) AS lo, CASE WHEN min(o_orderkey) = max(o_orderkey) THEN max(o_orderkey) + 1 ELSE max(o_orderkey) END AS hi FROM orders),
s AS (SELECT lo, hi, CAST(floor((hi - lo) / 37.0) AS BIGINT) + 1 AS step FROM b),
starts AS (SELECT unnest(range(lo, hi, step)) AS a, lo, hi, step FROM s),
ranges AS (
  SELECT 0 AS slice, CAST(NULL AS BIGINT) AS range_from, lo - 1 AS range_to FROM b
  UNION ALL SELECT CAST(row_number() OVER (ORDER BY a) AS INTEGER), a, least(a + step, hi) - 1 FROM starts
  UNION ALL SELECT CAST((SELECT count(*) FROM starts) + 1 AS INTEGER), hi, NULL FROM b)"""


@job("qry_ranges", f"WITH {RANGES_SQL} SELECT * FROM ranges")
def _(t: Tables):
    return q.key_ranges(q.key_bounds(t.orders, "o_orderkey"), 37)


@job("qry_slice_counts", f"""WITH {RANGES_SQL} SELECT slice, count(*) AS n FROM ranges JOIN orders
     ON (range_from IS NULL OR o_orderkey >= range_from) AND (range_to IS NULL OR o_orderkey <= range_to) GROUP BY slice""")
def _(t: Tables):
    """Every key lies in exactly one range: found by arithmetic, not by a range join."""
    low, high = q.key_bounds(t.orders, "o_orderkey").first()
    sliced = t.orders.select(q.slice_of(F.col("o_orderkey"), low, high, 37).alias("slice"))
    return sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))


@job("qry_parallel_scan", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_linestatus = 'O'")
def _(t: Tables):
    kept = apply_filter(t.lineitem, term("l_linestatus", "O")).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return q.range_scan(kept, "l_orderkey", 16).drop("slice")


@job("qry_rejected_of_staging", """SELECT 'o' || o_orderkey AS "mdmId", o_totalprice AS price_total, o_orderpriority AS price_class
     FROM orders WHERE o_orderstatus = 'P'""")
def _(t: Tables):
    rejected = t.orders.select(
        F.concat(F.lit("o"), "o_orderkey").alias("mdmId"),
        F.when(F.col("o_orderstatus") == "P", "shop_orders").otherwise("web_orders").alias("mdmStagingEntityName"),
        F.struct(F.col("o_totalprice").alias("price_total"), F.col("o_orderpriority").alias("price_class"),
                 F.col("o_custkey").alias("customer")).alias("mdmStagingRecord"))
    return q.rejected_of_staging(rejected, "shop_orders", ["price"])


@job("qry_named", """SELECT o_orderstatus AS status, count(*) AS doc_count FROM orders
     WHERE o_orderpriority = '2-HIGH' AND o_totalprice BETWEEN 20000 AND 400000 GROUP BY 1""")
def _(t: Tables):
    template = {
        "mustList": [
            {"mdmFilterType": "TERM_FILTER", "mdmKey": "o_orderpriority.raw", "mdmValue": "{{priority}}"},
            {"mdmFilterType": "RANGE_FILTER", "mdmKey": "o_totalprice", "mdmValue": ["{{low}}", "{{high}}"]},
        ],
        "aggregationList": [{"type": "TERM", "name": "status", "params": "o_orderstatus"}],
    }
    search = bind_search(template, {"priority": "2-HIGH", "low": 20000.0, "high": 400000.0})
    return run(t.orders, search)["status"]


@job("qry_named_sql", """SELECT o_orderstatus AS status, round(sum(o_totalprice), 2) AS total FROM orders
     WHERE o_orderpriority = '2-HIGH' AND o_totalprice >= 20000 GROUP BY 1""")
def _(t: Tables):
    template = """SELECT o_orderstatus AS status, round(sum(o_totalprice), 2) AS total FROM orders
                  WHERE o_orderpriority = {{priority}} AND o_totalprice >= {{ low }} GROUP BY 1"""
    return run_sql_template(t.view("orders"), template, {"priority": "2-HIGH", "low": 20000.0})


@job("qry_request", f"""WITH {fx.HITS_SQL} SELECT c_custkey, c_name, c_acctbal FROM hits
     WHERE has_values AND c_mktsegment <> 'MACHINERY' AND c_acctbal >= 500 ORDER BY c_acctbal DESC, "mdmId" LIMIT 120""")
def _(t: Tables):
    """A whole query in its JSON form: type, filter, sort field, size and result form."""
    wire = {
        "mustList": [
            {"mdmFilterType": "TYPE_FILTER", "mdmValue": "customerGolden"},
            {"mdmFilterType": "RANGE_FILTER", "mdmKey": "mdmGoldenFieldAndValues.c_acctbal", "mdmValue": [500.0, None]},
        ],
        "mustNotList": [{"mdmFilterType": "TERM_FILTER", "mdmKey": "mdmGoldenFieldAndValues.c_mktsegment.raw", "mdmValue": "MACHINERY"}],
    }
    found = find({"customerGolden": fx.hits(t)}, wire, sort_by="mdmGoldenFieldAndValues.c_acctbal", sort_order="DESC", max_hits=120)
    return found.select("c_custkey", "c_name", "c_acctbal")


@job("qry_request_types", """SELECT o_orderstatus AS status, count(*) AS doc_count FROM orders
     WHERE o_orderstatus IN ('F', 'O') AND o_orderdate <= TIMESTAMP '1998-06-30 00:00:00' GROUP BY 1""")
def _(t: Tables):
    """Two record types named as alternatives are searched together."""
    tables = {"orderGolden": t.orders.where("o_orderstatus = 'F'"), "orderMaster": t.orders.where("o_orderstatus = 'O'"),
              "orderRejected": t.orders.where("o_orderstatus = 'P'")}
    wire = {
        "mustList": [{"mdmFilterType": "RANGE_FILTER", "mdmKey": "o_orderdate", "mdmValue": [None, "1998-06-30"]}],
        "shouldList": [{"mdmFilterType": "TYPE_FILTER", "mdmValue": "orderGolden"},
                       {"mdmFilterType": "TYPE_FILTER", "mdmValue": "orderMaster"}],
        "aggregationList": [{"type": "TERM", "name": "status", "params": "o_orderstatus"}],
    }
    return aggregations(tables, wire)["status"]
