"""SQL over registered tables, and the plans behind the harder SQL forms."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from goldspan.jobs.base import Tables, job
from goldspan.operators import windows
from goldspan.operators.joins import interval_join, latest_before, left_join_many
from goldspan.operators.sqlapi import TableCache, check_select, run_sql
from goldspan.session import stored


def sql_job(name: str, tables: str, text: str, twin: str | None = None) -> None:
    """A SELECT run through the SQL surface; ``twin`` where DuckDB words it differently."""
    @job(name, twin or text)
    def _(t: Tables):
        return run_sql(t.spark, text, **{n: getattr(t, n) for n in tables.split()})


sql_job("sql_query", "orders customer", """
SELECT c_nationkey, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' GROUP BY c_nationkey""")


@job("sql_select_only", "SELECT 'a;b' AS label, n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def _(t: Tables):
    """The guard keeps a quoted semicolon, a closing one and a comment; it refuses anything but a query."""
    spark = t.view("nation")
    refused = 0
    for text in ("DROP VIEW nation", "SELECT 1; DROP VIEW nation", "WITH x AS (SELECT 1) INSERT INTO nation SELECT * FROM x",
                 "SELECT 1) AS q; DROP VIEW nation --", "SET a = 1", "", ";"):
        try:
            check_select(spark, text)
        except ValueError:
            refused += 1
    if refused != 7:
        raise AssertionError("a statement that is not a query was let through")
    return TableCache(spark).query("SELECT 'a;b' AS label, n_nationkey, n_name FROM nation -- all\n WHERE n_regionkey = 2;")


@job("mem_add", "SELECT c_custkey AS k, c_name AS name FROM customer")
def _(t: Tables):
    cache = TableCache(t.spark)
    cache.add("people", t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")))
    cache.add("people", t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")))
    return cache.query("SELECT k, name FROM people")


@job("mem_append", "SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(t: Tables):
    cache = TableCache(t.spark, [(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")), "folk")])
    cache.append("folk", t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal"), F.col("s_suppkey").alias("k")))
    return cache.query("SELECT k, name FROM folk")


@job("mem_delete", "SELECT 'gone' AS state, count(*) AS n_parts FROM part")
def _(t: Tables):
    cache = TableCache(t.spark, [(t.part, "short_lived"), (t.part, "kept_parts")])
    cache.delete("short_lived")
    cache.delete("short_lived")  # a table that is not there is no error
    state = "kept" if t.spark.catalog.tableExists("short_lived") else "gone"
    return cache.query("SELECT count(*) AS n_parts FROM kept_parts").select(F.lit(state).alias("state"), "n_parts")


@job("mem_cache_many", """SELECT r_name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey
     JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name""")
def _(t: Tables):
    cache = TableCache(t.spark)
    cache.add_many([(t.region, "m_region"), (t.nation, "m_nation"), (t.customer, "m_customer")])
    return cache.query("""SELECT r_name, count(*) AS n FROM m_region JOIN m_nation ON n_regionkey = r_regionkey
                          JOIN m_customer ON c_nationkey = n_nationkey GROUP BY r_name""")


# --- joins ------------------------------------------------------------------------------

sql_job("sql_join_inner", "orders customer",
        "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
@job("sql_join_left", """SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN orders
     ON o_custkey = c_custkey AND o_totalprice > 400000""")
def _(t: Tables):
    dear = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return left_join_many(t.customer.select("c_custkey"), dear, ["c_custkey"])


sql_job("sql_join_full", "customer supplier", """
SELECT c.k AS c_nation, s.k AS s_nation, c.n AS customers, s.n AS suppliers FROM
 (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) c FULL JOIN
 (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) s ON c.k = s.k""")
# the inner tables are made distinct: a key of very many rows is then one row
sql_job("sql_join_semi", "orders customer", """
SELECT c_custkey, c_name FROM customer LEFT SEMI JOIN
 (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey""", """
SELECT c_custkey, c_name FROM customer WHERE EXISTS
 (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
sql_job("sql_join_anti", "part lineitem", """
SELECT p_partkey, p_name FROM part LEFT ANTI JOIN
 (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25) ON l_partkey = p_partkey""", """
SELECT p_partkey, p_name FROM part WHERE NOT EXISTS
 (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 25)""")


@job("sql_join_range", """SELECT event_id, value, n_name AS band FROM events JOIN nation
     ON value >= n_nationkey * 20.0 AND value < n_nationkey * 20.0 + 35.0""")
def _(t: Tables):
    low = F.col("n_nationkey") * 20.0
    bands = t.nation.select(F.col("n_name").alias("band"), low.alias("low"), (low + 35.0).alias("high"))
    return interval_join(t.events.select("event_id", "value"), "value", bands, "low", "high", 20.0).drop("low", "high")


@job("sql_join_asof", """SELECT e.event_id, p.event_id AS previous_event_id, p.value AS previous_value
     FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
     ON e.user_id = p.user_id AND e.ts > p.ts""")
def _(t: Tables):
    """Each event with that user's purchase before it."""
    e = t.events.select("event_id", "user_id", "ts")
    purchases = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    found = latest_before(e, purchases, "user_id", "ts", ["event_id", "value"], "event_id")
    return found.select("event_id", "previous_event_id", "previous_value")


# --- aggregates ----------------------------------------------------------------------------

sql_job("sql_agg_group", "lineitem", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base,
       round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus""")
sql_job("sql_agg_distinct", "lineitem", """
SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag""")
_GROUPED = """
SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) + grouping(l_linestatus) AS BIGINT) AS level, count(*) AS n,
       round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY """
sql_job("sql_agg_rollup", "lineitem", _GROUPED + "ROLLUP (l_returnflag, l_linestatus)")
sql_job("sql_agg_cube", "lineitem", _GROUPED + "CUBE (l_returnflag, l_linestatus)")
sql_job("sql_agg_grouping_sets", "lineitem", _GROUPED + "GROUPING SETS ((l_returnflag), (l_linestatus), ())")


# --- windows ---------------------------------------------------------------------------------

@job("sql_window_rank", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS row_number,
  rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rank,
  dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS dense_rank FROM orders""")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.ranked(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderdate"]).drop("o_orderdate")


@job("sql_window_lag", """
SELECT event_id, lag(value) OVER w AS previous_value, lead(value) OVER w AS next_value,
  first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_value,
  last_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    return windows.neighbours(rows, ["user_id"], ["ts", "event_id"], ["value"]).drop("user_id", "ts", "value")


@job("sql_window_frame", """SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
     ROWS UNBOUNDED PRECEDING), 4) AS running FROM events""")
def _(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = windows.running_sum(rows, ["user_id"], ["ts", "event_id"], "value", "running")
    return out.select("event_id", F.round("running", 4).alias("running"))


@job("sql_window_rows", """SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
     ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS mean_of_three FROM events""")
def _(t: Tables):
    """A frame of three rows: the row and the two before."""
    rows = t.events.select("event_id", "user_id", "ts", "value")
    out = windows.framed(rows, ["user_id"], ["ts", "event_id"], {"mean_of_three": ("avg", "value")}, -2, 0)
    return out.select("event_id", F.round("mean_of_three", 4).alias("mean_of_three"))


@job("sql_window_open", """SELECT event_id, round(sum(value) OVER w, 4) AS total, min(value) OVER w AS least,
     count(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 5 FOLLOWING AND UNBOUNDED FOLLOWING) AS to_come
     FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 3 FOLLOWING)""")
def _(t: Tables):
    """Frames that start with the key's first row or end with its last one; the few event types are crowded keys."""
    rows = t.events.select("event_id", "event_type", "ts", "value")
    by, order = ["event_type"], ["ts", "event_id"]
    # a stored result is worked out once, not for each reading by the next frames
    out = stored(windows.framed(rows, by, order, {"total": ("sum", "value"), "least": ("min", "value")}, None, 3), "frames")
    out = windows.framed(out, by, order, {"to_come": ("count", "value")}, 5, None)
    return out.select("event_id", F.round("total", 4).alias("total"), "least", "to_come")


@job("sql_window_near", """SELECT event_id, round(sum(value) OVER f, 4) AS around, min(value) OVER f AS least,
     max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 30 PRECEDING AND 3 PRECEDING) AS before
     FROM events WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 4 FOLLOWING)""")
def _(t: Tables):
    """Frames of a few rows around the row or before it."""
    rows = t.events.select("event_id", "event_type", "ts", "value")
    by, order = ["event_type"], ["ts", "event_id"]
    out = stored(windows.framed(rows, by, order, {"around": ("sum", "value"), "least": ("min", "value")}, -1, 4), "frames")
    out = windows.framed(out, by, order, {"before": ("max", "value")}, -30, -3)
    return out.select("event_id", F.round("around", 4).alias("around"), "least", "before")


@job("sql_window_range", """SELECT event_id, round(sum(value) OVER w, 4) AS week, min(value) OVER w AS least, max(value) OVER w AS most,
     count(*) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 HOUR FOLLOWING) AS so_far
     FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)""")
def _(t: Tables):
    """Frames of a span of time, over the few event types."""
    rows = t.events.select("event_id", "event_type", "ts", "value")
    values = {"week": ("sum", "value"), "least": ("min", "value"), "most": ("max", "value")}
    out = stored(windows.framed_by_value(rows, ["event_type"], "ts", values, -timedelta(days=7), 0), "frames")
    out = windows.framed_by_value(out, ["event_type"], "ts", {"so_far": ("count", "event_id")}, None, timedelta(hours=1))
    return out.select("event_id", F.round("week", 4).alias("week"), "least", "most", "so_far")


# --- order, sets, composition -------------------------------------------------------------------

sql_job("sql_topk", "orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
sql_job("sql_union", "customer supplier", """
SELECT c_nationkey AS k, 'distinct' AS kind FROM customer UNION SELECT s_nationkey, 'distinct' FROM supplier
UNION ALL SELECT s_nationkey, 'all' FROM supplier""")
sql_job("sql_intersect", "customer supplier", """
SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 5000 INTERSECT SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 5000""")
sql_job("sql_except", "nation supplier", """
SELECT n_nationkey AS k FROM nation EXCEPT SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 7000""")
sql_job("sql_cte", "lineitem supplier", """
WITH revenue AS (SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS r FROM lineitem GROUP BY l_suppkey),
best AS (SELECT max(r) AS r FROM revenue)
SELECT s_suppkey, s_name, round(revenue.r, 2) AS revenue FROM supplier JOIN revenue ON s_suppkey = l_suppkey
WHERE revenue.r >= 0.9 * (SELECT r FROM best)""")
sql_job("sql_subquery", "orders", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o_totalprice > (SELECT 1.2 * avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""")


# --- scalar functions ------------------------------------------------------------------------------

sql_job("sql_string", "part", """
SELECT p_partkey, upper(p_name) AS up, substr(p_name, 2, 4) AS part4, replace(p_brand, '#', '-') AS brand, length(p_type) AS n,
       concat(p_type, '/', p_brand) AS path, trim(concat('  ', p_name, ' ')) AS trimmed, lpad(CAST(p_size AS STRING), 4, '0') AS size4,
       regexp_replace(p_name, '[aeiou]+', '*') AS starred, reverse(p_type) AS back FROM part""", """
SELECT p_partkey, upper(p_name) AS up, substr(p_name, 2, 4) AS part4, replace(p_brand, '#', '-') AS brand, CAST(length(p_type) AS INTEGER) AS n,
       concat(p_type, '/', p_brand) AS path, trim(concat('  ', p_name, ' ')) AS trimmed, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size4,
       regexp_replace(p_name, '[aeiou]+', '*', 'g') AS starred, reverse(p_type) AS back FROM part""")
sql_job("sql_date", "orders", """
SELECT o_orderkey, date_format(date_trunc('month', o_orderdate), 'yyyy-MM-dd') AS month, year(o_orderdate) AS y, quarter(o_orderdate) AS q,
       extract(DOY FROM o_orderdate) AS doy, date_diff(DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS age,
       date_format(add_months(o_orderdate, 3), 'yyyy-MM-dd') AS due, date_format(last_day(o_orderdate), 'yyyy-MM-dd') AS closes FROM orders""", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(extract(DOY FROM o_orderdate) AS INTEGER) AS doy,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS age,
       strftime(o_orderdate + INTERVAL 3 MONTH, '%Y-%m-%d') AS due, strftime(last_day(o_orderdate), '%Y-%m-%d') AS closes FROM orders""")
sql_job("sql_math", "lineitem", """
SELECT l_linestatus, round(sum(abs(l_quantity - 25)), 2) AS spread, round(sum(sqrt(l_quantity)), 4) AS roots,
       sum(CAST(l_quantity AS BIGINT) % 7) AS sevens, round(sum(pow(l_discount, 2)), 6) AS squares, round(max(ln(l_extendedprice)), 6) AS top_log,
       round(sum(greatest(l_discount, l_tax)), 4) AS larger, count(CASE WHEN sign(l_quantity - 25) < 0 THEN 1 END) AS below
FROM lineitem GROUP BY l_linestatus""", """
SELECT l_linestatus, round(sum(abs(l_quantity - 25)), 2) AS spread, round(sum(sqrt(l_quantity)), 4) AS roots,
       CAST(sum(CAST(l_quantity AS BIGINT) % 7) AS BIGINT) AS sevens, round(sum(pow(l_discount, 2)), 6) AS squares, round(max(ln(l_extendedprice)), 6) AS top_log,
       round(sum(greatest(l_discount, l_tax)), 4) AS larger, count(CASE WHEN sign(l_quantity - 25) < 0 THEN 1 END) AS below
FROM lineitem GROUP BY l_linestatus""")
sql_job("sql_array", "documents", r"""
SELECT doc_id, size(w) AS n_words, size(array_distinct(w)) AS n_different, array_contains(w, 'the') AS has_the,
       element_at(array_sort(w), 1) AS smallest, element_at(w, -1) AS last_word
FROM (SELECT doc_id, split(text, ' ') AS w FROM documents)""", r"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, CAST(len(list_distinct(w)) AS INTEGER) AS n_different, list_contains(w, 'the') AS has_the,
       list_sort(w)[1] AS smallest, w[-1] AS last_word FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""")
sql_job("sql_array_explode", "documents", r"""
SELECT lang, word, count(*) AS n FROM (SELECT lang, explode(split(text, ' ')) AS word FROM documents)
GROUP BY lang, word HAVING count(*) >= 100""", r"""
SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY lang, word HAVING count(*) >= 100""")
sql_job("sql_map", "events", """
SELECT key, count(*) AS n, sum(val) AS total, max(size(m)) AS entries
FROM (SELECT m, explode(m) AS (key, val) FROM
      (SELECT map_concat(from_json(props, 'map<string,bigint>'), map('u', user_id)) AS m FROM events)) GROUP BY key""", """
SELECT key, count(*) AS n, CAST(sum(val) AS BIGINT) AS total, 2 AS entries FROM
 (SELECT 'k' AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS val FROM events
  UNION ALL SELECT 'u', user_id FROM events) GROUP BY key""")
sql_job("sql_json", "events", """
SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, from_json(props, 'k BIGINT').k + 1 AS k1,
       try_variant_get(parse_json(props), '$.k', 'string') AS text_k, get_json_object(props, '$.missing') AS absent FROM events""", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS k1,
       json_extract_string(props, '$.k') AS text_k, json_extract_string(props, '$.missing') AS absent FROM events""")
