"""Every aggregation of the record language, on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldspan.jobs import fixtures as fx
from goldspan.jobs.base import Tables, job
from goldspan.plans.aggregations import Aggregation as A
from goldspan.plans.aggregations import aggregate, bucket_order, metrics, nested_buckets, run
from goldspan.plans.filters import Search, between, term


def rounded(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def day(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


@job("agg_term", """SELECT l_suppkey AS by_supplier, count(*) AS doc_count FROM lineitem
     GROUP BY 1 ORDER BY doc_count DESC, by_supplier LIMIT 10""")
def _(t: Tables):
    return aggregate(t.lineitem, A("TERM", "by_supplier", "l_suppkey"))["by_supplier"]


@job("agg_terms", """SELECT l_returnflag AS b_l_returnflag, l_linestatus AS b_l_linestatus, l_linenumber AS b_l_linenumber,
     count(*) AS doc_count FROM lineitem GROUP BY ALL ORDER BY doc_count DESC, 1, 2, 3 LIMIT 12""")
def _(t: Tables):
    return aggregate(t.lineitem, A("TERMS", "b", ["l_returnflag", "l_linestatus", "l_linenumber"], size=12))["b"]


@job("agg_nested", f"""WITH {fx.LINES_SQL} SELECT count(*) AS doc_count, CAST(sum(n_chars) AS BIGINT) AS total_chars,
     max(no) AS last_line, count(mark) AS marked FROM line""")
def _(t: Tables):
    sub = (A("SUM", "total_chars", "lines.n_chars"), A("MAXIMUM", "last_line", "lines.no"), A("COUNT", "marked", "lines.mark"))
    out = aggregate(fx.lined(t, "no", "mark", "n_chars"), A("NESTED", "n", "lines", sub=sub))["n"]
    return out.withColumn("last_line", F.col("last_line").cast("long"))


@job("agg_nested_paths", """
WITH l AS (SELECT lang, n_chars, unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT lang, n_chars, length(line) AS n, unnest(string_split(line, ' ')) AS word FROM l)
SELECT lang, count(*) AS doc_count, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(max(n) AS INTEGER) AS longest, max(word) AS last_word FROM w GROUP BY 1""")
def _(t: Tables):
    """Words of lines of documents: an array inside an array, with fields of the line and of the document."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.length(x).alias("n"), F.transform(F.split(x, " "), lambda w: F.struct(w.alias("word"))).alias("words")))
    agg = A("NESTED", "words", "lines.words", sub=(A("TERM", "lang", "lang", size=0, sub=(
        A("SUM", "chars", "n_chars"), A("MAXIMUM", "longest", "lines.n"), A("MAXIMUM", "last_word", "lines.words.word"))),))
    return aggregate(t.documents.select("lang", "n_chars", lines.alias("lines")), agg)["words.lang"]


@job("agg_tree", """
WITH c AS (SELECT l_returnflag AS flag, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month, l_linenumber AS line, count(*) AS doc_count,
             round(avg(l_quantity), 4) AS mean, max(l_tax) AS tax FROM lineitem GROUP BY 1, 2, 3),
f AS (SELECT l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY 1 QUALIFY row_number() OVER (ORDER BY count(*) DESC, flag) <= 2)
SELECT flag, strftime(month, '%Y-%m') AS month, line, doc_count, mean, tax FROM c JOIN f USING (flag)
QUALIFY row_number() OVER (PARTITION BY flag, month ORDER BY doc_count DESC, line) <= 2""")
def _(t: Tables):
    """Three levels out of one pass: the two largest return flags, their months, the two largest line numbers of each."""
    agg = A("TERM", "flag", "l_returnflag", size=2, sub=(A("DATE_HISTOGRAM", "month", {"field": "l_shipdate", "interval": "month"}, sub=(
        A("SUM", "price", "l_extendedprice"), A("TERM", "line", "l_linenumber", size=2, sub=(A("AVERAGE", "mean", "l_quantity"), A("MAXIMUM", "tax", "l_tax"))))),))
    out = aggregate(t.lineitem, agg)["flag.month.line"]
    return out.withColumns({"month": F.date_format("month", "yyyy-MM"), "mean": F.round("mean", 4)})


@job("agg_filter", """SELECT count(*) AS doc_count, round(avg(l_quantity), 4) AS q, count(DISTINCT l_suppkey) AS suppliers
     FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.05""")
def _(t: Tables):
    sub = (A("AVERAGE", "q", "l_quantity"), A("CARDINALITY", "suppliers", {"field": "l_suppkey", "exact": True}))
    scope = A("FILTER", "f", sub=sub, query=Search(must=[term("l_returnflag", "R"), between("l_discount", 0.05)]))
    return rounded(aggregate(t.lineitem, scope)["f"], "q", digits=4)


def metric(name, kind, field, sql):
    @job(name, sql)
    def _(t: Tables):
        return metrics(fx.sparse(t), [A(kind, "value", field)])


metric("agg_minimum", "MINIMUM", "c_acctbal", f"WITH {fx.SPARSE_SQL} SELECT min(c_acctbal) AS value FROM sparse")
metric("agg_maximum", "MAXIMUM", "c_mktsegment", f"WITH {fx.SPARSE_SQL} SELECT max(c_mktsegment) AS value FROM sparse")
metric("agg_count", "COUNT", "c_acctbal", f"WITH {fx.SPARSE_SQL} SELECT count(c_acctbal) AS value FROM sparse")


@job("agg_average", f"WITH {fx.SPARSE_SQL} SELECT round(avg(c_acctbal), 4) AS value FROM sparse")
def _(t: Tables):
    return rounded(metrics(fx.sparse(t), [A("AVERAGE", "value", "c_acctbal")]), "value", digits=4)


@job("agg_sum", "SELECT round(sum(l_extendedprice), 2) AS value FROM lineitem")
def _(t: Tables):
    return rounded(metrics(t.lineitem, [A("SUM", "value", "l_extendedprice")]), "value")


@job("agg_stats", """SELECT count(value) AS s_count, min(value) AS s_min, max(value) AS s_max, round(avg(value), 4) AS s_avg,
     round(sum(value), 2) AS s_sum FROM events""")
def _(t: Tables):
    out = metrics(t.events, [A("STATS", "s", "value")])
    return rounded(rounded(out, "s_sum"), "s_avg", digits=4)


@job("agg_extended_stats", """SELECT count(value) AS s_count, min(value) AS s_min, max(value) AS s_max,
     round(avg(value), 4) AS s_avg, round(sum(value), 2) AS s_sum, round(sum(value * value), 2) AS s_sum_of_squares,
     round(var_pop(value), 4) AS s_variance, round(stddev_pop(value), 4) AS s_std_deviation,
     round(avg(value) + 2 * stddev_pop(value), 4) AS s_upper, round(avg(value) - 2 * stddev_pop(value), 4) AS s_lower
     FROM events""")
def _(t: Tables):
    out = rounded(metrics(t.events, [A("EXTENDED_STATS", "s", "value")]), "s_sum", "s_sum_of_squares")
    return rounded(out, "s_avg", "s_variance", "s_std_deviation", "s_upper", "s_lower", digits=4)


@job("agg_date_histogram", """
WITH c AS (SELECT date_trunc('hour', ts) AS b, count(*) AS n FROM events GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(b) FROM c), (SELECT max(b) FROM c), INTERVAL 1 HOUR)) AS b)
SELECT strftime(g.b, '%Y-%m-%d %H:%M:%S') AS by_hour, coalesce(n, 0) AS doc_count FROM g LEFT JOIN c ON g.b = c.b""")
def _(t: Tables):
    out = aggregate(t.events, A("DATE_HISTOGRAM", "by_hour", {"field": "ts", "interval": "hour"}))["by_hour"]
    return day(out, "by_hour")


@job("agg_histogram", """
WITH c AS (SELECT CAST(floor(o_totalprice / 2500) AS BIGINT) AS b, count(*) AS n, sum(o_totalprice) AS s
           FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
g AS (SELECT unnest(generate_series((SELECT min(b) FROM c), (SELECT max(b) FROM c))) AS b)
SELECT CAST(g.b * 2500 AS DOUBLE) AS price, coalesce(n, 0) AS doc_count, round(s, 2) AS total FROM g LEFT JOIN c ON g.b = c.b""")
def _(t: Tables):
    agg = A("HISTOGRAM", "price", {"field": "o_totalprice", "interval": 2500}, sub=(A("SUM", "total", "o_totalprice"),))
    search = Search(must=[term("o_orderstatus", "P")], aggregations=[agg])
    return rounded(run(t.orders, search)["price"], "total")


@job("agg_range", """
WITH r(lo, hi) AS (VALUES (NULL::DOUBLE, 50.0::DOUBLE), (20.0, 120.0), (100.0, NULL), (1000.0, 2000.0))
SELECT lo AS value_from, hi AS value_to, count(event_id) AS doc_count, round(avg(value), 4) AS mean
FROM r LEFT JOIN events ON (lo IS NULL OR value >= lo) AND (hi IS NULL OR value < hi) GROUP BY lo, hi""")
def _(t: Tables):
    agg = A("RANGE", "value", {"field": "value", "ranges": [[None, 50.0], [20.0, 120.0], [100.0, None], [1000.0, 2000.0]]},
            sub=(A("AVERAGE", "mean", "value"),))
    return rounded(aggregate(t.events, agg)["value"], "mean", digits=4)


@job("agg_cardinality", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def _(t: Tables):
    return metrics(t.lineitem, [A("CARDINALITY", "parts", {"field": "l_partkey", "exact": True}),
                                A("CARDINALITY", "suppliers", {"field": "l_suppkey", "exact": True})])


@job("agg_cardinality_approximate", "SELECT l_returnflag, true AS close FROM lineitem GROUP BY 1")
def _(t: Tables):
    """The approximate count, the default, is within a tenth of the exact one in every bucket."""
    agg = A("TERM", "l_returnflag", "l_returnflag", sub=(
        A("CARDINALITY", "about", "l_partkey"), A("CARDINALITY", "exact", {"field": "l_partkey", "exact": True})))
    counted = aggregate(t.lineitem, agg)["l_returnflag"]
    close = F.abs(F.col("about") - F.col("exact")) <= 0.1 * F.col("exact")
    return counted.select("l_returnflag", close.alias("close"))


SUB = A("TERM", "status", "o_orderstatus", sub=(
    A("AVERAGE", "mean_price", "o_totalprice"),
    A("TERM", "priority", "o_orderpriority", size=2, sub=(A("MAXIMUM", "dearest", "o_totalprice"),)),
))


@job("agg_sub", """
WITH c AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS doc_count, max(o_totalprice) AS dearest
           FROM orders GROUP BY 1, 2)
SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY status ORDER BY doc_count DESC, priority) <= 2""")
def _(t: Tables):
    return aggregate(t.orders, SUB)["status.priority"]


@job("agg_sub_folded", """
WITH c AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS doc_count, max(o_totalprice) AS dearest
           FROM orders GROUP BY 1, 2),
k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY status ORDER BY doc_count DESC, priority) <= 2),
p AS (SELECT o_orderstatus AS status, count(*) AS doc_count, round(avg(o_totalprice), 2) AS mean_price FROM orders GROUP BY 1)
SELECT p.status, p.doc_count, p.mean_price, string_agg(priority || ':' || k.doc_count, ';' ORDER BY k.doc_count DESC, priority) AS priorities
FROM p JOIN k USING (status) GROUP BY ALL""")
def _(t: Tables):
    levels = aggregate(t.orders, SUB)
    folded = nested_buckets(levels["status"], levels["status.priority"], ["status"], "priorities", bucket_order(SUB.sub[1]))
    shown = F.array_join(F.transform("priorities", lambda p: F.concat_ws(":", p["priority"], p["doc_count"])), ";")
    return rounded(folded.withColumn("priorities", shown), "mean_price")


@job("agg_topn", "SELECT l_partkey AS part, count(*) AS doc_count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def _(t: Tables):
    return aggregate(t.lineitem, A("TERM", "part", "l_partkey", size=25))["part"]


@job("agg_min_doc_count", "SELECT user_id AS u, count(*) AS doc_count FROM events GROUP BY 1 HAVING count(*) >= 65")
def _(t: Tables):
    return aggregate(t.events, A("TERM", "u", "user_id", size=0, min_doc_count=65))["u"]


@job("agg_sort", """SELECT o_custkey AS cust, count(*) AS doc_count, round(sum(o_totalprice), 2) AS total FROM orders
     GROUP BY 1 ORDER BY sum(o_totalprice) DESC, cust LIMIT 15""")
def _(t: Tables):
    agg = A("TERM", "cust", "o_custkey", size=15, sort_by="total", sort_order="DESC", sub=(A("SUM", "total", "o_totalprice"),))
    return rounded(aggregate(t.orders, agg)["cust"], "total")


@job("agg_shard_size", """SELECT l_linenumber AS line, count(*) AS doc_count FROM lineitem
     GROUP BY 1 ORDER BY doc_count DESC, line LIMIT 5""")
def _(t: Tables):
    """shardSize is a hint that exact results do not need: 1 gives the same buckets."""
    return aggregate(t.lineitem, A("TERM", "line", "l_linenumber", size=5, shard_size=1))["line"]
