"""Every filter of the record language, on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldspan.jobs import fixtures as fx
from goldspan.jobs.base import Tables, job
from goldspan.plans.aggregations import run
from goldspan.plans.filters import Predicate as P
from goldspan.plans.filters import Search, apply_filter, between, has_type, term, terms

WORDS = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
PADDED = "(' ' || array_to_string(" + WORDS + ", ' ') || ' ')"


def haversine_sql(lat, lon, lat0, lon0):
    return (f"2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({lat} - {lat0}) / 2), 2) + cos(radians({lat0}))"
            f" * cos(radians({lat})) * pow(sin(radians({lon} - {lon0}) / 2), 2))))")


def simple(name, table, columns, search, where, build=None, with_sql=""):
    """A filter over one table: ``search`` on Spark, ``where`` in SQL."""
    source = with_sql.split(" AS ")[0].strip() if with_sql else table
    sql = f"{'WITH ' + with_sql if with_sql else ''} SELECT {', '.join(columns)} FROM {source} WHERE {where}"

    @job(name, sql)
    def _(t: Tables):
        rows = build(t) if build else getattr(t, table)
        return apply_filter(rows, search).select(*columns)


O = ["o_orderkey", "o_orderstatus", "o_totalprice"]
D = ["doc_id", "lang", "n_chars"]
PART = ["p_partkey", "p_name", "p_brand"]
C = ["c_custkey", "c_mktsegment", "c_acctbal"]


@job("flt_type", fr"""WITH {fx.HITS_SQL} SELECT "mdmId" FROM hits WHERE "mdmEntityType" = 'customerGolden'""")
def _(t: Tables):
    return apply_filter(fx.hits(t), has_type("customerGolden")).select("mdmId")


@job("flt_bool", fr"""WITH {fx.STAGED_SQL} SELECT "mdmId", "mdmCounterForEntity" FROM staged WHERE "mdmDeleted" """)
def _(t: Tables):
    return apply_filter(fx.staged(t), P("BOOL_FILTER", "mdmDeleted", True)).select("mdmId", "mdmCounterForEntity")


simple("flt_term", "orders", O, term("o_orderstatus.raw", "O"), "o_orderstatus = 'O'")
simple("flt_terms", "orders", O, terms("o_orderpriority.raw", ["1-URGENT", "5-LOW"]),
       "o_orderpriority IN ('1-URGENT', '5-LOW')")
simple("flt_range", "orders", O, between("o_totalprice", 100000.0, 250000.0), "o_totalprice BETWEEN 100000 AND 250000")
simple("flt_match", "documents", D, P("MATCH_FILTER", "text", "Entièr zwischen the"),
       f"list_has_any({WORDS.format('text')}, ['entièr', 'zwischen', 'the'])")
simple("flt_match_all_terms", "documents", D, P("MATCH_ALL_TERMS_FILTER", "text", "The AND of, is"),
       f"list_has_all({WORDS.format('text')}, ['the', 'and', 'of', 'is'])")
simple("flt_match_any_term", "documents", D, P("MATCH_ANY_TERM_FILTER", "text", "und que"),
       f"list_has_any({WORDS.format('text')}, ['und', 'que'])")
simple("flt_match_all", "orders", O, P("MATCH_ALL_FILTER"), "true")
simple("flt_term_fuzzy", "part", PART, P("TERM_FUZZY_FILTER", "p_name", "smal rng"), "levenshtein(p_name, 'smal rng') <= 2")
simple("flt_terms_fuzzy", "part", PART,
       P("TERMS_FUZZY_FILTER", "p_name", ["rad bolt", "blu gear"], flags={"max_edits": 1}),
       "levenshtein(p_name, 'rad bolt') <= 1 OR levenshtein(p_name, 'blu gear') <= 1")
simple("flt_wildcard", "part", PART, P("WILDCARD_FILTER", "p_name", "?lue*g?ar"), "p_name LIKE '_lue%g_ar'")
simple("flt_wildcard_custom", "part", PART, P("WILDCARD_CUSTOM_FILTER", "p_name", "*GIZ?O", flags=["i"]),
       "p_name ILIKE '%giz_o'")
simple("flt_exists", "sparse", C, P("EXISTS_FILTER", "c_mktsegment"), "c_mktsegment IS NOT NULL", fx.sparse, fx.SPARSE_SQL)
simple("flt_missing", "sparse", C, P("MISSING_FILTER", "c_acctbal"), "c_acctbal IS NULL", fx.sparse, fx.SPARSE_SQL)
simple("flt_simple_query_string", "documents", D,
       P("SIMPLE_QUERY_STRING", "text", '+the +"of the" +tio* -ouon'),
       f"{PADDED.format('text')} LIKE '% the %' AND {PADDED.format('text')} LIKE '% of the %'"
       f" AND {PADDED.format('text')} LIKE '% tio%' AND NOT {PADDED.format('text')} LIKE '% ouon %'")


@job("flt_geodistance", f"""WITH {fx.GEO_SQL} SELECT c_custkey FROM placed
     WHERE {haversine_sql('lat', 'lon', -23.5, -46.6)} BETWEEN 500 AND 4000""")
def _(t: Tables):
    near = P("GEODISTANCE_FILTER", "point", {"lat": -23.5, "lon": -46.6}, range_values=[500.0, 4000.0])
    return apply_filter(fx.placed(t), near).select("c_custkey")


# --- nested: some line of the document ---------------------------------------------

def nested(name, predicate, where):
    sql = (f"WITH {fx.LINES_SQL} SELECT doc_id, source FROM documents d"
           f" WHERE EXISTS (SELECT 1 FROM line WHERE line.doc_id = d.doc_id AND ({where}))")

    @job(name, sql)
    def _(t: Tables):
        field = (predicate.key or "no").removeprefix("lines.")
        return apply_filter(fx.lined(t, field), predicate).select("doc_id", "source")


nested("flt_nested", P("NESTED", "head", "the", path="lines"), "head = 'the'")
nested("flt_nested_term", P("NESTED_TERM_FILTER", "lines.no", 12, path="lines"), "no = 12")
nested("flt_nested_terms", P("NESTED_TERMS_FILTER", "head", ["les", "und", "of"], path="lines"),
       "head IN ('les', 'und', 'of')")
nested("flt_nested_range", P("NESTED_RANGE_FILTER", "n_chars", [40, 60], path="lines"), "line.n_chars BETWEEN 40 AND 60")
nested("flt_nested_match_all_terms", P("NESTED_MATCH_ALL_TERMS_FILTER", "body", "the of and", path="lines"),
       f"list_has_all({WORDS.format('body')}, ['the', 'of', 'and'])")
nested("flt_nested_match_any_term", P("NESTED_MATCH_ANY_TERM_FILTER", "body", "des der", path="lines"),
       f"list_has_any({WORDS.format('body')}, ['des', 'der'])")
nested("flt_nested_match", P("NESTED_MATCH_FILTER", "body", "que zwischen", path="lines"),
       f"list_has_any({WORDS.format('body')}, ['que', 'zwischen'])")
nested("flt_nested_match_all", P("NESTED_MATCH_ALL_FILTER", path="lines"), "true")
nested("flt_nested_term_fuzzy", P("NESTED_TERM_FUZZY_FILTER", "head", "then", path="lines"), "levenshtein(head, 'then') <= 2")
nested("flt_nested_terms_fuzzy",
       P("NESTED_TERMS_FUZZY_FILTER", "head", ["dess", "ofe"], path="lines", flags={"max_edits": 1}),
       "levenshtein(head, 'dess') <= 1 OR levenshtein(head, 'ofe') <= 1")
nested("flt_nested_wildcard", P("NESTED_WILDCARD_FILTER", "head", "th?re*", path="lines"), "head LIKE 'th_re%'")
nested("flt_nested_wildcard_custom", P("NESTED_WILDCARD_CUSTOM_FILTER", "body", "LES*", path="lines", flags="i"),
       "body ILIKE 'les%'")
nested("flt_nested_exists", P("NESTED_EXISTS_FILTER", "mark", path="lines"), "mark IS NOT NULL")
nested("flt_nested_simple_query_string", P("NESTED_SIMPLE_QUERY_STRING", "body", '+the -is', path="lines"),
       f"{PADDED.format('body')} LIKE '% the %' AND NOT {PADDED.format('body')} LIKE '% is %'")
nested("flt_nested_geodistance",
       P("NESTED_GEODISTANCE_FILTER", "spot", {"lat": 10.0, "lon": -150.0}, "lines", [0.0, 500.0]),
       f"{haversine_sql('lat', 'lon', 10.0, -150.0)} BETWEEN 0 AND 500")


@job("flt_nested_missing", f"""WITH {fx.LINES_SQL} SELECT doc_id, source FROM documents d WHERE NOT EXISTS
     (SELECT 1 FROM line WHERE line.doc_id = d.doc_id AND mark IS NOT NULL)""")
def _(t: Tables):
    return apply_filter(fx.lined(t, "mark"), P("NESTED_MISSING_FILTER", "mark", path="lines")).select("doc_id", "source")


# --- composition ----------------------------------------------------------------------

simple("bool_must", "orders", O,
       Search(must=[term("o_orderstatus", "F"), between("o_totalprice", 300000.0)]),
       "o_orderstatus = 'F' AND o_totalprice >= 300000")
simple("bool_must_not", "sparse", C,
       Search(must_not=[term("c_mktsegment", "MACHINERY"), between("c_acctbal", None, 5000.0)]),
       "NOT coalesce(c_mktsegment = 'MACHINERY', false) AND NOT coalesce(c_acctbal <= 5000, false)", fx.sparse, fx.SPARSE_SQL)
simple("bool_should", "sparse", C,
       Search(should=[term("c_mktsegment", "MACHINERY"), between("c_acctbal", 2000.0), terms("c_nationkey", [1, 2, 3])],
              minimum_should_match=2),
       "CAST(coalesce(c_mktsegment = 'MACHINERY', false) AS INT) + CAST(coalesce(c_acctbal >= 2000, false) AS INT)"
       " + CAST(coalesce(c_nationkey IN (1, 2, 3), false) AS INT) >= 2", fx.sparse, fx.SPARSE_SQL)


@job("bool_key_prefix", fr"""WITH {fx.HITS_SQL} SELECT "mdmId" FROM hits
     WHERE has_values AND c_mktsegment = 'FURNITURE' AND c_acctbal BETWEEN 1000 AND 6000""")
def _(t: Tables):
    search = Search(must=[term("c_mktsegment.raw", "FURNITURE"), between("c_acctbal", 1000.0, 6000.0)],
                    key_prefix="mdmGoldenFieldAndValues")
    return apply_filter(fx.hits(t), search).select("mdmId")


@job("bool_values_query", """SELECT o_orderkey, o_custkey FROM orders
     WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE' AND c_acctbal >= 2000)
       AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (3, 4))""")
def _(t: Tables):
    rich = Search(must=[has_type("customer"), term("c_mktsegment", "FURNITURE"), between("c_acctbal", 2000.0)])
    far = Search(must=[has_type("customer"), terms("c_nationkey", [3, 4])])
    search = Search(
        must=[P("TERMS_FILTER", "o_custkey", values_field="c_custkey", values_query=rich)],
        must_not=[P("TERMS_FILTER", "o_custkey", values_field="c_custkey", values_query=far)])
    return apply_filter(t.orders, search, {"customer": t.customer}).select("o_orderkey", "o_custkey")


FIRSTS_SQL = f"{fx.LINES_SQL}, firsts AS (SELECT lang, head FROM line JOIN documents USING (doc_id) WHERE no = 1)"


@job("bool_nested_values", f"""WITH {FIRSTS_SQL} SELECT doc_id, source FROM documents d
     WHERE EXISTS (SELECT 1 FROM line WHERE line.doc_id = d.doc_id AND head IN (SELECT head FROM firsts WHERE lang = 'de'))
       AND NOT EXISTS (SELECT 1 FROM line WHERE line.doc_id = d.doc_id AND head IN (SELECT head FROM firsts WHERE lang = 'es'))""")
def _(t: Tables):
    """Documents with some line that starts like a German document does, and none that starts like a Spanish one."""
    firsts = fx.lined(t, "head").join(t.documents.select("doc_id", "lang"), "doc_id").select("lang", F.col("lines")[0]["head"].alias("head"))

    def starts_like(lang: str) -> P:
        return P("NESTED_TERMS_FILTER", "head", path="lines", values_field="head", values_query=Search(must=[has_type("firsts"), term("lang", lang)]))

    search = Search(must=[starts_like("de")], must_not=[starts_like("es")])
    return apply_filter(fx.lined(t, "head"), search, {"firsts": firsts}).select("doc_id", "source")


@job("flagship", """
SELECT c_mktsegment AS by_segment, count(*) AS doc_count, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus IN ('O', 'F') AND o_totalprice BETWEEN 50000 AND 250000
  AND NOT coalesce(o_orderpriority = '5-LOW', false)
GROUP BY c_mktsegment ORDER BY doc_count DESC, c_mktsegment LIMIT 10""")
def _(t: Tables):
    """A stored search, in its JSON form, over orders with their customers."""
    wire = {
        "mustList": [
            {"mdmFilterType": "TERMS_FILTER", "mdmKey": "o_orderstatus.raw", "mdmValue": ["O", "F"]},
            {"mdmFilterType": "RANGE_FILTER", "mdmKey": "o_totalprice", "mdmValue": [50000.0, 250000.0]},
        ],
        "mustNotList": [{"mdmFilterType": "TERM_FILTER", "mdmKey": "o_orderpriority.raw", "mdmValue": "5-LOW"}],
        "shouldList": [],
        "aggregationList": [
            {"type": "TERM", "name": "by_segment", "params": "c_mktsegment", "size": 10, "shardSize": 10,
             "minDocCount": 0, "subAggregations": [{"type": "SUM", "name": "total", "params": "o_totalprice"}]},
        ],
        "minimumShouldMatch": 1,
    }
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return run(joined, wire)["by_segment"].withColumn("total", F.round("total", 2))
