import itertools
import re

import pytest
from pyspark.sql import functions as F

from goldspan.functions import text
from goldspan.plans.filters import Predicate as P
from goldspan.plans.filters import Search, apply_filter, between, has_type, term, terms

from conftest import rows


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "Ana Lima", 10.0, True, "a_b%c"), (2, "ana", None, False, r"a\b"), (3, None, 30.0, None, "axbyc"),
         (4, "João-Ana lima", 20.0, True, None), (5, "", 20.0, False, "AXBYC")],
        "id int, name string, age double, ok boolean, code string")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("predicate, expected", [
    (term("name.raw", "ana"), [2]),
    (terms("name", ["ana", ""]), [2, 5]),
    (P("BOOL_FILTER", "ok", False), [2, 5]),
    (between("age", 10.0, 20.0), [1, 4, 5]),
    (between("age", None, 10.0), [1]),
    (between("age", 20.0, None), [3, 4, 5]),
    (between("age", None, None), [1, 3, 4, 5]),
    (P("RANGE_FILTER", "age", range_start=15.0, range_end=25.0), [4, 5]),
    (P("RANGE_FILTER", "age", range_values=[30.0, 30.0]), [3]),
    (P("MATCH_FILTER", "name", "LIMA x"), [1, 4]),
    (P("MATCH_ANY_TERM_FILTER", "name", "joão"), [4]),
    (P("MATCH_ALL_TERMS_FILTER", "name", "lima, ANA"), [1, 4]),
    (P("MATCH_ALL_TERMS_FILTER", "name", "an lim"), []),
    (P("MATCH_ALL_TERMS_FILTER", "name", " - "), []),
    (P("MATCH_ANY_TERM_FILTER", "name", ""), []),
    (P("MATCH_ALL_FILTER"), [1, 2, 3, 4, 5]),
    (P("EXISTS_FILTER", "name"), [1, 2, 4, 5]),
    (P("MISSING_FILTER", "name"), [3]),
    (P("TERM_FUZZY_FILTER", "name", "anna"), [2]),
    (P("TERM_FUZZY_FILTER", "name", "anaxyz"), []),
    (P("TERM_FUZZY_FILTER", "name", "ab"), [2, 5]),
    (P("TERMS_FUZZY_FILTER", "name", ["xana", "an"], flags={"max_edits": 1}), [2]),
    (P("WILDCARD_FILTER", "code", "a_b%c"), [1]),
    (P("WILDCARD_FILTER", "code", "a?b?c"), [1, 3]),
    (P("WILDCARD_FILTER", "code", "a\\b"), [2]),
    (P("WILDCARD_FILTER", "code", "x*"), []),
    (P("WILDCARD_CUSTOM_FILTER", "code", "ax*", flags=["i"]), [3, 5]),
    (P("WILDCARD_CUSTOM_FILTER", "code", "ax*"), [3]),
    (P("SIMPLE_QUERY_STRING", "name", "ana -lima"), [2]),
    (P("SIMPLE_QUERY_STRING", "name", '"ana lima"'), [1, 4]),
    (P("SIMPLE_QUERY_STRING", "name", "lim*"), [1, 4]),
    (P("SIMPLE_QUERY_STRING", "name", "+joão lima"), [4]),
    (P("SIMPLE_QUERY_STRING", "name", "-ana"), [5]),
    (P("SIMPLE_QUERY_STRING", "name", "  "), []),
])
def test_predicates(people, predicate, expected):
    assert ids(apply_filter(people, predicate)) == expected
    assert ids(apply_filter(people, predicate.to_wire())) == expected
    # a null field never matches, so must_not keeps it
    rest = [i for i in range(1, 6) if i not in expected]
    assert ids(apply_filter(people, Search(must_not=[predicate]))) == rest


def test_any_term_is_not_all_terms(people):
    assert ids(apply_filter(people, P("MATCH_ANY_TERM_FILTER", "name", "joão lima"))) == [1, 4]


TEXTS = ["the cat", "The-cat's", "catthe the2", "thé", "a the", "the", "", "x_the_y", "THE\ncat", "ithe then", "naïve—the", "1the the"]


@pytest.mark.parametrize("query", ["the", "cat the", "thé", "the2 x", "1the", "y"])
def test_token_tests_agree_with_tokens(spark, query):
    """Against a plain split into tokens, on whole words beside every kind of break."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, t string")
    wanted = set(query.split())
    split = {i: {w for w in re.split(r"[\W_]+", t.lower()) if w} for i, t in enumerate(TEXTS)}
    assert ids(df.where(text.has_any_token(F.col("t"), query))) == [i for i, w in split.items() if w & wanted]
    assert ids(df.where(text.has_all_tokens(F.col("t"), query))) == [i for i, w in split.items() if wanted <= w]
    spark_tokens = {r["id"]: set(r["w"]) for r in df.select("id", text.tokens(F.col("t")).alias("w")).collect()}
    assert spark_tokens == split


def test_phrases_cross_breaks_but_not_tokens(spark):
    df = spark.createDataFrame([(1, "of, the end"), (2, "of other"), (3, "of the"), (4, "loaf the"), (5, "of x the")], "id int, t string")
    assert ids(df.where(text.query_string(F.col("t"), '"of the"'))) == [1, 3]
    assert ids(df.where(text.query_string(F.col("t"), "of-the"))) == [1, 3]


@pytest.mark.parametrize("minimum", [0, 1, 2, 3])
def test_should_against_brute_force(spark, minimum):
    values = [None, 1, 2]
    data = [(i, *c) for i, c in enumerate(itertools.product(values, repeat=3))]
    df = spark.createDataFrame(data, "id int, a int, b int, c int")
    search = Search(should=[term(k, 1) for k in "abc"], minimum_should_match=minimum)
    expected = [i for i, *c in data if sum(v == 1 for v in c) >= minimum]
    assert ids(apply_filter(df, search)) == expected


def test_empty_should_asks_for_nothing(people):
    assert ids(apply_filter(people, {"mustList": [], "mustNotList": [], "shouldList": [], "minimumShouldMatch": 1})) == [1, 2, 3, 4, 5]


def test_wire_round_trip():
    search = Search(
        must=[term("a.raw", 1), P("NESTED_TERM_FILTER", "k", False, path="p")], must_not=[between("b", None, 3)],
        should=[P("TERMS_FILTER", "c", values_field="d", values_query=has_type("xGolden"))], key_prefix="v")
    wire = search.to_wire()
    assert wire["mustList"][0] == {"mdmFilterType": "TERM_FILTER", "mdmKey": "v.a.raw", "mdmValue": 1}
    assert wire["mustList"][1]["mdmValue"] is False
    assert wire["shouldList"][0]["mdmValuesField"] == "v.d"
    assert Search.from_wire(wire).to_wire() == wire


def test_bad_requests():
    with pytest.raises(ValueError, match="unknown filter attributes"):
        Search.from_wire({"mustList": [{"mdmFilterType": "TERM_FILTER", "key": "a"}]})
    with pytest.raises(ValueError, match="values_field"):
        P("TERMS_FILTER", "c", values_query=has_type("x"))
    with pytest.raises(ValueError, match="list"):
        P("RANGE_FILTER", "c", range_values=(1, 2))


def test_unknown_filter(people):
    with pytest.raises(ValueError, match="unknown filter type"):
        apply_filter(people, P("SOUNDS_LIKE", "name", "x"))
    with pytest.raises(ValueError, match="cannot evaluate"):
        apply_filter(people, P("NESTED_SOUNDS_LIKE", "name", "x", path="p"))


@pytest.fixture(scope="module")
def nested(spark):
    return spark.createDataFrame(
        [(1, [("x", 1, (10.0, 20.0)), (None, 2, None)]), (2, [(None, 5, (0.0, 0.0))]), (3, []), (4, None), (5, [("xy z", None, None)])],
        "id int, items array<struct<k:string,n:int,at:struct<lat:double,lon:double>>>")


@pytest.mark.parametrize("predicate, expected", [
    (P("NESTED", "k", "x", path="items"), [1]),
    (P("NESTED_TERM_FILTER", "items.k", "x", path="items"), [1]),
    (P("NESTED_TERMS_FILTER", "n", [2, 5], path="items"), [1, 2]),
    (P("NESTED_RANGE_FILTER", "n", [2, None], path="items"), [1, 2]),
    (P("NESTED_EXISTS_FILTER", "k", path="items"), [1, 5]),
    (P("NESTED_MISSING_FILTER", "k", path="items"), [2, 3, 4]),
    (P("NESTED_MATCH_ALL_FILTER", path="items"), [1, 2, 5]),
    (P("NESTED_MATCH_ALL_TERMS_FILTER", "k", "Z xy", path="items"), [5]),
    (P("NESTED_WILDCARD_FILTER", "k", "x*", path="items"), [1, 5]),
    (P("NESTED_TERM_FUZZY_FILTER", "k", "xyz", path="items"), [1, 5]),
    (P("NESTED_SIMPLE_QUERY_STRING", "k", "+z +xy", path="items"), [5]),
    (P("NESTED_GEODISTANCE_FILTER", "at", path="items", range_values=[0.5, 0.5, 0.0, 100.0]), [2]),
])
def test_nested(nested, predicate, expected):
    assert ids(apply_filter(nested, predicate)) == expected
    assert ids(apply_filter(nested, Search(must_not=[predicate]))) == [i for i in range(1, 6) if i not in expected]


def test_element_conditions_hold_for_one_element(spark):
    df = spark.createDataFrame([(1, [("a", 1), ("b", 9)])], "id int, items array<struct<k:string,n:int>>")
    search = Search(must=[P("NESTED_TERM_FILTER", "k", "a", path="items"), P("NESTED_RANGE_FILTER", "n", [5, None], path="items")])
    assert ids(apply_filter(df, search)) == [1]  # each predicate asks for some element of its own


def test_values_query_under_each_list(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 10)], "id int, k int")
    right = spark.createDataFrame([(10, "a"), (10, "a"), (None, "a"), (20, "b")], "v int, g string")
    wanted = P("TERMS_FILTER", "k", values_field="v", values_query=Search(must=[has_type("r"), term("g", "a")]))
    tables = {"r": right}
    assert ids(apply_filter(left, Search(must=[wanted]), tables)) == [1, 4]
    assert ids(apply_filter(left, Search(must_not=[wanted]), tables)) == [2, 3]
    either = Search(should=[wanted, term("id", 2)])
    out = apply_filter(left, either, tables)
    assert ids(out) == [1, 2, 4] and out.columns == left.columns
    both = Search(should=[wanted, term("id", 4)], minimum_should_match=2)
    assert ids(apply_filter(left, both, tables)) == [4]


def test_values_query_on_the_same_table(spark):
    df = spark.createDataFrame([(1, 2, "x"), (2, 3, "y"), (3, 9, "x")], "id int, parent int, g string")
    children = P("TERMS_FILTER", "id", values_field="parent", values_query=term("g", "x"))
    assert ids(apply_filter(df, children)) == [2]


def test_date_range_with_format(spark):
    df = spark.createDataFrame([(1, "2019-11-24"), (2, "2019-11-25"), (3, "2019-11-27")], "id int, d string").withColumn("d", F.to_timestamp("d"))
    assert ids(apply_filter(df, P("RANGE_FILTER", "d", ["25/11/2019", "26/11/2019"], format="dd/MM/yyyy"))) == [2]
    assert ids(apply_filter(df, between("d", None, "2019-11-25"))) == [1, 2]


def test_geodistance_of_known_cities(spark):
    # Sao Paulo to Rio de Janeiro is about 360 km
    df = spark.createDataFrame([(1, (-22.9068, -43.1729)), (2, (-23.5505, -46.6333)), (3, None)], "id int, at struct<lat:double,lon:double>")
    centre = {"lat": -23.5505, "lon": -46.6333}
    assert ids(apply_filter(df, P("GEODISTANCE_FILTER", "at", centre, range_values=[355.0, 365.0]))) == [1]
    assert ids(apply_filter(df, P("GEODISTANCE_FILTER", "at", centre, range_values=[None, 1.0]))) == [2]


def test_comparisons_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    found = apply_filter(orders, Search(must=[term("o_orderstatus.raw", "F"), between("o_totalprice", 1000.0, 9000.0)],
                                        should=[term("o_orderpriority", "5-LOW"), term("o_orderpriority", "2-HIGH")]))
    plan = found.select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThanOrEqual(o_totalprice,1000.0)" in plan
    assert "In(o_orderpriority" in plan or "Or(EqualTo(o_orderpriority" in plan
    assert "o_custkey" not in plan


def test_flat_tables_answer_enveloped_names(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert ids(apply_filter(df, term("mdmGoldenFieldAndValues.name.raw", "b"))) == [2]


def test_must_and_must_not_share_out_all_records(people):
    for p in (between("age", 15.0), term("name", "ana"), P("WILDCARD_FILTER", "code", "a*")):
        n = apply_filter(people, p).count() + apply_filter(people, Search(must_not=[p])).count()
        assert n == people.count()


def test_row_helper(people):
    assert len(rows(people)) == 5


# fixed values: every filter type a stored search may hold
KINDS = """TERM_FILTER BOOL_FILTER TERMS_FILTER MATCH_ALL_FILTER MATCH_FILTER MATCH_ALL_TERMS_FILTER
MATCH_ANY_TERM_FILTER TERM_FUZZY_FILTER TERMS_FUZZY_FILTER TYPE_FILTER RANGE_FILTER WILDCARD_FILTER
WILDCARD_CUSTOM_FILTER EXISTS_FILTER SIMPLE_QUERY_STRING MISSING_FILTER GEODISTANCE_FILTER NESTED
NESTED_MATCH_ALL_TERMS_FILTER NESTED_MATCH_ANY_TERM_FILTER NESTED_TERM_FILTER NESTED_TERMS_FILTER
NESTED_MATCH_ALL_FILTER NESTED_MATCH_FILTER NESTED_TERM_FUZZY_FILTER NESTED_TERMS_FUZZY_FILTER
NESTED_RANGE_FILTER NESTED_WILDCARD_FILTER NESTED_WILDCARD_CUSTOM_FILTER NESTED_SIMPLE_QUERY_STRING
NESTED_GEODISTANCE_FILTER NESTED_EXISTS_FILTER NESTED_MISSING_FILTER""".split()


@pytest.mark.parametrize("kind", KINDS)
def test_every_kind_runs_from_json(spark, kind):
    element = "k:string,b:boolean,at:struct<lat:double,lon:double>"
    df = spark.createDataFrame(
        [(1, "t", ("x", True, (0.0, 0.0)), [("x", True, (0.0, 0.0))]), (2, "u", None, [])],
        f"id int, mdmEntityType string, one struct<{element}>, many array<struct<{element}>>")
    wire = {"mdmFilterType": kind}
    field = "b" if kind == "BOOL_FILTER" else "at" if "GEO" in kind else "k"
    if kind == "TYPE_FILTER":
        wire["mdmValue"] = "t"
    elif kind.startswith("NESTED"):
        wire |= {"mdmPath": "many", "mdmKey": field}
    elif kind != "MATCH_ALL_FILTER":
        wire["mdmKey"] = f"one.{field}"
    if "GEO" in kind:
        wire["mdmRangeValues"] = [0.0, 0.0, 0.0, 1.0]
    elif kind != "TYPE_FILTER" and not any(w in kind for w in ("EXISTS", "MISSING")):
        several = any(w in kind for w in ("TERMS_FILTER", "TERMS_FUZZY")) and "MATCH" not in kind
        wire["mdmValue"] = True if field == "b" else ["x", "y"] if several else ["a", "z"] if "RANGE" in kind else "x"
    expected = {"MATCH_ALL_FILTER": [1, 2], "MISSING_FILTER": [2], "NESTED_MISSING_FILTER": [2]}.get(kind, [1])
    assert ids(apply_filter(df, wire)) == expected


# --- nested values queries, arrays below arrays, bands ------------------------------------

@pytest.fixture(scope="module")
def baskets(spark):
    return spark.createDataFrame([
        (1, [("a", [("x", 1), ("y", 2)]), ("b", [])]), (2, [("b", [("z", 3)])]), (3, []), (4, None), (5, [(None, None), ("c", [(None, 9)])]),
        (6, [("a", [("x", 1)])]), (7, [("b", [("z", 3)])])], "id int, l array<struct<k: string, m: array<struct<w: string, n: int>>>>")


def wanted(kind, key, path, *values):
    return P(kind, key, path=path, values_field="v", values_query=Search(must=[has_type("lists"), terms("v", values)]))


@pytest.mark.parametrize("part, values, ids", [
    ("must", ["a"], [1, 6]), ("must", ["b", "c", "none"], [1, 2, 5, 7]), ("must", ["none"], []),
    ("must_not", ["a"], [2, 3, 4, 5, 7]), ("must_not", ["none"], [1, 2, 3, 4, 5, 6, 7]), ("should", ["c"], [5]), ("should", ["a", "c"], [1, 5, 6])])
def test_nested_values_queries(spark, baskets, part, values, ids):
    lists = {"lists": spark.createDataFrame([(v,) for v in ["a", "b", "c", "c", None, "q"]], "v string")}
    out = apply_filter(baskets, Search(**{part: [wanted("NESTED_TERMS_FILTER", "k", "l", *values)]}), lists)
    assert out.columns == baskets.columns and sorted(r["id"] for r in out.collect()) == ids
    both = Search(should=[wanted("NESTED_TERM_FILTER", "l.k", "l", *values), term("id", 3)], minimum_should_match=1)
    if part == "should":
        assert sorted(r["id"] for r in apply_filter(baskets, both, lists).collect()) == sorted([*ids, 3])


def test_nested_paths_below_another_array(spark, baskets):
    lists = {"lists": spark.createDataFrame([("z",), ("x",)], "v string")}
    find = lambda p: sorted(r["id"] for r in apply_filter(baskets, Search(must=[p]), lists).collect())
    assert find(wanted("NESTED_TERMS_FILTER", "w", "l.m", "z", "q")) == [2, 7]
    assert find(P("NESTED_TERM_FILTER", "l.m.w", "x", path="l.m")) == [1, 6]
    assert find(P("NESTED_RANGE_FILTER", "n", path="l.m", range_values=[2, 3])) == [1, 2, 7]
    assert find(P("NESTED_MISSING_FILTER", "w", path="l.m")) == [3, 4, 5]
    assert find(P("NESTED_MATCH_ALL_FILTER", path="l.m")) == [1, 2, 5, 6, 7]
    with pytest.raises(ValueError):
        find(P("NESTED_TERMS_FILTER", "w", values_field="v", values_query=has_type("lists")))


def test_the_values_of_a_nested_query_may_lie_below_an_array_themselves(baskets):
    own = P("NESTED_TERMS_FILTER", "w", path="l.m", values_field="first", values_query=Search(must=[has_type("other")]))
    other = baskets.where("id = 6").selectExpr("l[0].m[0].w AS first")
    assert sorted(r["id"] for r in apply_filter(baskets, own, {"other": other}).collect()) == [1, 6]


def kilometres(a, b, c, d):
    import math
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((a - c) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((b - d) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("centre", [(0.0, 0.0), (0.0, 179.5), (10.0, -179.9), (89.5, 20.0), (-90.0, 0.0), (60.0, 180.0), (-33.0, 151.0), (45.0, -540.5), (80.0, 539.0)])
@pytest.mark.parametrize("high", [0.0, 30.0, 500.0, 4000.0, 25000.0])
def test_bands_lose_no_point(spark, points_on_a_globe, centre, high):
    frame, points = points_on_a_globe
    near = P("GEODISTANCE_FILTER", "at", {"lat": centre[0], "lon": centre[1]}, range_values=[0.0, high])
    got = sorted(r["i"] for r in apply_filter(frame, near).collect())
    # points at the very edge may fall on either side
    sure = [i for i, (a, b) in enumerate(points) if kilometres(a, b, *centre) <= high - 1e-6]
    maybe = {i for i, (a, b) in enumerate(points) if kilometres(a, b, *centre) <= high + 1e-6}
    assert set(sure) <= set(got) <= maybe


@pytest.fixture(scope="module")
def points_on_a_globe(spark):
    import random
    rng = random.Random(5)
    points = [(lat, lon) for lat in (-90.0, -89.9, -33.0, 0.0, 10.0, 45.0, 60.0, 89.4, 90.0) for lon in (-180.0, -179.99, -0.1, 0.0, 0.2, 20.0, 151.1, 179.4, 180.0, 181.0, -180.6, 359.9)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(400)] + [(rng.uniform(50, 90), rng.uniform(170, 190)) for _ in range(100)]
    points += [(95.0, 0.0), (-91.0, 170.0)]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "i int, at struct<lat: double, lon: double>")
    return frame.union(spark.createDataFrame([(-1, None), (-2, (None, 3.0)), (-3, (1.0, None))], frame.schema)), points


def test_the_band_reaches_the_scan(spark, points_on_a_globe, folder):
    points_on_a_globe[0].write.parquet(folder)
    near = P("GEODISTANCE_FILTER", "at", {"lat": 10.0, "lon": 20.0}, range_values=[0.0, 100.0])
    plan = apply_filter(spark.read.parquet(folder), near)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(at.lat" in pushed and "LessThanOrEqual(at.lon" in pushed
