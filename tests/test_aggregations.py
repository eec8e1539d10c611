import datetime

import pytest
from pyspark.sql import functions as F

from goldspan.plans.aggregations import Aggregation as A
from goldspan.plans import aggregations as plans
from goldspan.plans.aggregations import aggregate, bucket_order, metrics, nested_buckets, run
from goldspan.plans.filters import Predicate as P
from goldspan.plans.filters import Search, between, term

from conftest import rows


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [("a", "x", 1.0), ("a", "y", 2.0), ("a", "y", 4.0), ("b", "x", 8.0), ("b", None, None), ("c", "z", 2.0), (None, "x", 1.0)],
        "shop string, item string, price double")


def test_term_ranks_by_count_then_key_and_skips_nulls(sales):
    out = aggregate(sales, A("TERM", "s", "shop"))["s"]
    assert [tuple(r) for r in out.collect()] == [("a", 3), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in aggregate(sales, A("TERM", "s", "shop", size=1))["s"].collect()] == [("a", 3)]


def test_the_greatest_text_is_found_without_sorting_the_records(sales):
    """A hash aggregate on every level, also of merged ones; groups without a text have none."""
    text = (A("MAXIMUM", "last", "item"), A("MINIMUM", "first", "item"), A("STATS", "s", "price"))
    out = aggregate(sales, A("TERM", "shop", "shop", size=0, sub=text))["shop"]
    assert rows(out.select("shop", "first", "last", "s_max")) == [("a", "x", "y", 4.0), ("b", "x", "x", 8.0), ("c", "z", "z", 2.0)]
    deep = aggregate(sales, A("TERM", "shop", "shop", size=0, sub=(*text, A("TERM", "price", "price", size=0, sub=text))))
    assert rows(deep["shop"].select("shop", "first", "last")) == [("a", "x", "y"), ("b", "x", "x"), ("c", "z", "z")]
    assert rows(deep["shop.price"].where("shop = 'a'").select("price", "last")) == [(1.0, "x"), (2.0, "y"), (4.0, "y")]
    for frame in (out, deep["shop"], deep["shop.price"]):
        assert "SortAggregate" not in frame._jdf.queryExecution().sparkPlan().toString()
    empty = metrics(sales.where("item is null"), [A("MAXIMUM", "last", "item")])
    assert [tuple(r) for r in empty.collect()] == [(None,)]


def test_terms_needs_every_field(sales):
    out = aggregate(sales, A("TERMS", "k", ["shop", "item"]))["k"]
    assert rows(out) == [("a", "x", 1), ("a", "y", 2), ("b", "x", 1), ("c", "z", 1)]


@pytest.mark.parametrize("sort_by, order, expected", [
    ("_key", "DESC", ["c", "b", "a"]), ("key", None, ["a", "b", "c"]), ("_count", "ASC", ["c", "b", "a"]),
    ("top", "DESC", ["b", "a", "c"]), ("top", "ASC", ["c", "a", "b"]),
])
def test_sort(sales, sort_by, order, expected):
    agg = A("TERM", "s", "shop", sort_by=sort_by, sort_order=order, sub=(A("MAXIMUM", "top", "price"),))
    assert [r["s"] for r in aggregate(sales, agg)["s"].collect()] == expected


def test_min_doc_count(sales):
    assert rows(aggregate(sales, A("TERM", "s", "shop", min_doc_count=2))["s"]) == [("a", 3), ("b", 2)]


def test_metrics(sales):
    out = metrics(sales, [A("COUNT", "n", "price"), A("SUM", "s", "price"), A("EXTENDED_STATS", "e", "price"), A("CARDINALITY", "c", {"field": "shop", "exact": True})])
    r = out.first()
    assert (r["n"], r["s"], r["c"], r["e_count"], r["e_sum_of_squares"]) == (6, 18.0, 3, 6, 90.0)
    assert r["e_variance"] == pytest.approx(6.0) and r["e_std_deviation"] == pytest.approx(6.0 ** 0.5)
    assert r["e_upper"] == pytest.approx(3 + 2 * 6.0 ** 0.5)


def test_sub_buckets_are_limited_per_parent(sales):
    out = aggregate(sales, A("TERM", "s", "shop", size=2, sub=(A("TERM", "i", "item", size=1, sub=(A("SUM", "p", "price"),)),)))
    assert rows(out["s"]) == [("a", 3), ("b", 2)]
    assert rows(out["s.i"]) == [("a", "y", 2, 6.0), ("b", "x", 1, 8.0)]


def test_three_levels(spark):
    df = spark.createDataFrame([(i % 2, i % 3, i % 5) for i in range(60)], "a int, b int, c int")
    agg = A("TERM", "a", "a", sub=(A("TERM", "b", "b", size=2, sub=(A("TERM", "c", "c", size=1),)),))
    out = aggregate(df, agg)
    assert rows(out["a.b.c"]) == [(0, 0, 0, 2), (0, 1, 0, 2), (1, 0, 0, 2), (1, 1, 0, 2)]


def test_filter_scope_and_search(sales):
    scoped = A("FILTER", "f", query=term("item", "y"), sub=(A("SUM", "p", "price"), A("TERM", "s", "shop")))
    out = run(sales, Search(must=[between("price", 2.0)], aggregations=[scoped, A("MINIMUM", "low", "price")]))
    assert rows(out["f"]) == [(2, 6.0)]
    assert rows(out["f.s"]) == [("a", 2)]
    assert rows(out["metrics"]) == [(2.0,)]


def test_nested_scope(spark):
    df = spark.createDataFrame([(1, [("x", 1), ("y", 2)]), (2, [("x", 5)]), (3, []), (4, None)], "id int, items array<struct<k:string,n:int>>")
    agg = A("NESTED", "n", "items", sub=(A("SUM", "s", "items.n"), A("TERM", "k", "items.k")))
    out = aggregate(df, agg)
    assert rows(out["n"]) == [(3, 8)]
    assert rows(out["n.k"]) == [("x", 2), ("y", 1)]


def test_histogram_fills_gaps(spark):
    df = spark.createDataFrame([(-0.5,), (0.0,), (2.4,), (2.5,), (None,)], "v double")
    out = aggregate(df, A("HISTOGRAM", "h", {"field": "v", "interval": 1}))["h"]
    assert rows(out) == [(-1.0, 1), (0.0, 1), (1.0, 0), (2.0, 2)]
    out = aggregate(df, A("HISTOGRAM", "h", {"field": "v", "interval": 1}, min_doc_count=1))["h"]
    assert rows(out) == [(-1.0, 1), (0.0, 1), (2.0, 2)]


def test_histogram_grid_across_blocks(spark):
    df = spark.createDataFrame([(0.0,), (9999.0,)], "v double")
    out = aggregate(df, A("HISTOGRAM", "h", {"field": "v", "interval": 1}))["h"]
    assert out.count() == 10000 and out.select("h").distinct().count() == 10000
    assert out.agg(F.sum("doc_count")).first()[0] == 2


def test_histogram_with_a_broken_width(spark):
    df = spark.createDataFrame([(0.0,), (0.31,), (0.7,)], "v double")
    out = aggregate(df, A("HISTOGRAM", "h", {"field": "v", "interval": 0.1}))["h"]
    assert out.agg(F.sum("doc_count")).first()[0] == 3


@pytest.mark.parametrize("interval, count", [("month", 3), ("day", 61), ("week", 10), ("hour", 1441), ("year", 2), ("quarter", 2)])
def test_date_histogram_grid(spark, interval, count):
    df = spark.createDataFrame([(datetime.datetime(2023, 12, 1),), (datetime.datetime(2024, 1, 30),), (datetime.datetime(2024, 1, 30),)], "t timestamp")
    if interval == "month":
        df = df.union(spark.createDataFrame([(datetime.datetime(2024, 2, 29),)], "t timestamp"))
    out = aggregate(df, A("DATE_HISTOGRAM", "d", {"field": "t", "interval": interval}))["d"]
    assert out.count() == count
    assert out.agg(F.sum("doc_count")).first()[0] == df.count()


def test_ranges_overlap_and_are_half_open(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v double")
    out = aggregate(df, A("RANGE", "r", {"field": "v", "ranges": [[None, 2.0], [1.0, 3.0], [9.0, None], [1.0, 3.0]]}))["r"]
    assert rows(out.select("r_from", "r_to", "doc_count")) == [(1.0, 3.0, 2), (9.0, None, 0), (None, 2.0, 1)]


def test_range_with_sub_buckets(sales):
    agg = A("RANGE", "r", {"field": "price", "ranges": [[0.0, 3.0], [2.0, None]]}, sub=(A("TERM", "s", "shop"),))
    out = aggregate(sales, agg)
    assert rows(out["r.s"]) == [(0.0, 3.0, "a", 2), (0.0, 3.0, "c", 1), (2.0, None, "a", 2), (2.0, None, "b", 1), (2.0, None, "c", 1)]


def test_histogram_inside_open_ranges(sales):
    """Range ends that are null are bucket keys like any other, also where gaps are filled."""
    agg = A("RANGE", "r", {"field": "price", "ranges": [[None, 3.0], [2.0, None]]}, sub=(
        A("HISTOGRAM", "h", {"field": "price", "interval": 2}, sub=(A("TERM", "s", "shop", size=1),)),))
    out = aggregate(sales, agg)
    assert rows(out["r.h"]) == [(2.0, None, 2.0, 2), (2.0, None, 4.0, 1), (2.0, None, 6.0, 0), (2.0, None, 8.0, 1), (None, 3.0, 0.0, 2), (None, 3.0, 2.0, 2)]
    assert rows(out["r.h.s"].where("r_to IS NULL")) == [(2.0, None, 2.0, "a", 1), (2.0, None, 4.0, "a", 1), (2.0, None, 8.0, "b", 1)]


def test_a_bucket_may_be_called_like_a_field(sales):
    agg = A("TERM", "price", "shop", sub=(A("SUM", "s", "price"), A("TERM", "item", "price", size=1, sub=(A("TERM", "shop", "item"),))))
    out = aggregate(sales, agg)
    assert rows(out["price"]) == [("a", 3, 7.0), ("b", 2, 8.0), ("c", 1, 2.0)]
    assert rows(out["price.item"]) == [("a", 1.0, 1), ("b", 8.0, 1), ("c", 2.0, 1)]
    assert rows(out["price.item.shop"]) == [("a", 1.0, "x", 1), ("b", 8.0, "x", 1), ("c", 2.0, "z", 1)]


def test_filter_scope_with_a_value_query(spark, sales):
    shops = spark.createDataFrame([("b",), ("c",)], "name string")
    wanted = P("TERMS_FILTER", "shop", values_field="name", values_query=P("TYPE_FILTER", value="shops"))
    out = aggregate(sales, A("FILTER", "f", query=wanted, sub=(A("SUM", "s", "price"),)), {"shops": shops})
    assert rows(out["f"]) == [(3, 10.0)]


def test_shard_size_changes_nothing(sales):
    a, b = (aggregate(sales, A("TERM", "s", "shop", shard_size=n))["s"] for n in (1, 100))
    assert rows(a) == rows(b)


def test_approximate_cardinality_is_close(spark):
    df = spark.range(20000).selectExpr("id % 5000 AS v")
    assert metrics(df, [A("CARDINALITY", "c", "v")]).first()["c"] == pytest.approx(5000, rel=0.1)


def test_wire_round_trip():
    agg = A("TERM", "t", "f", size=3, sub=(A("FILTER", "g", query=Search(must=[term("a", 1)])),))
    wire = agg.to_wire()
    assert wire["subAggregations"][0]["queryParam"]["mustList"][0]["mdmValue"] == 1
    assert A.from_wire(wire).to_wire() == wire
    with pytest.raises(ValueError, match="unknown aggregation"):
        A("MEDIAN", "m", "f")


# fixed values: every aggregation type a stored search may hold
KINDS = """TERM TERMS NESTED FILTER MINIMUM MAXIMUM AVERAGE COUNT SUM STATS EXTENDED_STATS DATE_HISTOGRAM
HISTOGRAM RANGE CARDINALITY""".split()


@pytest.mark.parametrize("kind", KINDS)
def test_every_kind_runs_from_json(spark, kind):
    df = spark.createDataFrame([(1.0, datetime.datetime(2024, 1, 1), [2.0])], "v double, t timestamp, many array<double>")
    params = {"TERMS": ["v", "t"], "NESTED": "many", "HISTOGRAM": {"field": "v", "interval": 2},
              "DATE_HISTOGRAM": {"field": "t", "interval": "day"}, "RANGE": {"field": "v", "ranges": [[0, 5]]}}.get(kind, "v")
    wire = {"type": kind, "name": "n", "params": params, "size": 10, "shardSize": 10, "minDocCount": 0}
    if kind == "FILTER":
        wire["queryParam"] = {"mdmFilterType": "RANGE_FILTER", "mdmKey": "v", "mdmValue": [0, 9]}
    row = aggregate(df, wire)["n"].first().asDict()
    assert row.get("doc_count", 1) == 1


def test_ranges_under_a_parent_keep_empty_ones(sales):
    agg = A("TERM", "s", "shop", sub=(A("RANGE", "r", {"field": "price", "ranges": [[0.0, 3.0], [5.0, None]]}),))
    assert rows(aggregate(sales, agg)["s.r"]) == [
        ("a", 0.0, 3.0, 2), ("a", 5.0, None, 0), ("b", 0.0, 3.0, 0), ("b", 5.0, None, 1), ("c", 0.0, 3.0, 1), ("c", 5.0, None, 0)]


def test_ranges_of_days(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-02-01 00:00:00",), (None,)], "x string").select(
        F.col("x").cast("timestamp").alias("t"), F.col("x").cast("timestamp").cast("date").alias("d"))
    for field in ("t", "d"):
        out = aggregate(df, A("RANGE", "r", {"field": field, "ranges": [["2024-01-01", "2024-02-01"], ["2024-02-01", None], [None, "2020-01-01"]]}))["r"]
        assert [(r["r_from"] and r["r_from"].month, r["doc_count"]) for r in out.orderBy("r_from").collect()] == [(None, 0), (1, 1), (2, 1)]


@pytest.mark.parametrize("interval, keys", [
    ("6h", [(0, 1), (6, 0), (12, 2)]), ("1h", [(5, 1), *((h, 0) for h in range(6, 13)), (13, 2)]), ("HOUR", [(5, 1), *((h, 0) for h in range(6, 13)), (13, 2)]),
    ("1d", [(0, 3)])])
def test_fixed_and_calendar_intervals(spark, interval, keys):
    df = spark.sql("SELECT explode(array(timestamp'2024-01-01 05:59:59', timestamp'2024-01-01 13:00:00', timestamp'2024-01-01 13:30:00', NULL)) AS t")
    for least in (0, 1):
        out = aggregate(df, A("DATE_HISTOGRAM", "h", {"field": "t", "interval": interval}, min_doc_count=least))["h"]
        assert [(r["h"].hour, r["doc_count"]) for r in out.orderBy("h").collect()] == [k for k in keys if k[1] >= least]


def test_an_unknown_interval_is_refused(sales):
    with pytest.raises(ValueError, match="fortnight"):
        aggregate(sales, A("DATE_HISTOGRAM", "h", {"field": "shop", "interval": "fortnight"}, min_doc_count=1))


@pytest.fixture(scope="module")
def orders(spark):
    """A hot parent, keys that are null on any level, nulls among the values."""
    return spark.range(6000).selectExpr(
        "IF(id % 3 > 0, 'hot', IF(id % 7 = 0, NULL, concat('p', id % 11))) AS parent", "IF(id % 5 = 0, NULL, id * id % 700) AS child",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 40 AS INT)) AS at", "IF(id % 4 = 0, NULL, (id * 37 % 1001) / 4) AS price",
        "CAST(id % 9 AS INT) AS n", "CAST(id % 13 AS DECIMAL(10,2)) AS d")


TREES = [
    A("TERM", "p", "parent", size=3, sub=(A("SUM", "s", "price"), A("TERM", "c", "child", size=4, sub=(A("AVERAGE", "m", "price"), A("MINIMUM", "lo", "n"))))),
    A("TERM", "p", "parent", size=0, sub=(A("STATS", "s", "price"), A("DATE_HISTOGRAM", "d", {"field": "at", "interval": "week"}, sub=(
        A("COUNT", "k", "price"), A("TERMS", "c", ["child", "n"], size=3, sort_by="s", sort_order="DESC", sub=(A("SUM", "s", "n"),)))),)),
    A("HISTOGRAM", "h", {"field": "price", "interval": 25}, min_doc_count=1, sub=(A("TERM", "p", "parent", size=2, min_doc_count=3, sub=(A("TERM", "n", "n", size=2),)),)),
    # the limit of the first level holds for the third, also where the second has none
    A("TERM", "p", "parent", size=2, sub=(A("HISTOGRAM", "h", {"field": "n", "interval": 3}, sub=(A("TERM", "c", "child", size=2),)),)),
    # siblings, and levels that cannot be merged below ones that can
    A("TERM", "p", "parent", size=2, sub=(A("TERM", "n", "n", size=2), A("TERM", "c", "child", size=2), A("RANGE", "r", {"field": "price", "ranges": [[0, 90], [50, None]]}))),
    A("TERM", "p", "parent", size=2, sub=(A("TERM", "n", "n", size=3, sub=(A("EXTENDED_STATS", "e", "price"), A("TERM", "c", "child", size=1))),)),
    A("TERM", "p", "parent", size=2, sub=(A("SUM", "s", "d"), A("TERM", "n", "n", size=3, sub=(A("AVERAGE", "m", "d"),)))),
]


@pytest.mark.parametrize("tree", TREES)
def test_one_pass_gives_what_a_pass_for_each_level_gives(orders, tree, monkeypatch):
    merged = {path: rows(f) for path, f in aggregate(orders, tree).items()}
    monkeypatch.setattr(plans, "_chain", lambda *a: [])
    plain = aggregate(orders, tree)
    assert merged.keys() == plain.keys() and all(len(v) > 1 for v in merged.values())
    for path, f in plain.items():
        for got, want in zip(merged[path], rows(f), strict=True):
            assert got == tuple(pytest.approx(x) if isinstance(x, float) else x for x in want)


def test_two_levels_read_the_records_once(spark, orders, folder):
    orders.write.parquet(folder)
    out = aggregate(spark.read.parquet(folder), TREES[0])
    for frame in out.values():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert folder.rsplit("/", 1)[1] not in plan and "FileScan parquet" in plan  # what is read is the one pass, not the records


def test_a_parent_of_very_many_buckets(spark):
    """Its buckets are ranked by salt first: no task sees all of them."""
    df = spark.range(30000).selectExpr("1 AS p", "id AS c").union(spark.range(100).selectExpr("1", "id + 500"))
    out = aggregate(df, A("TERM", "p", "p", sub=(A("TERM", "c", "c", size=60),)))["p.c"]
    assert [r["c"] for r in out.collect()] == list(range(500, 560))
    assert out._jdf.queryExecution().toString().count("row_number() windowspec") >= 2


def test_folded_buckets_keep_their_order(spark):
    df = spark.createDataFrame([("a", k) for k, n in (("x", 1), ("y", 3), ("z", 2)) for _ in range(n)] + [("b", "q")], "p string, c string")
    tree = A("TERM", "p", "p", sub=(A("TERM", "c", "c"),))
    out = aggregate(df, tree)
    folded = nested_buckets(out["p"], out["p.c"], ["p"], "inner", bucket_order(tree.sub[0]))
    assert [(r["p"], [tuple(b) for b in r["inner"]]) for r in folded.orderBy("p").collect()] == [("a", [("y", 3), ("z", 2), ("x", 1)]), ("b", [("q", 1)])]
    by_key = nested_buckets(out["p"], out["p.c"], ["p"], "inner")
    assert [b["c"] for b in by_key.orderBy("p").first()["inner"]] == ["x", "y", "z"]


def test_nested_scope_inside_an_array_inside_a_struct(spark):
    df = spark.createDataFrame([
        (1, 10, ([([("x", 1), ("y", 2)], "u"), ([("x", 3)], "v")],)), (2, 20, ([([], "w"), (None, "w")],)), (3, 30, (None,)), (4, 40, ([([("x", 9)], "u")],))],
        "id int, price int, s struct<l: array<struct<m: array<struct<k: string, n: int>>, t: string>>>")
    agg = A("NESTED", "e", "s.l.m", sub=(
        A("SUM", "n", "s.l.m.n"), A("SUM", "prices", "price"), A("TERM", "k", "s.l.m.k", sub=(A("SUM", "prices", "price"), A("TERM", "t", "s.l.t"))), A("MAXIMUM", "short", "m.n")))
    out = aggregate(df, agg)
    assert rows(out["e"]) == [(4, 15, 70, 9)]
    assert rows(out["e.k"]) == [("x", 3, 60), ("y", 1, 10)]
    assert rows(out["e.k.t"]) == [("x", "u", 2), ("x", "v", 1), ("y", "u", 1)]
    # step by step, the scope of the inner array inside that of the outer one
    steps = A("NESTED", "l", "s.l", sub=(A("COUNT", "t", "s.l.t"), A("NESTED", "m", "s.l.m", sub=(A("SUM", "n", "s.l.m.n"), A("SUM", "p", "price")))))
    out = aggregate(df, steps)
    assert rows(out["l"]) == [(5, 5)] and rows(out["l.m"]) == [(4, 15, 70)]


@pytest.mark.parametrize("interval", ["month", "quarter", "year", "week", "day", "hour", "90m"])
def test_grids_are_dealt_out_in_blocks(spark, monkeypatch, interval):
    monkeypatch.setattr(plans, "_BLOCK", 5)
    df = spark.sql("SELECT explode(array(timestamp_ntz'2023-03-26 00:30:00', timestamp_ntz'2024-05-01 23:00:00')) AS t")
    got = aggregate(df, A("DATE_HISTOGRAM", "h", {"field": "t", "interval": interval}))["h"].collect()
    keys = [r["h"] for r in got]
    months = {"month": 1, "quarter": 3, "year": 12}.get(interval)
    if months:
        assert [(b.year - a.year) * 12 + b.month - a.month for a, b in zip(keys, keys[1:])] == [months] * (len(keys) - 1)
    else:
        step = {"week": 7 * 86400, "day": 86400, "hour": 3600, "90m": 5400}[interval]
        assert {(b - a).total_seconds() for a, b in zip(keys, keys[1:])} == {step}
    assert got[0]["doc_count"] == got[-1]["doc_count"] == 1 and sum(r["doc_count"] for r in got) == 2


def test_an_approximate_distinct_count_is_within_a_tenth(spark):
    """Values at which a sketch of 512 registers says 22865 for 20000."""
    df = spark.range(20_000).select((F.col("id") + 78 * 1_000_003).alias("x"))
    found = metrics(df, [A("CARDINALITY", "about", "x")]).first()["about"]
    assert abs(found - 20_000) <= 2_000
