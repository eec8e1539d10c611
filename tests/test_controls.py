import datetime

import pytest
from pyspark.sql import functions as F

from goldspan.operators import controls as q
from goldspan.operators.deletes import DeletableTable, FoldedMeanwhile
from goldspan.plans.filters import Predicate, Search, between, has_type, term
from goldspan.plans.named import bind_search, parameters, run_sql_template
from goldspan.plans.request import aggregations, find

from conftest import rows


def make_ranges(spark, low, high, n):
    bounds = spark.createDataFrame([(low, high)], "min_key long, max_key long")
    return [(r["range_from"], r["range_to"]) for r in q.key_ranges(bounds, n).orderBy("slice").collect()]


def test_ranges(spark):
    assert make_ranges(spark, 0, 10, 3) == [(None, -1), (0, 3), (4, 7), (8, 9), (10, None)]
    assert make_ranges(spark, 5, 5, 4) == [(None, 4), (5, 5), (6, None)]
    assert q.key_ranges(spark.createDataFrame([(None, None)], "min_key long, max_key long"), 3).count() == 0


@pytest.mark.parametrize("low, high, n", [(0, 10, 3), (5, 5, 4), (-7, 100, 9), (0, 1, 1), (3, 1000, 7)])
def test_every_key_is_in_one_range_and_arithmetic_finds_it(spark, low, high, n):
    ranges = make_ranges(spark, low, high, n)
    keys = range(low - 3, high + 4)
    df = spark.range(low - 3, high + 4).select("id", q.slice_of(F.col("id"), low, high, n).alias("s"))
    placed = {r["id"]: r["s"] for r in df.collect()}
    for k in keys:
        owners = [i for i, (a, b) in enumerate(ranges) if (a is None or k >= a) and (b is None or k <= b)]
        assert owners == [placed[k]]


def test_bounds_and_multiplier(spark):
    df = spark.createDataFrame([(3, "a"), (11, "a"), (90, "b")], "k long, g string")
    assert rows(q.key_bounds(df, "k", term("g", "a"))) == [(3, 11)]
    assert rows(q.key_bounds(df, "k", multiplier=1.5)) == [(4 - 10, 135 + 10)]


def test_range_scan_keeps_every_row(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id < 400 THEN 7 ELSE id END AS k")
    out = q.range_scan(df, "k", 10)
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    ranges = out.groupBy("slice").agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("slice").collect()
    assert [r["slice"] for r in ranges] == list(range(len(ranges))) and 5 < len(ranges) <= 11
    assert all(a["hi"] < b["lo"] for a, b in zip(ranges, ranges[1:])) and max(r["n"] for r in ranges[1:]) < 250
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()  # nothing is moved
    assert q.range_scan(df.limit(0), "k", 10).count() == 0
    with pytest.raises(ValueError):
        q.range_scan(df, "k", 9999)


def test_sort_puts_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r["v"] for r in q.sort_records(df, "v").collect()] == [1, 3, None]
    assert [r["v"] for r in q.sort_records(df, "v", "DESC").collect()] == [3, 1, None]


def test_pages_cover_everything_once(spark):
    df = spark.range(25).withColumn("v", F.col("id") % 4)
    pages = [[r["id"] for r in q.page(df, ["v", "id"], offset=o, page_size=10).collect()] for o in (0, 10, 20, 30)]
    assert [len(p) for p in pages] == [10, 10, 5, 0]
    assert sorted(sum(pages, [])) == list(range(25))


def test_max_hits_is_exact(spark):
    df = spark.range(10)
    assert [r["id"] for r in q.at_most(df, ["id"], 4).collect()] == [0, 1, 2, 3]
    assert q.at_most(df, ["id"], 99).count() == 10
    assert q.at_most(df, ["id"]).count() == 10


def test_unique_check(spark):
    assert q.check_unique(spark.createDataFrame([("a",), ("b",)], "mdmId string")).count() == 2
    with pytest.raises(ValueError, match="repeated"):
        q.check_unique(spark.createDataFrame([("a",), ("a",)], "mdmId string"))


def test_delete_keeps_undecided_records(spark, folder):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9)], "id int, v int")
    left, gone = q.delete_to(df, between("v", 6, None), folder)
    assert sorted(r["id"] for r in left.collect()) == [1, 2] and gone == 1
    with pytest.raises(Exception):
        q.delete_to(df, between("v", 6, None), folder)  # never over an existing table


def test_delete_model_records_includes_the_moment(spark):
    moment = datetime.datetime(2020, 5, 1)
    df = spark.createDataFrame([(1, moment), (2, moment + datetime.timedelta(seconds=1)), (3, None)], "id int, mdmLastUpdated timestamp")
    out = q.delete_model_records({"mGolden": df, "mMaster": df, "mRejected": df}, "m", moment)
    assert all(sorted(r["id"] for r in t.collect()) == [2, 3] for t in out.values())


def test_rejected_of_staging_needs_the_underscore(spark):
    df = spark.createDataFrame([("x", "c_s", (1, 2, 3)), ("y", "c_t", (4, 5, 6))],
                               "mdmId string, mdmStagingEntityName string, mdmStagingRecord struct<price_a:int,price:int,my_price_b:int>")
    out = q.rejected_of_staging(df, "c_s", ["price"])
    assert out.columns == ["mdmId", "price_a", "my_price_b"] and rows(out) == [("x", 1, 3)]


TEMPLATE = {"mustList": [{"mdmFilterType": "TERM_FILTER", "mdmKey": "name", "mdmValue": "{{ who }}"},
                         {"mdmFilterType": "RANGE_FILTER", "mdmKey": "v", "mdmValue": ["{{low}}", None]}]}


def test_template_parameters_keep_their_type():
    assert parameters(TEMPLATE) == ["who", "low"]
    search = bind_search(TEMPLATE, {"who": '"}] or 1=1', "low": 5})
    assert search.must[0].value == '"}] or 1=1' and search.must[1].value == [5, None]
    with pytest.raises(ValueError, match="missing"):
        bind_search(TEMPLATE, {"who": "x"})
    with pytest.raises(ValueError, match="unknown"):
        bind_search(TEMPLATE, {"who": "x", "low": 1, "high": 2})


def test_sql_template_binds_values_not_text(spark):
    spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int").createOrReplaceTempView("named_t")
    out = run_sql_template(spark, "SELECT v FROM named_t WHERE name = {{who}}", {"who": "a' OR '1'='1"})
    assert out.count() == 0


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(
        [("m1", "pGolden", (1, "x")), ("m2", "pGolden", (2, "y")), ("m3", "pGolden", None)],
        "mdmId string, mdmEntityType string, mdmGoldenFieldAndValues struct<k:int,g:string>")


def test_find(golden):
    tables = {"pGolden": golden, "pMaster": golden}
    wire = Search(must=[has_type("pGolden"), Predicate("EXISTS_FILTER", "mdmGoldenFieldAndValues.k")]).to_wire()
    assert rows(find(tables, wire)) == [(1, "x"), (2, "y")]
    assert rows(find(tables, wire, only_hits=False).select("mdmId")) == [("m1",), ("m2",)]
    assert rows(find(tables, Search(must=[has_type("pGolden")]))) == [(1, "x"), (2, "y")]  # no values: no hit
    assert rows(find(tables, wire, fields=["mdmGoldenFieldAndValues.g"], sort_by="mdmGoldenFieldAndValues.k", sort_order="DESC", max_hits=1)) == [("y",)]
    assert rows(find(tables, wire, offset=1, page_size=5)) == [(2, "y")]
    either = Search(should=[has_type("pGolden"), has_type("pMaster")])
    assert find(tables, either, only_hits=False).count() == 6
    with pytest.raises(ValueError, match="repeated"):
        find(tables, either, only_hits=False, safe_check=True)
    with pytest.raises(ValueError, match="type"):
        find(tables, Search(must=[has_type("other")]))


def test_find_with_a_page_callback(golden):
    def page(frame):
        return frame.assign(k=frame["k"] * 10)[["k"]]

    wire = Search(must=[has_type("pGolden")]).to_wire()
    assert rows(find({"pGolden": golden}, wire, callback=page, callback_schema="k int")) == [(10,), (20,)]


def test_aggregations_of_a_request(golden):
    wire = {"mustList": [{"mdmFilterType": "TYPE_FILTER", "mdmValue": "pGolden"}],
            "aggregationList": [{"type": "MINIMUM", "name": "MINIMUM", "params": "mdmGoldenFieldAndValues.k", "size": 10, "shardSize": 10, "minDocCount": 0},
                                {"type": "MAXIMUM", "name": "MAXIMUM", "params": "mdmGoldenFieldAndValues.k"}]}
    assert rows(aggregations({"pGolden": golden}, wire)["metrics"]) == [(1, 2)]


def test_all_of_type(golden):
    assert q.all_of_type({"pGolden": golden}, "p").count() == 3
    assert q.all_of_type({"pGolden": golden}, "pGolden").count() == 3


def test_a_table_without_keys_has_no_slices(spark):
    df = spark.createDataFrame([(None,)], "id long")
    low, high = q.key_bounds(df, "id").first()
    assert df.select(q.slice_of(F.col("id"), low, high, 7).alias("s")).first()["s"] is None


# --- deletes ------------------------------------------------------------------------------

def by_values(values_field="c"):
    return Predicate("TERMS_FILTER", "v", values_field=values_field, values_query=Search(must=[has_type("lists")]))


@pytest.mark.parametrize("part", ["must", "must_not", "should"])
def test_a_delete_takes_values_from_another_table(spark, folder, part):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (4, 5), (5, 7)], "id int, v int")
    lists = {"lists": spark.createDataFrame([(5,), (5,), (None,), (9,)], "c int")}
    left, gone = q.delete_to(df, Search(**{part: [by_values()]}), folder, lists)
    doomed = {"must": {1, 3, 4}, "should": {1, 3, 4}, "must_not": {2, 5}}[part]
    assert {r["id"] for r in left.collect()} == {1, 2, 3, 4, 5} - doomed and gone == len(doomed)
    assert left.columns == ["id", "v"]
    table = DeletableTable(spark, folder + "-marked")
    table.append(df)
    assert table.delete(Search(**{part: [by_values()]}), lists) == len(doomed)
    assert {r["id"] for r in table.read().collect()} == {1, 2, 3, 4, 5} - doomed


def test_deletes_by_marks(spark, folder):
    table = DeletableTable(spark, folder)
    with pytest.raises(ValueError, match="no records"):
        table.read()
    table.append(spark.range(100).select("id", (F.col("id") % 10).alias("v")).repartition(3))
    assert table.delete(term("v", 3)) == 10 and table.delete(term("v", 3)) == 0  # they are gone already
    table.append(spark.range(100, 110).select("id", F.lit(3).cast("long").alias("v"), F.lit("x").alias("more")))
    assert table.read().where("v = 3").count() == 10 and table.read().count() == 100
    assert table.delete(between("id", 50, 104)) == 50
    expected = [i for i in range(110) if i < 50 and i % 10 != 3 or i > 104]
    assert sorted(r["id"] for r in table.read().collect()) == expected
    before = table.read()
    table.fold()
    assert sorted(r["id"] for r in table.read().collect()) == sorted(r["id"] for r in before.collect()) == expected
    assert table.manifest.latest()[1]["marks"] == [] and len(table.manifest.latest()[1]["parts"]) == 1
    table.append(spark.range(1).select("id", F.lit(9).cast("long").alias("v")))
    assert table.delete(term("v", 9)) == 1 + len([i for i in expected if i % 10 == 9 and i < 50])
    table.fold()
    table.fold()
    assert table.read().where("v = 9").count() == 0 and len(table.manifest.versions()) == 2


def test_a_delete_that_dies_deletes_nothing(spark, folder, monkeypatch):
    from goldspan.sources.manifest import Manifest
    table = DeletableTable(spark, folder)
    table.append(spark.range(10))
    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.delete(between("id", 0, 4))
    assert table.read().count() == 10 and table.delete(between("id", 0, 4)) == 5


def test_a_fold_that_is_overtaken_by_a_delete_is_made_again(spark, folder, monkeypatch):
    table = DeletableTable(spark, folder)
    table.append(spark.range(10))
    table.delete(term("id", 1))
    live = DeletableTable._live

    def slow(self, state):
        monkeypatch.setattr(DeletableTable, "_live", live)
        DeletableTable(spark, folder).delete(term("id", 2))
        return live(self, state)

    monkeypatch.setattr(DeletableTable, "_live", slow)
    with pytest.raises(FoldedMeanwhile):
        table.fold()
    assert table.read().count() == 8
    table.fold()
    assert table.read().count() == 8


def test_a_delete_reads_the_table_once(spark, folder):
    """The survivors are counted where they are written."""
    spark.range(1000).write.parquet(folder)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.read.parquet(folder).mapInPandas(count, "id long")
    assert q.delete_to(df, between("id", 0, 99), folder + "-left")[1] == 100 and seen.value == 1000
