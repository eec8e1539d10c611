import pytest
from pyspark.sql import functions as F

from goldspan.operators import intake, sinks
from goldspan.operators.rules import Rule
from goldspan.operators.sqlapi import TableCache, TableNotFound, check_select, run_sql
from goldspan.session import path_exists, sizing, workspace
from goldspan.sources.lake import Lake, union_drifted, with_keys
from goldspan.sources.tables import StepOutputs, read_table

from conftest import rows


@pytest.fixture
def lake(spark, folder):
    lake = Lake(spark, folder)
    df = spark.createDataFrame(
        [(1, "a", "x", "2019-11-25"), (2, "b", "x", "2019-11-26"), (3, "c", "x", "2019-12-01"), (4, "d", "y", "2019-11-25")],
        "mdmCounterForEntity long, mdmId string, who string, ingest_date string")
    lake.write(df.withColumn("source", F.concat(F.lit("c_"), "who")).drop("who"), "staging", ["source", "ingest_date"])
    rejected = spark.createDataFrame([(9, "z", "bad", "c_x", "2019-11-25")], "mdmCounterForEntity long, mdmId string, why string, source string, ingest_date string")
    lake.write(rejected, "staging_rejected", ["source", "ingest_date"])
    return lake


def ids(df):
    return sorted(r["mdmId"] for r in df.collect())


def test_prefix_prunes(lake):
    assert ids(lake.scan("staging", "c_x")) == ["a", "b", "c"]
    assert ids(lake.scan("staging", "c_x", prefix="2019-11")) == ["a", "b"]
    day = lake.scan("staging", "c_x", prefix="2019-11-25")
    assert ids(day) == ["a"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ingest_date" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_staging_is_the_union_of_its_spaces(lake):
    out = lake.staging("c", "x")
    assert out.columns == sorted(out.columns)
    assert {(r["mdmId"], r["space"], r["why"]) for r in out.collect()} == {
        ("a", "staging", None), ("b", "staging", None), ("c", "staging", None), ("z", "staging_rejected", "bad")}
    assert ids(lake.staging("c", "y")) == ["d"]  # absent folders are left out
    with pytest.raises(ValueError):
        lake.staging("c", "nothing")


def test_scan_options(lake):
    assert lake.scan("staging", "c_x", columns=["mdmId"]).columns == ["mdmId", "mdmCounterForEntity"]
    assert lake.scan("staging", "c_x", columns=["ingest_date"]).columns == ["ingest_date", "mdmCounterForEntity", "mdmId"]
    assert lake.scan("staging", "c_x", renames={"mdmId": "key"}).columns == ["mdmCounterForEntity", "key"]
    assert ids(lake.scan("staging", "c_x", max_hits=2)) == ["a", "b"]
    called = lake.scan("staging", "c_x", callback=lambda f: f[f["mdmCounterForEntity"] > 1])
    assert ids(called) == ["b", "c"]
    assert lake.scan("golden", "m") is None
    with pytest.raises(ValueError, match="unknown lake space"):
        lake.scan("attic", "m")
    assert with_keys(["a", "mdmId", "a"]) == ["a", "mdmId", "mdmCounterForEntity"]


def test_drift_inside_one_table(spark, folder):
    lake = Lake(spark, folder)
    lake.write(spark.createDataFrame([(1, "m")], "a int, name string"), "golden", ["name"])
    lake.write(spark.createDataFrame([(2, 5, "m")], "a int, b int, name string"), "golden", ["name"])
    assert rows(lake.scan("golden", "m", drifted=True).select("a", "b")) == [(1, None), (2, 5)]


def test_union_sorts_columns(spark):
    out = union_drifted([spark.createDataFrame([(1, 2)], "z int, b int"), spark.createDataFrame([(3,)], "a int")])
    assert out.columns == ["a", "b", "z"] and rows(out) == [(3, None, None), (None, 2, 1)]


def test_read_table_options_work_alone(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    assert read_table(df, restriction="g = 1").count() == 500
    assert read_table(df, ["id"], "g = 1").columns == ["id"]
    n = read_table(df, sample_percentage=30.0, seed=1).count()
    assert 200 < n < 400 and n == read_table(df, sample_percentage=30.0, seed=1).count()
    spread = read_table(df.repartition(7), sample_percentage=30.0, seed=1, sample_key=["id"])
    assert rows(spread) == rows(read_table(df.coalesce(1), sample_percentage=30.0, seed=1, sample_key=["id"]))
    assert read_table(df, sample_percentage=100.0).count() == df.count() and read_table(df, sample_percentage=0.0).count() == 0
    with pytest.raises(ValueError):
        read_table(df, sample_percentage=130.0)


def test_step_outputs(spark, folder):
    out = StepOutputs(spark, folder)
    df = spark.createDataFrame([(1, "é")], "a int, b string")
    for form in ("parquet", "json"):
        assert not out.exists("x", form)
        out.save(df, "x", form)
        out.save(df, "x", form)
        assert out.exists("x", form) and rows(out.load("x", form, columns=["b"])) == [("é",)]
        assert out.remove("x", form) and not out.exists("x", form)
    empty = spark.createDataFrame([], "a int")
    out.save(empty, "none")
    assert out.load("none").count() == 0 and out.load("none").columns == ["a"]
    with pytest.raises(ValueError, match="unsupported"):
        out.save(df, "x", "feather")


def test_staging_write_checks(spark, folder):
    lake = Lake(spark, folder)
    df = spark.createDataFrame([(1, "2020-01-01"), (1, "2020-01-02")], "k int, day string")
    with pytest.raises(ValueError, match="repeats"):
        sinks.write_staging(lake, df, "c", "s", ["k"], "day")
    with pytest.raises(ValueError, match="not in the record"):
        sinks.write_staging(lake, df, "c", "s", ["z"], "day")
    assert lake.scan("staging", "c_s") is None
    sinks.write_staging(lake, df, "c", "s", ["k"], "day", force=True)
    assert lake.scan("staging", "c_s", prefix="2020-01-02").count() == 1


def test_send(spark, folder):
    lake = Lake(spark, folder)
    df = spark.createDataFrame([(i, "2020-01-01", "x" if i == 3 else str(i)) for i in range(10)], "k int, day string, v string")
    account = intake.send(lake, df, "c", "s", ["k"], "day", "b", step_size=4, types={"v": "long"}, rules=[Rule("VALUE_COMPARE", "v", (">", 7))])
    assert rows(account) == [("b", 10, 3)]
    out = lake.staging("c", "s")
    assert rows(out.where("space = 'staging'").select("k")) == [(i,) for i in (0, 1, 2, 4, 5, 6, 7)]
    assert rows(out.where("space = 'staging_rejected'").select("k", "mdmErrors")) == [
        (3, ["TYPE:v"]), (8, ["VALUE_COMPARE:v"]), (9, ["VALUE_COMPARE:v"])]
    with pytest.raises(ValueError, match="repeats"):
        intake.send(lake, df.union(df), "c", "s", ["k"], "day", "b2")
    assert rows(intake.send(lake, df.union(df), "c", "s", ["k"], "day", "b2", force=True)) == [("b2", 20, 1)]


def test_write_validated(spark, folder):
    golden, rejected = sinks.write_validated(spark.range(10), [Rule("VALUE_COMPARE", "id", ("<", 3))], folder)
    assert (golden.count(), rejected.count()) == (7, 3)
    assert golden.columns == ["id"] and rejected.columns == ["id", "mdmErrors"]


def test_process_sql_switches(spark, folder):
    spark.createDataFrame([(1,), (1,)], "a int").createOrReplaceTempView("proc_t")
    assert sinks.process_sql(spark, "SELECT a FROM proc_t", folder).count() == 2
    assert sinks.process_sql(spark, "SELECT a FROM proc_t", folder, deduplicate=True).count() == 3
    assert sinks.process_sql(spark, "SELECT a FROM proc_t", folder, clear_target=True, send_realtime=True).count() == 1
    with pytest.raises(ValueError):
        sinks.process_sql(spark, "DROP TABLE proc_t", folder)


def test_json_lines(spark, folder):
    sinks.write_json_lines(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), folder)
    assert sorted(r["value"] for r in spark.read.text(folder).collect()) == ['{"a":1}', '{"a":2,"b":"x"}']


@pytest.mark.parametrize("query", [
    "SELECT 1", " select a from (SELECT 1 AS a) ;", "WITH x AS (SELECT 1 AS a) SELECT a FROM x", "SELECT ';' AS a",
    "SELECT 1 -- ; drop", "SELECT 1 AS a, 2 AS a",
])
def test_queries_pass(spark, query):
    assert spark.sql(check_select(spark, query)).count() == 1


@pytest.mark.parametrize("query", [
    "", " ; ", "DROP TABLE x", "INSERT INTO x VALUES (1)", "SELECT 1; SELECT 2", "SHOW TABLES", "SET x = 1",
    "WITH x AS (SELECT 1) INSERT INTO y SELECT * FROM x", "SELECT 1) AS _q; DROP TABLE x --", "DESCRIBE x",
    "SELECTED", "CREATE TABLE t AS SELECT 1",
])
def test_anything_else_is_refused(spark, query):
    with pytest.raises(ValueError):
        check_select(spark, query)


def test_table_cache(spark):
    cache = TableCache(spark, [(spark.createDataFrame([(1, "a")], "id int, name string"), "tc_users")])
    cache.append("tc_users", spark.createDataFrame([("b", 9, 2)], "name string, more int, id int"))
    assert rows(cache.query("SELECT id, name FROM tc_users")) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="missing"):
        cache.append("tc_users", spark.createDataFrame([(3,)], "id int"))
    with pytest.raises(TableNotFound):
        cache.append("tc_nobody", spark.range(1))
    cache.add("tc_users", spark.createDataFrame([(7,)], "id int"), keep=True)
    assert rows(cache.query("SELECT * FROM tc_users")) == [(7,)]
    cache.close(["tc_users"])
    cache.delete("tc_users")
    assert not spark.catalog.tableExists("tc_users")


def test_run_sql_with_a_default_database(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert rows(run_sql(spark, "SELECT a FROM given_t", given_t=df)) == [(1,)]
    before = spark.catalog.currentDatabase()
    assert rows(run_sql(spark, "SELECT current_database() AS d", database="default")) == [("default",)]
    assert spark.catalog.currentDatabase() == before


def test_workspace_is_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = workspace(spark, "here")
    if named:
        assert path.startswith(named)
    assert not path_exists(spark, path) and workspace(spark, "here") != path


def test_sizing():
    assert sizing(1 << 30, 8)["spark.sql.shuffle.partitions"] == "16"
    assert sizing(10 << 40, 4000)["spark.sql.shuffle.partitions"] == "81920"
    assert sizing(100 << 40, 4000)["spark.sql.shuffle.partitions"] == "100000"


def test_records_of_differing_shape_keep_all_fields(spark):
    from goldspan.sources.records import records_frame
    got = records_frame(spark, [{"a": 1, "n": {"x": 1}}, {"a": 2.5, "b": 3, "n": {"y": "z"}}, {"b": "t"}]).collect()
    assert [(r["a"], r["b"]) for r in got] == [(1.0, None), (2.5, "3"), (None, "t")]
    assert got[1]["n"]["y"] == "z"


def test_quoted_placeholders_are_bound(spark):
    from goldspan.plans.named import run_sql_template
    got = run_sql_template(spark, "SELECT '{{p}}' AS a, 'x{{p}}y' AS b, {{n}} + 1 AS c", {"p": "it's", "n": 2}).first()
    assert tuple(got) == ("it's", "xit'sy", 3)


def test_a_request_without_size_asks_for_all_buckets():
    from goldspan.plans.aggregations import Aggregation
    assert Aggregation.from_wire({"type": "TERM", "name": "n", "params": "f"}).size == 0


@pytest.mark.parametrize("query", [
    "SELECT reflect('java.lang.System', 'getProperty', 'x')", "SELECT transform(array(1), x -> JAVA_METHOD('java.lang.Math', 'abs', x))",
    "SELECT 1 WHERE EXISTS (SELECT `try_reflect`('java.lang.Math', 'abs', 1))",
    "WITH x AS (SELECT java_method('java.lang.Math', 'abs', 1) AS b) SELECT * FROM x"])
def test_calls_of_jvm_methods_are_refused(spark, query):
    with pytest.raises(ValueError, match="not allowed in a query"):
        check_select(spark, query)


def test_names_and_texts_like_jvm_calls_are_fine(spark):
    assert spark.sql(check_select(spark, "SELECT reflect, 'reflect(1)' AS t FROM (SELECT 1 AS reflect)")).count() == 1


def test_a_file_callback_sees_whole_files(spark, folder):
    """Two files of several Arrow batches each; the callback ranks the rows within a file, after the renames, before the limit."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        lake = Lake(spark, folder)
        for start in (0, 1000):
            part = spark.range(start, start + 700).select(
                F.col("id").alias("mdmCounterForEntity"), F.col("id").cast("string").alias("mdmId"), (F.col("id") * 7919 % 1009).alias("v-1"),
                F.lit("m").alias("name"), F.lit("2024-01-01").alias("ingest_date")).coalesce(1)
            part.write.mode("append").partitionBy("name", "ingest_date").parquet(lake.path("golden"))
        seen = lambda f: f.assign(rank=f["v"].rank().astype(int), n=len(f)).drop(columns="v")
        out = lake.scan("golden", "m", columns=["v-1"], renames={"v-1": "v"}, callback=seen,
                        callback_schema="mdmCounterForEntity long, mdmId string, rank long, n long")
        want = []
        for start in (0, 1000):
            values = sorted((i * 7919 % 1009, i) for i in range(start, start + 700))
            want += [(i, str(i), r + 1, 700) for r, (_, i) in enumerate(values)]
        assert sorted(tuple(r) for r in out.collect()) == sorted(want)
        few = lake.scan("golden", "m", columns=["v-1"], renames={"v-1": "v"}, max_hits=5, callback=lambda f: f[f["v"] % 2 == 0])
        assert [r["mdmCounterForEntity"] for r in few.collect()] == [i for i in [*range(700), *range(1000, 1700)] if i * 7919 % 1009 % 2 == 0][:5]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_file_callback_keeps_the_order_of_the_file(spark, folder):
    from goldspan.sources.lake import map_files
    spark.range(500).orderBy(F.desc("id")).coalesce(1).write.parquet(folder)
    first = map_files(spark.read.parquet(folder), lambda f: f.head(3))
    assert [r["id"] for r in first.collect()] == [499, 498, 497] and first.columns == ["id"]


def test_a_file_of_any_size_reaches_a_callback_in_pages(spark, folder):
    """Two files: one call for each, all rows in the order asked for, equal ones and by default all as they lie; no more than a page at once."""
    from goldspan.sources.lake import map_file_pages
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        for start in (0, 1000):
            spark.range(start, start + 700).select("id", (F.col("id") * 7919 % 101).alias("v")).orderBy(F.desc("id")).coalesce(1).write.mode("append").parquet(folder)

        def ranked(pages):
            before = 0
            for page in pages:
                yield page.assign(place=range(before, before + len(page)), page=len(page))
                before += len(page)

        for order, by in (([F.desc("v")], lambda i: (-(i * 7919 % 101), -i)), ([], lambda i: -i)):
            out = map_file_pages(spark.read.parquet(folder), ranked, "id long, v long, place long, page long", order).collect()
            want = {i: r for start in (0, 1000) for r, i in enumerate(sorted(range(start, start + 700), key=by))}
            assert {r["id"]: r["place"] for r in out} == want and len(out) == 1400 and max(r["page"] for r in out) <= 100
        first = map_file_pages(spark.read.parquet(folder), lambda pages: (next(pages).head(1) for _ in range(1)))
        assert sorted(r["id"] for r in first.collect()) == [699, 1699] and first.columns == ["id", "v"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("values, kind", [
    ([9007199254740993, 1.5], "decimal(38,1)"), ([9007199254740992, 1.5], "double"), ([9007199254740993, 1e-30], "string"), ([2 ** 63, 1], "decimal(38,0)"),
    ([10 ** 40, 1], "string"), ([-(2 ** 63), 2 ** 53 + 1], "bigint"), ([1, 0.25, None], "double"), ([10 ** 400, 1.5], "string"), ([2 ** 60 + 1, -0.001, None], "decimal(38,3)")])
def test_whole_numbers_beside_doubles_keep_their_digits(spark, values, kind):
    from decimal import Decimal
    from goldspan.sources.records import records_frame
    df = records_frame(spark, [{"i": i, "a": v, "in": {"l": [v]}} for i, v in enumerate(values)])
    assert dict(df.dtypes)["a"] == kind and dict(df.select("in.l").dtypes)["l"] == f"array<{kind}>"
    for r in df.collect():
        want = values[r["i"]]
        for got in (r["a"], r["in"]["l"][0]):
            assert (got is None) == (want is None) and (want is None or Decimal(str(got)) == Decimal(repr(want)))
