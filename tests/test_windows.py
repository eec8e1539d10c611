"""Slabbed windows against plain ones, with one key that holds most rows."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from goldspan.operators import windows
from goldspan.operators.joins import interval_join, latest_before, left_join_many
from goldspan.operators.sinks import batch_slices, batch_summary

from conftest import rows


@pytest.fixture(autouse=True)
def many_slabs(spark):
    """Small slabs would be merged into one: keep them apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(11)
    keys = [None, *[f"k{n}" for n in range(40)]]
    data = [(i, "hot" if i % 3 else rng.choice(keys), rng.randrange(60), rng.randrange(1000)) for i in range(3000)]
    return spark.createDataFrame(data, "id int, k string, t int, v int").repartition(6)


BY, ORDER = ["k"], ["t", "id"]


def plain():
    return Window.partitionBy("k").orderBy("t", "id")


@pytest.fixture
def eight(monkeypatch):
    """The hot key falls into at least eight slabs."""
    plain_cut = windows.cut_of
    monkeypatch.setattr(windows, "cut_of", lambda df, by, order, slabs=None, **limits: plain_cut(df, by, order, slabs or 16, **limits))


def test_the_hot_key_is_cut(events, eight):
    cut = windows.cut_of(events, BY, ORDER)
    slabs = windows.with_slab(events, cut)
    sizes = [r["count"] for r in slabs.where("k = 'hot'").groupBy("_slab").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 500
    # the others are not cut
    assert [r[0] for r in slabs.where("k <> 'hot' OR k IS NULL").select("_slab").distinct().collect()] == [0]
    # along the order
    edges = slabs.where("k = 'hot'").groupBy("_slab").agg(F.min(F.struct(*ORDER)).alias("lo"), F.max(F.struct(*ORDER)).alias("hi")).orderBy("_slab").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(edges, edges[1:]))


def test_nothing_is_stored_and_no_plan_pairs_all_rows(events, eight, monkeypatch):
    import goldspan.session
    monkeypatch.setattr(goldspan.session, "stored", lambda *a: pytest.fail("stored"))
    out = windows.framed(events, BY, ORDER, {"s": ("sum", "v")}, -3, 0)
    plan = out._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


KINDS = [("int", 5), ("bigint", -(2 ** 60)), ("double", float("nan")), ("double", -0.5), ("string", "o'Ö\\n"), ("string", "x" * 500), ("boolean", True),
         ("date", "2024-02-29"), ("timestamp", "2024-10-27 00:30:00"), ("timestamp_ntz", "2024-03-31 02:30:00.000001"), ("decimal(20,3)", "12345.678"), ("binary", "ab")]


@pytest.mark.parametrize("kind, value", KINDS)
def test_keys_and_orders_of_any_type(spark, kind, value):
    """A hot key of this type, and an order column of it with nulls; the zone has a repeated hour."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        one = F.lit(value).cast(kind)
        df = spark.range(600).select("id", F.when(F.col("id") % 5 > 0, one).alias("k"), F.when(F.col("id") % 3 > 0, one).alias("o")).repartition(5)
        got = windows.ranked(df, ["k"], ["o", "id"], ["o"])
        placed, tied = Window.partitionBy("k").orderBy("o", "id"), Window.partitionBy("k").orderBy("o")
        want = df.select("id", F.row_number().over(placed).alias("n"), F.rank().over(tied).alias("r"), F.dense_rank().over(tied).alias("d"))
        assert rows(got.select("id", "row_number", "rank", "dense_rank")) == rows(want)
        assert len(windows.cut_of(df, ["k"], ["o", "id"]).bounds) > 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


FRAMES = [(-2, 0), (0, 0), (-1, 4), (2, 5), (-30, -3), (None, 0), (None, 3), (None, -4), (0, None), (-3, None), (6, None), (None, None), (-400, 0)]
FUNCTIONS = {"s": ("sum", "x"), "n": ("count", "x"), "lo": ("min", "x"), "hi": ("max", "x"), "mean": ("avg", "x")}


def nulled(events):
    return events.withColumn("x", F.when(F.col("v") % 4 > 0, F.col("v")))


@pytest.mark.parametrize("start, end", FRAMES)
def test_frames_of_rows(events, eight, start, end):
    low = Window.unboundedPreceding if start is None else start
    high = Window.unboundedFollowing if end is None else end
    w = plain().rowsBetween(low, high)
    data = nulled(events)
    want = data.select("*", *[getattr(F, f)(c).over(w).alias(n) for n, (f, c) in FUNCTIONS.items()])
    assert rows(windows.framed(data, BY, ORDER, FUNCTIONS, start, end).select(want.columns)) == rows(want)


def test_frames_of_rows_over_short_slabs(spark, monkeypatch):
    """Slabs shorter than the frame: rows of several slabs meet in it."""
    plain_cut = windows.cut_of
    monkeypatch.setattr(windows, "cut_of", lambda df, by, order, **_: plain_cut(df, by, order, 200))
    df = spark.range(400).select(F.lit("k").alias("k"), "id", (F.col("id") * 37 % 101).alias("x"))
    assert len(windows.cut_of(df, ["k"], ["id"]).bounds) > 60
    for start, end in [(-20, 0), (-9, 12), (3, 15), (None, 9), (-11, None), (None, -13), (14, None)]:
        w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding if start is None else start, Window.unboundedFollowing if end is None else end)
        want = df.select("*", *[getattr(F, f)(c).over(w).alias(n) for n, (f, c) in FUNCTIONS.items()])
        assert rows(windows.framed(df, ["k"], ["id"], FUNCTIONS, start, end).select(want.columns)) == rows(want)


RANGES = [(-3, 0), (0, 0), (0, 4), (-2, 2), (3, 9), (-12, -5), (None, 0), (None, 5), (None, -4), (0, None), (-6, None), (4, None), (None, None), (-500, 0)]


@pytest.mark.parametrize("start, end", RANGES)
def test_frames_of_values(spark, events, eight, start, end):
    """Many rows share a value; some have none."""
    data = nulled(events).withColumn("at", F.when(F.col("t") != 7, F.col("t") * 3 + F.col("v") % 3))
    low = Window.unboundedPreceding if start is None else start
    high = Window.unboundedFollowing if end is None else end
    w = Window.partitionBy("k").orderBy("at").rangeBetween(low, high)
    want = data.select("*", *[getattr(F, f)(c).over(w).alias(n) for n, (f, c) in FUNCTIONS.items()])
    assert rows(windows.framed_by_value(data, BY, "at", FUNCTIONS, start, end).select(want.columns)) == rows(want)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_frames_of_time(spark, eight, kind):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        times = "timestamp'2024-10-20 00:00:00' + make_interval(0, 0, 0, 0, CAST(id % 400 AS INT))" if kind != "date" else "date'2024-01-01' + CAST(id % 90 AS INT)"
        df = spark.range(2000).selectExpr("id", "IF(id % 5 = 0, id % 7, -1) AS k", f"CAST({times} AS {kind}) AS at")
        days = 7 if kind == "date" else timedelta(days=1, hours=5)
        got = windows.framed_by_value(df, ["k"], "at", {"n": ("count", "id"), "s": ("sum", "id")}, -days, 0)
        table = [tuple(r) for r in df.selectExpr("id", "k", "unix_date(at)" if kind == "date" else "unix_seconds(CAST(at AS TIMESTAMP))").collect()]
        if kind == "timestamp_ntz":
            table = [(i, k, i % 400 * 3600) for i, k, _ in table]  # a wall clock knows no repeated hour
            if df.selectExpr("count(DISTINCT at)").first()[0] < 400:
                table = [tuple(r) for r in df.selectExpr("id", "k", "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', at)").collect()]
        width = 7 if kind == "date" else int(days.total_seconds())
        for i, n, s in got.select("id", "n", "s").collect():
            _, k, at = table[i]
            near = [j for j, l, t in table if l == k and at - width <= t <= at]
            assert (n, s) == (len(near), sum(near))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_frames_that_make_no_sense(events):
    with pytest.raises(ValueError):
        windows.framed(events, BY, ORDER, {"x": ("median", "v")})
    with pytest.raises(ValueError):
        windows.framed(events, BY, ORDER, {"x": ("sum", "v")}, 2, 1)
    with pytest.raises(ValueError):
        windows.framed_by_value(events, BY, "k", {"x": ("sum", "v")}, -1, 0)


@pytest.mark.parametrize("down", [False, True])
def test_deep_pages_of_a_crowded_value_tile_the_table(spark, monkeypatch, down):
    """Most rows tie in the sorted column, one is null; pages neither overlap nor leave a row out."""
    monkeypatch.setattr(windows, "DEEP", 50)
    df = spark.range(1000).select(F.when(F.col("id") != 500, F.col("id") % 10 > 0).alias("flag"), "id", F.create_map(F.lit("a"), "id").alias("m")).repartition(4)
    order = [windows.Sort(F.col("flag"), down, nulls_last=True)]
    want = [r["id"] for r in df.orderBy(F.col("flag").desc_nulls_last() if down else F.col("flag").asc_nulls_last(), "id").collect()]
    got = [r["id"] for at in range(0, 1000, 130) for r in windows.first_rows(df, order, 130, at).collect()]
    assert got == want


def test_shallow_pages_take_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, "b", [2]), (1, "a", [3]), (1, "a", [1])], "k int, x string, l array<int>")
    assert [tuple(r) for n in range(3) for r in windows.first_rows(df, ["k"], 1, n).collect()] == [(1, "a", [1]), (1, "a", [3]), (1, "b", [2])]


@pytest.mark.parametrize("spread", [60, 2, 1, 3000])
def test_ranks(events, spread):
    """Few times make groups of ties that reach over several slabs."""
    rows_ = events.withColumn("t", F.col("t") % spread if spread < 3000 else F.col("id"))
    tied = Window.partitionBy("k").orderBy("t")
    expected = rows_.withColumns({
        "row_number": F.row_number().over(plain()).cast("long"), "rank": F.rank().over(tied).cast("long"),
        "dense_rank": F.dense_rank().over(tied).cast("long")})
    assert rows(windows.ranked(rows_, BY, ORDER, ["t"])) == rows(expected)


def test_running_sum(events):
    expected = events.withColumn("s", F.sum("v").over(plain().rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(windows.running_sum(events, BY, ORDER, "v", "s")) == rows(expected)


def test_neighbours(events):
    whole = plain().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    expected = events.select(
        "*", F.lag("v").over(plain()), F.lead("v").over(plain()), F.first("v").over(whole), F.last("v").over(whole))
    assert rows(windows.neighbours(events, BY, ORDER, ["v"])) == rows(expected)


def test_neighbours_keep_null_values(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, "a", None), (4, "b", 1)], "id int, k string, v int")
    out = windows.neighbours(df, ["k"], ["id"], ["v"])
    assert rows(out.select("id", "previous_v", "next_v")) == [(1, None, 5), (2, None, None), (3, 5, None), (4, None, None)]


def test_latest_before_is_strict(spark, events):
    asks = events.select("id", "k", "t")
    given = events.where("v > 700").select("id", "k", "t", "v")
    assert given.where("k IS NULL").count() > 0
    got = latest_before(asks, given, "k", "t", ["id", "v"], "id")
    table = [tuple(r) for r in given.collect()]
    for r in got.collect():
        before = [(t, i, v) for i, k, t, v in table if k is not None and k == r["k"] and t < r["t"]]
        best = max(before) if before else None
        assert (r["previous_id"], r["previous_v"]) == ((best[1], best[2]) if best else (None, None))
    assert got.count() == 3000


def test_interval_join(spark, events):
    bands = spark.createDataFrame([("low", 0.0, 300.0), ("mid", 250.0, 260.0), ("all", 0.0, 1000.0), ("none", 5.0, 5.0)], "band string, lo double, hi double")
    got = interval_join(events, "v", bands, "lo", "hi", 100.0)
    expected = events.join(bands, (F.col("v") >= F.col("lo")) & (F.col("v") < F.col("hi")))
    assert rows(got.select("id", "band")) == rows(expected.select("id", "band"))


def test_left_join_many(spark, events):
    keys = spark.createDataFrame([("hot",), ("k1",), ("nobody",), (None,)], "k string")
    got = left_join_many(keys, events, ["k"])
    assert rows(got.select("k", "id")) == rows(keys.join(events, "k", "left").select("k", "id"))


@pytest.mark.parametrize("n, step", [(0, 10), (1, 10), (1000, 7), (1000, 1000), (1003, 500)])
def test_batch_slices(spark, n, step):
    df = spark.range(n).select((F.col("id") * 7919 % 100003).alias("k"), F.lit("x").alias("c")).repartition(5)
    out = batch_slices(df, ["k"], step).orderBy("k").collect()
    assert [r["sequence"] for r in out] == [i // step + 1 for i in range(n)]
    assert [r["cumulative"] for r in out] == [min((i // step + 1) * step, n) for i in range(n)]


@pytest.mark.parametrize("n, offset", [(100, 0), (100, 950), (5000, 0), (10, 2995), (0, 5)])
def test_deep_heads_equal_shallow_ones(events, monkeypatch, n, offset):
    order = [windows.Sort("v", down=True), "id"]
    shallow = [tuple(r) for r in windows.first_rows(events, order, n, offset).collect()]
    monkeypatch.setattr(windows, "DEEP", -1)
    assert [tuple(r) for r in windows.first_rows(events, order, n, offset).collect()] == shallow


def test_batch_slices_with_a_crowded_first_column(spark):
    df = spark.range(2000).select(F.lit(1).alias("a"), "id").repartition(4)
    out = batch_slices(df, ["a", "id"], 300).groupBy("sequence").count()
    assert rows(out) == sorted([(i, 300) for i in range(1, 7)] + [(7, 200)], key=str)


def test_batch_summary_counts_records_not_requests(spark):
    df = spark.createDataFrame([("b", 1, 5), ("b", 1, 6), ("b", 2, 9), ("c", 1, 1)], "batch_id string, sequence int, at int")
    assert rows(batch_summary(df, started="at", ended="at")) == [("b", 3, 2, 5, 9), ("c", 1, 1, 1, 1)]


def test_running_sum_with_nulls_at_slab_edges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        values = [None if i < 30 or 45 <= i < 62 or i > 90 else i for i in range(100)]
        df = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "k int, o int, v long")
        got = {r["o"]: r["total"] for r in windows.running_sum(df, ["k"], ["o"], "v", "total").collect()}
        seen, want = None, {}
        for i, v in enumerate(values):
            seen = seen if v is None else (seen or 0) + v
            want[i] = seen
        assert got == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_null_time_is_not_earlier(spark):
    from goldspan.operators.joins import latest_before
    asking = spark.createDataFrame([(1, 10, 1)], "k int, t int, i int")
    other = spark.createDataFrame([(1, None, 1), (1, 10, 2)], "k int, t int, i int")
    assert [r["previous_i"] for r in latest_before(asking, other, "k", "t", ["i"], "i").collect()] == [None]


def test_intervals_of_any_width_and_with_open_ends(spark):
    ends = [(0.0, 1.0), (0.5, 900.0), (-3.0, 7.5), (None, 2.0), (40.0, None), (None, None), (5.0, 5.0), (9.0, 8.0), (1.0, 1e9), (16.0, 32.0)]
    values = [-5.0, 0.0, 0.5, 1.0, 2.0, 7.5, 16.0, 31.9, 32.0, 40.0, 900.0, 1e8, None]
    intervals = spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "i int, lo double, hi double")
    rows_ = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v double")
    got = sorted((r["n"], r["i"]) for r in interval_join(rows_, "v", intervals, "lo", "hi", 2.0).collect())
    assert got == [(n, i) for n, v in enumerate(values) for i, (lo, hi) in enumerate(ends)
                   if v is not None and (lo is None or v >= lo) and (hi is None or v < hi)]
    assert interval_join(rows_, "v", intervals.limit(0), "lo", "hi", 2.0).count() == 0


@pytest.mark.parametrize("start, end", [(0, None), (6, None), (-3, None)])
def test_frames_up_to_the_last_row_only_grow(events, eight, start, end):
    """Spark goes through a frame from the row to the last one anew for each row."""
    out = windows.framed(events, BY, ORDER, {"n": ("count", "v")}, start, end)
    plan = out._jdf.queryExecution().analyzed().toString().lower()
    assert "currentrow$(), unboundedfollowing$()" not in plan


def test_many_bounds_make_no_larger_plan(spark, monkeypatch):
    """The bounds are one array: what is compiled is the same for 30 and for 300 slabs."""
    df = spark.range(4000).select(F.lit("k").alias("k"), "id")
    nodes = [windows.with_slab(df, windows.cut_of(df, ["k"], ["id"], n))._jdf.queryExecution().analyzed().toString().lower().count("if ")
             for n in (30, 300)]
    assert nodes[0] == nodes[1] > 0


def test_frames_of_values_are_not_gone_through(events, eight):
    """A frame of values that slides is gone through anew for each value: there is none in the plan."""
    out = windows.framed_by_value(events, BY, "t", {"s": ("sum", "v"), "lo": ("min", "v")}, -20, 0)
    assert "RangeFrame" not in out._jdf.queryExecution().analyzed().toString()
