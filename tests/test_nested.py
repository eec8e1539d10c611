import json

import pytest
from pyspark.sql import functions as F

from goldspan.operators import modelling as ml
from goldspan.operators import nested as n
from goldspan.session import workspace

from conftest import rows


def brute(node, key):
    if isinstance(node, list):
        return [v for x in node for v in brute(x, key)]
    if isinstance(node, dict):
        return ([node[key]] if key in node else []) + [v for x in node.values() for v in brute(x, key)]
    return []


def deep(levels):
    node = {"k": 0}
    for i in range(levels):
        node = {"a": [node, {"k": i}], "k": {"k": str(i)}}
    return node


DOCUMENTS = [
    {"k": 1}, {"a": {"k": [1, {"k": 2}]}, "k": None}, [], [[{"k": "é"}]], {"kk": 1, "a": "k"}, "text", 5, None, {}, deep(9),
]


def test_find_keys(spark):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(DOCUMENTS)], "id int, d string")
    got = n.find_keys(df, "d", "k", ["id"]).orderBy("id", "position").collect()
    assert [(r["id"], r["position"], json.loads(r["value"])) for r in got] == [
        (i, p, v) for i, d in enumerate(DOCUMENTS) for p, v in enumerate(brute(d, "k"))]


def test_find_keys_with_an_escaped_name(spark):
    df = spark.createDataFrame([(1, '{"\\u006b": 3}'), (2, None)], "id int, d string")
    assert rows(n.find_keys(df, "d", "k", ["id"])) == [(1, 0, "3")]


HARD = [
    {"z": {"k": 1}, "b": [{"y": [], "k": {"q": 1, "k": "in"}}], "a": {"k": -1.5}}, {"k": "{\"k\": 1}"}, {"k": ["[", "{\"k\": 2}", None, True, 1.0]},
    [[[[{"k": [{"k": []}]}]]]], {"k\"": 1, "x": {"k": "\\"}}, {"a.b'c": {"k": "é\n\u0001"}}, {"": {"k": 9007199254740993}}, {"k": 12345678901234567890123456789012345678901234567890},
    {"k": {}}, {"x": "k", "y": ["k"]}, {"k": " "}, {"x": {"x": {"x": {"x": {"x": {"k": {"x": {"k": 3}}}}}}}},
]


def test_find_keys_in_document_order(spark):
    """Keys out of alphabetical order, texts that look like JSON, keys with quotes and dots, great numbers."""
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=i % 2 == 0, indent=i % 3 or None)) for i, d in enumerate(HARD)], "id int, d string")
    got = n.find_keys(df, "d", "k", ["id"]).orderBy("id", "position").collect()
    assert [(r["id"], r["position"], json.loads(r["value"])) for r in got] == [(i, p, v) for i, d in enumerate(HARD) for p, v in enumerate(brute(d, "k"))]
    assert all(r["value"] == json.dumps(json.loads(r["value"]), ensure_ascii=False, separators=(",", ":")) for r in got)


def test_find_keys_leaves_the_jvm_nowhere(spark):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(HARD)], "id int, d string")
    plan = n.find_keys(df, "d", "k", ["id"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_find_keys_when_there_is_nothing(spark):
    df = spark.createDataFrame([(1, None, 2), (2, '{"x": 1}', 3), (3, '{"x": "k"}', 3)], "id int, d string, _node int")
    out = n.find_keys(df, "d", "k", ["id", "_node"])
    assert out.columns == ["id", "_node", "position", "value"] and out.count() == 0
    assert n.find_keys(df.limit(0), "d", "k", ["id"]).count() == 0
    same = spark.createDataFrame([(1, '{"k": [{"k": 1}]}')] * 3, "id int, d string")
    assert rows(n.find_keys(same, "d", "k", ["id"])) == sorted([(1, 0, '[{"k":1}]'), (1, 1, "1")] * 3, key=lambda r: [(False, str(x)) for x in r])


@pytest.mark.parametrize("text", ['{"k": 1} x', '{"k": 1}{"k": 2}', '{"k": 1}, {"k": 2}', '{"k": 1}], [{"k": 2}', "{'k': \"k\"}", '{"k": 1, "k": 2}', '{"x": {"k": 1, "k": 2}}',
                                  '{"k": 01}', '{"k": Infinity}', '{"k": -1E999}', '{"k": 1, "x": ' + "9" * 400 + '}', '{"k": }', '"k" "k"', '\\'])
def test_find_keys_reports(spark, text):
    assert rows(n.find_keys(spark.createDataFrame([(1, text)], "id int, d string"), "d", "k", ["id"])) == [(1, None, None)]


def test_find_keys_takes_texts_that_only_look_long(spark):
    """A string with a great exponent is a string; 1e300 is a number."""
    df = spark.createDataFrame([(1, '{"k": "1e999", "x": "\\"9e999"}'), (2, '{"k": 1e300}'), (3, '{"k": 1e-999}')], "id int, d string")
    assert [json.loads(r["value"]) for r in n.find_keys(df, "d", "k", ["id"]).orderBy("id").collect()] == ["1e999", 1e300, 0.0]


def test_unroll(spark):
    df = spark.createDataFrame([(1, [[[1, 2], []], [[3]]]), (2, []), (3, None)], "id int, v array<array<array<int>>>")
    assert rows(n.unroll_list(df, "v", ["id"])) == [(1, 0, 1), (1, 1, 2), (1, 2, 3)]
    flat = spark.createDataFrame([(1, [4])], "id int, v array<int>")
    assert rows(n.unroll_list(flat, "v", ["id"])) == [(1, 0, 4)]


def test_path_tree(spark):
    df = spark.createDataFrame([("a/b/x",), ("a/b/y",), ("a/z",), ("top",)], "p string")
    assert rows(n.path_tree(df, "p")) == [("a", 3, 1), ("a/b", 2, 2)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(2000).select("id", (F.col("id") % 50).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z")).withColumn(
        "y", F.col("x") * 3 + F.col("z"))


def test_split_is_the_same_for_any_partitioning(points):
    a = ml.split(points, ["id"]).where("is_train")
    b = ml.split(points.repartition(13), ["id"]).where("is_train")
    assert rows(a.select("id")) == rows(b.select("id")) and 1500 < a.count() < 1700


def test_train_score_gate(spark, points):
    rows_ = ml.split(points, ["id"])
    model = ml.train(rows_.where("is_train"), ["x", "z"], "y", max_iter=10)
    scored = ml.score(model, rows_.where("NOT is_train"))
    metrics = ml.residuals(scored, "y")
    m = metrics.first()
    assert m["rmse"] ** 2 == pytest.approx(m["mse"]) and m["mae"] <= m["rmse"] < 10
    assert scored.where(F.round("prediction", 2) != F.col("prediction")).count() == 0
    path = workspace(spark, "model")
    assert not ml.deploy(model, metrics, path, limit=m["rmse"] / 2)
    assert ml.deploy(model, metrics, path, limit=m["rmse"] * 2)


def test_feature_contract(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (None, 3.0, -1.0), (-2.0, -3.0, None)], "a double, b double, c double")
    out = ml.feature_contract(df, ["a"], {"b": 40.0, "c": 0.0})
    assert [(r["b"], r["c"], r["errors"]) for r in out.collect()] == [
        (40.0, 2.0, []), (3.0, -1.0, ["missing:a", "negative:c"]), (-3.0, 0.0, ["negative:a", "negative:b"])]


def test_find_keys_reports_texts_that_are_not_json(spark):
    df = spark.createDataFrame([(1, '{"k": 1'), (2, '{"k": 1e400}'), (3, '{"k": NaN}'), (4, '{"k": 2}'), (5, None), (6, "k")], "id int, d string")
    assert rows(n.find_keys(df, "d", "k", ["id"])) == [(1, None, None), (2, None, None), (3, None, None), (4, 0, "2")]
