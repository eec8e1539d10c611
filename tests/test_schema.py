import datetime
import decimal

import numpy as np
import pytest

from goldspan.operators import schema as s
from goldspan.sources.records import empty_typed, json_column, records_frame

from conftest import rows

TWEET = {
    "id": 1043, "created_at": "2018-09-21", "text": "hello", "geo": None, "sentiment_score": 0.12,
    "coins_mentioned": ["EOS", "ETH"],
    "user": {"id": 8, "screen_name": "ana", "verified": True, "url": None},
    "entities": {"hashtags": [], "symbols": [{"text": "EOS", "indices": [3, 7]}]},
}


def test_nested_sample():
    schema = s.infer_from_sample(TWEET)
    assert schema.simpleString() == (
        "struct<id:bigint,created_at:string,text:string,geo:string,sentiment_score:double,coins_mentioned:array<string>,"
        "user:struct<id:bigint,screen_name:string,verified:boolean,url:string>,"
        "entities:struct<hashtags:array<string>,symbols:array<struct<text:string,indices:array<bigint>>>>>")
    assert s.staging_schema(TWEET, "tweet", ["id"])["mdmCrosswalkTemplate"] == {"mdmCrossreference": {"tweet": ["id"]}}


@pytest.mark.parametrize("value, kind", [
    (True, "boolean"), (np.bool_(False), "boolean"), (1, "bigint"), (np.int32(1), "bigint"), (np.float32(1), "double"),
    (datetime.datetime(2020, 1, 1), "timestamp"), ([1, "a"], "array<string>"), ([], "array<string>"), ([[1]], "array<array<bigint>>"),
])
def test_types(value, kind):
    assert s.infer_from_sample({"v": value})["v"].dataType.simpleString() == kind


def test_unknown_type_is_an_error():
    with pytest.raises(TypeError):
        s.infer_from_sample({"v": decimal.Decimal(1)})


def test_crosswalk():
    assert s.check_crosswalk(["a", "b"], ["b"]) == ["b"]
    with pytest.raises(ValueError):
        s.check_crosswalk(["a"], ["z"])
    with pytest.raises(TypeError):
        s.check_crosswalk(["a"], [1])


def test_drift_shows_only_in_the_whole_column(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b": "x"}',), ('{"a": 1.5}',), ("broken",), (None,)], "j string")
    text = s.infer_json_column(df, "j").first()["schema"]
    assert "a: DECIMAL" in text or "a: DOUBLE" in text
    assert "b: STRING" in text


def test_model_types():
    tree = [{"mdmName": "a", "mdmMappingDataType": "LONG"},
            {"mdmName": "n", "mdmMappingDataType": "nested", "mdmFields": [
                {"mdmName": "o", "mdmMappingDataType": "OBJECT", "mdmFields": [{"mdmName": "x", "mdmMappingDataType": "date"}]}]}]
    assert s.model_types(tree) == {"a": "long", "n": {"o": {"x": "date"}}}


def test_enforce_reports_bad_values_only(spark):
    df = spark.createDataFrame([("1", "2020-01-02", "old"), ("x", None, None), (None, "never", None)], "n string, d string, mdmErrors string")
    df = df.selectExpr("n", "d", "CASE WHEN mdmErrors IS NULL THEN array() ELSE array(mdmErrors) END AS mdmErrors")
    out = s.enforce(df, {"n": "long", "d": "date", "extra": "double"})
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "timestamp", "double", "array<string>"]
    assert [r["mdmErrors"] for r in out.collect()] == [["old"], ["TYPE:n"], ["TYPE:d"]]


def test_model_from_sample():
    report = s.model_from_sample({"Name": "x", "Age": 3, "Tags": ["a"], "When": datetime.datetime(2020, 1, 1), "o": {"a": 1}},
                                 {"age": "STRING", "name": "STRING"})
    assert [(r["field"], r["action"]) for r in report] == [
        ("name", "reuse"), ("age", "conflict"), ("tags", "refused"), ("when", "create"), ("o", "refused")]
    assert s.model_from_sample({"age": 3}, {"age": "STRING"}, ignore_field_type=True)[0]["action"] == "reuse"


def test_compare_fields(spark):
    actual = spark.createDataFrame([("a", "long"), ("b", "string"), ("c", "long")], "field string, type string")
    declared = spark.createDataFrame([("a", "long"), ("b", "long"), ("d", "long")], "field string, type string")
    assert {r["field"]: r["status"] for r in s.compare_fields(actual, declared).collect()} == {
        "a": "same", "b": "conflict", "c": "extra", "d": "missing"}


def test_declared_fields():
    assert ("user.verified", "boolean") in s.declared_fields(s.infer_from_sample(TWEET))
    assert ("entities.symbols.text", "string") in s.declared_fields(s.infer_from_sample(TWEET))


def test_record_forms(spark):
    import json

    import pandas as pd
    one = {"a": 1, "b": [{"c": 1.5}], "d": None}
    frames = [records_frame(spark, f) for f in (json.dumps(one), json.dumps([one]), one, [one, {"a": 2}])]
    assert {f.schema.simpleString() for f in frames} == {"struct<a:bigint,b:array<struct<c:double>>,d:string>"}
    assert [f.count() for f in frames] == [1, 1, 1, 2]
    assert records_frame(spark, pd.DataFrame({"a": [1, 2]})).count() == 2
    assert records_frame(spark, frames[0]) is frames[0]
    assert records_frame(spark, [], "a long").count() == 0


def test_empty_typed(spark):
    out = empty_typed(spark, {"a": "LONG", "n": "NESTED", "g": "geopoint", "when": "DATE", "o": "object"})
    assert out.schema.simpleString() == "struct<a:bigint,n:string,g:struct<lat:double,lon:double>,when:timestamp,o:string>"
    assert rows(out) == []


def test_json_column(spark):
    df = spark.createDataFrame([('{"a": 1}',)], "j string")
    assert rows(json_column(df, "j", "a long, b string")) == [(1, None)]
