"""Declared staging tables, and batches that show as a whole or not at all."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from goldspan.operators import intake
from goldspan.operators.intake import Batch, Declaration, Declarations
from goldspan.operators.rules import Rule
from goldspan.sources.lake import Lake

from conftest import rows


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder)


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(i, f"n{i}", "2024-05-0" + str(1 + i % 3)) for i in range(25)], "id long, name string, day string")


def test_declarations_have_versions(lake, people):
    tables = Declarations(lake)
    assert tables.get("c", "p") is None
    first = tables.create(people, "c", "p", ["id"])
    assert first == tables.get("c", "p") == Declaration(1, ["id"], {"id": "bigint", "name": "string", "day": "string"}, False)
    with pytest.raises(ValueError, match="declared already"):
        tables.create(people, "c", "p", ["id"])
    second = tables.create({"id": 1, "name": "x", "extra": {"a": [1.5]}}, "c", "p", ["id", "name"], flexible=True, overwrite=True)
    assert second.version == 2 and second.fields["extra"] == "struct<a:array<double>>" and second.fields["day"] == "string"
    assert tables.get("c", "p") == second and tables.get("c", "p", 1) == first and tables.get("c", "p", 9) is None
    assert tables.get("c", "q") is None
    with pytest.raises(ValueError, match="not in the record"):
        tables.create(people, "c", "q", ["nobody"])
    with pytest.raises(TypeError):
        tables.create(people, "c", "q", [3])
    # a version that another sender wrote, or left unfinished, is passed over
    lake.spark.range(0).write.json(f"{lake.root}/declarations/source=c_p/version=3")
    assert tables.create(people, "c", "p", ["id"], overwrite=True).version == 4


def test_the_crosswalk_comes_from_the_declaration(lake, people):
    Declarations(lake).create(people, "c", "p", ["id"])
    assert rows(intake.send(lake, people, "c", "p", None, "day", "b1", step_size=10)) == [("b1", 25, 3)]
    with pytest.raises(ValueError, match="repeats"):
        intake.send(lake, people.union(people), "c", "p", None, "day", "b2")
    assert lake.scan("staging", "c_p").count() == 25
    with pytest.raises(ValueError, match="not declared"):
        intake.send(lake, people, "c", "other", None, "day", "b3")
    assert lake.scan("staging", "c_other") is None


def test_a_strict_table_refuses_fields_and_a_flexible_one_declares_them(lake, people):
    more = people.withColumn("age", F.lit(3))
    Declarations(lake).create(people, "c", "p", ["id"])
    with pytest.raises(ValueError, match="age"):
        intake.send(lake, more, "c", "p", None, "day", "b1")
    Declarations(lake).create(people, "c", "p", ["id"], flexible=True, overwrite=True)
    intake.send(lake, more, "c", "p", None, "day", "b2")
    assert Declarations(lake).get("c", "p").fields["age"] == "int"
    intake.send(lake, people.withColumn("id", F.col("id") + 100), "c", "p", None, "day", "b3")  # a declared field that is missing is null
    out = lake.scan("staging", "c_p")
    assert (out.where("age = 3").count(), out.where("age IS NULL").count()) == (25, 25)


def test_values_are_cast_to_the_declared_types(lake, people):
    Declarations(lake).create(people, "c", "p", ["id"])
    texts = people.withColumn("id", F.when(F.col("id") == 7, F.lit("seven")).otherwise(F.col("id").cast("string")))
    intake.send(lake, texts, "c", "p", None, "day", "b1", rules=[Rule("VALUE_COMPARE", "id", (">", 22))])
    assert dict(lake.scan("staging", "c_p").dtypes)["id"] == "bigint"
    bad = lake.scan("staging_rejected", "c_p")
    assert rows(bad.select("id", "mdmErrors")) == [(23, ["VALUE_COMPARE:id"]), (24, ["VALUE_COMPARE:id"]), (None, ["TYPE:id"])]
    assert "mdmErrors" not in lake.scan("staging", "c_p").columns


def test_auto_create_needs_its_crosswalk(lake, people):
    with pytest.raises(ValueError, match="crosswalk_auto_create"):
        intake.send(lake, people, "c", "p", None, "day", "b", auto_create_schema=True)
    intake.send(lake, people, "c", "p", None, "day", "b", auto_create_schema=True, crosswalk_auto_create=["id", "day"])
    assert Declarations(lake).get("c", "p").crosswalk == ["id", "day"]


def test_a_send_that_dies_leaves_nothing_visible(lake, people, monkeypatch):
    """It dies while it writes the records, and then between the records and the manifest."""
    intake.send(lake, people, "c", "p", ["id"], "day", "b0")
    again = people.withColumn("id", F.col("id") + 50)
    real = {name: getattr(DataFrameWriter, name) for name in ("parquet", "json")}
    for name, where in (("parquet", "/batches/"), ("json", "/manifests/")):
        def broken(self, path, *a, _real=real[name], _where=where, **b):
            if _where in path:
                raise OSError("lost")
            return _real(self, path, *a, **b)
        with monkeypatch.context() as m:
            m.setattr(DataFrameWriter, name, broken)
            with pytest.raises(OSError):
                intake.send(lake, again, "c", "p", ["id"], "day", "b1")
        assert lake.scan("staging", "c_p").count() == 25 and intake.account(lake, "b1") is None
    assert rows(intake.send(lake, again, "c", "p", ["id"], "day", "b1")) == [("b1", 25, 1)]
    assert lake.staging("c", "p").count() == 50
    # a batch that has ended is not sent twice
    assert rows(intake.send(lake, again, "c", "p", ["id"], "day", "b1")) == [("b1", 25, 1)]
    assert lake.staging("c", "p").count() == 50


def test_a_batch_of_several_sends_shows_at_its_end(lake, people):
    batch = Batch(lake, "007")
    batch.send(people, "c", "p", "day", ["id"], step_size=10)
    batch.send(people, "c", "q", "day", ["id"], step_size=10)
    batch.send(people.limit(0), "c", "q", "day", ["id"])
    assert lake.scan("staging", "c_p") is None and lake.scan("staging", "c_q") is None
    assert rows(batch.end()) == [("007", 50, 6)]
    assert rows(lake.scan("staging", "c_q").groupBy("sequence").count()) == [(4, 10), (5, 10), (6, 5)]
    assert lake.scan("staging", "c_p", prefix="2024-05-02").count() == 8
    assert [r["batch_id"] for r in lake.scan("staging", "c_p").select("batch_id").distinct().collect()] == ["007"]
    for call in (batch.end, lambda: batch.send(people, "c", "p", "day", ["id"])):
        with pytest.raises(ValueError, match="ended"):
            call()
    with pytest.raises(ValueError):
        Batch(lake, "a/b")


def test_batches_and_plain_writes_are_one_table(lake, people):
    from goldspan.operators.sinks import write_staging
    write_staging(lake, people, "c", "p", ["id"], "day")
    intake.send(lake, people.withColumn("id", F.col("id") + 50), "c", "p", ["id"], "day", "b1")
    out = lake.scan("staging", "c_p", columns=["id"]) if "mdmId" in people.columns else lake.scan("staging", "c_p")
    assert out.count() == 50 and out.where("batch_id IS NULL").count() == 25
    plan = lake.scan("staging", "c_p", prefix="2024-05-02")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 2


def test_the_input_is_computed_once(lake, people, spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    intake.send(lake, people.mapInPandas(count, people.schema), "c", "p", ["id"], "day", "b1")
    assert seen.value == 25
