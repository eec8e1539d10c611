import random

import pytest
from pyspark.sql import functions as F

from goldspan.functions import taxid
from goldspan.operators import envelope, opslog
from goldspan.operators import master as m
from goldspan.operators.rules import LOOKUPS, RULES, Rule, errors_of, fires
from goldspan.plans.filters import Predicate, Search, has_type
from goldspan.names import GOLDEN_METADATA, GOLDEN_TIE_BREAK, REJECTED_COLUMNS, STAGING_METADATA

from conftest import rows


def verdicts(spark, values, rule, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, f {kind}")
    return [r["x"] for r in df.select("id", fires(rule).alias("x")).orderBy("id").collect()]


@pytest.mark.parametrize("rule, values, expected", [
    (Rule("CONTAINS", "f", ("b",)), ["abc", "ac", None], [True, False, False]),
    (Rule("CONTAINS_ARRAY", "f", (["x", "c"],)), ["abc", "ab", None], [True, False, False]),
    (Rule("CONTAINS_ARRAY", "f", ([],)), ["abc"], [False]),
    (Rule("STARTS_WITH", "f", ("a",)), ["abc", "ba", None], [True, False, False]),
    (Rule("ENDS_WITH", "f", ("c",)), ["abc", "ca", None], [True, False, False]),
    (Rule("EQUALS", "f", ("a",)), ["a", "A", None], [True, False, False]),
    (Rule("MATCHES", "f", ("^[0-9]+$",), negate=True), ["12", "1x", None], [False, True, False]),
    (Rule("IS_EMPTY", "f"), ["", "  ", "x", None], [True, True, False, True]),
    (Rule("IS_EMAIL", "f"), ["a@b.co", "a@b", "a b@c.de", None], [True, False, False, False]),
    (Rule("LENGTH_COMPARE", "f", (">=", 3)), ["abc", "ab", None], [True, False, False]),
    (Rule("LENGTH_RANGE", "f", (2, 3)), ["a", "ab", "abc", "abcd", None], [True, False, False, True, False]),
    (Rule("IS_NOT_NUMBER_ONLY", "f"), ["123", "12a", "", None], [False, True, True, False]),
    (Rule("VALUE_COMPARE", "f", ("<", "b")), ["a", "b", None], [True, False, False]),
    (Rule("IS_INVALID_BRAZIL_TAX_ID", "f"),
     ["529.982.247-25", "52998224724", "11.222.333/0001-81", "11222333000182", "123", None],
     [False, True, False, True, True, False]),
])
def test_rules(spark, rule, values, expected):
    assert verdicts(spark, values, rule) == expected


def test_every_rule_has_a_test_or_a_lookup():
    assert len(RULES) + len(LOOKUPS) == 17


def python_digits(base, weights):
    rest = sum(int(d) * w for d, w in zip(base, weights)) % 11
    return 0 if rest < 2 else 11 - rest


def test_check_digits_against_brute_force(spark):
    numbers, rng = [], random.Random(3)
    for length, weights in ((9, taxid.PERSON_WEIGHTS), (12, taxid.COMPANY_WEIGHTS)):
        for _ in range(200):
            base = "".join(str(rng.randrange(10)) for _ in range(length))
            first = base + str(python_digits(base, weights[0]))
            right = first + str(python_digits(first, weights[1]))
            numbers += [(right, True), (first + str((int(right[-1]) + 1) % 10), False)]
    df = spark.createDataFrame(numbers, "n string, ok boolean")
    assert df.where(taxid.tax_id_ok(F.col("n")) != F.col("ok")).count() == 0


def test_state_lengths(spark):
    df = spark.createDataFrame([("12345678", "BA"), ("123456789", "ba"), ("1234567", "BA"), ("123", "ZZ"), (None, "SP")], "r string, s string")
    rule = Rule("IS_INVALID_BRAZIL_STATE_TAX_ID", "r", ("s",))
    assert [r[0] for r in df.select(fires(rule)).collect()] == [False, False, True, True, False]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "y"), (4, "a", "y")], "id int, k string, l string")
    table = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "y"), ("c", "y")], "k string, l string")
    rules = [Rule("LOOKUP", "k", table=table), Rule("LOOKUP_FOUND", "k", table=table),
             Rule("LOOKUP_MULTIPLE", ("k", "l"), table=table)]
    out = errors_of(df, rules)
    assert out.columns == ["id", "k", "l", "mdmErrors"]
    assert {r["id"]: r["mdmErrors"] for r in out.collect()} == {
        1: ["LOOKUP_FOUND:k"], 2: ["LOOKUP:k", "LOOKUP_MULTIPLE:k+l"], 3: ["LOOKUP:k", "LOOKUP_MULTIPLE:k+l"],
        4: ["LOOKUP_FOUND:k", "LOOKUP_MULTIPLE:k+l"]}


def test_golden_and_rejected_share_out_the_records(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else str(i)) for i in range(40)], "id int, f string")
    rules = [Rule("IS_EMPTY", "f"), Rule("CONTAINS", "f", ("3",), label="has a three")]
    threes = sum(1 for i in range(40) if i % 4 and "3" in str(i))
    golden, rejected = m.validate(df, rules)
    assert golden.count() + rejected.count() == 40 and golden.columns == ["id", "f"]
    assert {r["error"]: r["n"] for r in m.reject_report(rejected).collect()} == {"IS_EMPTY:f": 10, "has a three": threes}
    accepted, left = m.reprocess(rejected, rules[:1], delete_records=True)
    assert (accepted.count(), left.count()) == (threes, 10)
    accepted, left = m.reprocess(rejected, rules[:1])
    assert (accepted.count(), left.count()) == (threes, 10 + threes)


def test_no_rules_reject_nothing(spark):
    golden, rejected = m.validate(spark.range(3), [])
    assert (golden.count(), rejected.count()) == (3, 0)


VERSIONS = "mdmId string, mdmCounterForEntity long, mdmDeleted boolean, v int"


def test_merge_takes_the_latest_and_then_drops_the_deleted(spark):
    df = spark.createDataFrame([
        ("a", 1, False, 10), ("a", 3, False, 30), ("a", 2, True, 20),   # a deletion that was overtaken
        ("b", 1, False, 1), ("b", 2, True, 2),                          # deleted last
        ("c", 5, None, 1), ("c", 5, None, 7),                           # a tie: the greater row
    ], VERSIONS)
    assert rows(m.merge_latest(df)) == [("a", 3, False, 30), ("c", 5, None, 7)]
    assert rows(m.merge_latest(df, deleted=None).select("mdmId")) == [("a",), ("b",), ("c",)]


def test_merge_does_not_depend_on_arrival(spark):
    rng = random.Random(5)
    data = [(f"k{rng.randrange(20)}", rng.randrange(5), rng.random() < 0.3, rng.randrange(100)) for _ in range(500)]
    # one id holds a third of the records
    data += [("hot", rng.randrange(5), False, rng.randrange(100)) for _ in range(250)]
    expected = {}
    for k, c, d, v in data:
        expected[k] = max(expected.get(k, (-1,)), (c, d, v))
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        got = {r["mdmId"]: (r["mdmCounterForEntity"], r["mdmDeleted"], r["v"])
               for r in m.merge_latest(spark.createDataFrame(data, VERSIONS)).collect()}
        assert got == {k: x for k, x in expected.items() if not x[1]}


def test_merge_sorts_only_what_ties(spark):
    """No sorted aggregate; nulls among ids, counters and columns; a hot id whose records all tie."""
    rng = random.Random(8)
    data = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2, 3]), None, rng.choice([None, 1, 2])) for _ in range(300)]
    data += [("hot", 7, False, i % 50) for i in range(400)] + [("lone", None, False, 3), ("lone", None, False, 4)]
    df = spark.createDataFrame(data, VERSIONS)
    low = lambda x: (x is not None, x)
    expected = {}
    for k, c, d, v in data:
        if k not in expected or (low(c), low(d), low(v)) > tuple(map(low, expected[k])):
            expected[k] = (c, d, v)
    out = m.merge_latest(df)
    assert {r["mdmId"]: tuple(r)[1:] for r in out.collect()} == expected and out.count() == len(expected)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ShuffledHashJoin" in plan


def test_a_narrow_merge_finds_the_same_and_sends_records_once(spark):
    """Nulls among ids, counters and columns, ties, a hot id; each task reduces an id's records before they are sent."""
    rng = random.Random(9)
    data = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2, 3]), rng.choice([None, True, False]), rng.choice([None, 1, 2])) for _ in range(300)]
    data += [("hot", i % 9, False, i % 50) for i in range(400)] + [("lone", None, False, 3), ("lone", None, False, 4)]
    df = spark.createDataFrame(data, VERSIONS)
    for deleted in (None, "mdmDeleted"):
        assert rows(m.merge_narrow(df, deleted=deleted)) == rows(m.merge_latest(df, deleted=deleted))
    plan = m.merge_narrow(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Partial" in plan
    ids = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "mdmId string, mdmCounterForEntity long")
    assert rows(m.merge_narrow(ids, deleted=None)) == [("a", 1), ("b", 2)]
    maps = spark.createDataFrame([("a", 1, False, {"s": "1"}), ("a", 1, False, {"s": "2"})], "mdmId string, n long, mdmDeleted boolean, x map<string,string>")
    assert [r["x"] for r in m.merge_narrow(maps, counter="n").collect()] == [{"s": "2"}]


def test_merge_of_ids_alone(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "mdmId string, mdmCounterForEntity long")
    assert rows(m.merge_latest(df, deleted=None)) == [("a", 1), ("b", 2)]


def test_merge_carries_maps(spark):
    df = spark.createDataFrame([("a", 1, False, {"s": ["1"]}), ("a", 2, False, {"s": ["2"]})],
                               "mdmId string, mdmStagingCounter long, mdmDeleted boolean, mdmCrosswalk map<string,array<string>>")
    assert [tuple(r) for r in m.merge_latest(df, counter=GOLDEN_TIE_BREAK).collect()] == [("a", 2, False, {"s": ["2"]})]


def test_duplicate_crosswalk(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "x int, y string")
    assert rows(m.duplicate_keys(df, ["x", "y"])) == [(1, "a", 2)]
    with pytest.raises(ValueError, match="force"):
        m.check_crosswalk_unique(df, ["x"])
    assert m.check_crosswalk_unique(df, ["x"], force=True).count() == 3


def test_connectors(spark):
    df = spark.createDataFrame([("c1", "s"), ("c2", "s"), ("c1", "s"), ("c1", "t")], "connector string, staging string")
    assert rows(m.staging_to_connectors(df, "connector", "staging")) == [("s", ["c1", "c2"]), ("t", ["c1"])]
    assert rows(m.connectors_of_staging(df, "connector", "staging", "t")) == [("c1",)]  # one match is still a list
    assert [r[0] for r in m.stagings_of_connector(df, "connector", "staging", "c1").collect()] == ["s", "t"]
    with pytest.raises(ValueError):
        m.connectors_of_staging(df, "connector", "staging", "nope")


def test_prefix(spark):
    df = spark.createDataFrame([(1, "s")], "connector_id int, staging string")
    names = spark.createDataFrame([(1, "crm")], "connector_id int, connector_name string")
    got = [m.prefixed_staging(df, names, p).first()["qualified"] for p in (None, "connector_name", "connector_id")]
    assert got == ["s", "crm_s", "1_s"]
    unknown = spark.createDataFrame([(9, "s"), (None, "s")], "connector_id int, staging string")
    assert rows(m.prefixed_staging(unknown, names, "connector_name").select("qualified")) == [(None,), (None,)]
    with pytest.raises(ValueError):
        m.prefixed_staging(df, names, "tenant")


def test_envelopes(spark):
    df = spark.createDataFrame([(1, "a", 7, "2020-01-01")], "k int, name string, seq int, at string")
    staged = envelope.staging_records(df, "c", "s", ["k"], "seq", "at")
    assert staged.columns == [*STAGING_METADATA, *df.columns]
    golden = envelope.golden_records(staged, "m", "t", "s", ["k"], ["k", "name"])
    assert golden.columns == [*GOLDEN_METADATA, "mdmGoldenFieldAndValues"]
    row = golden.first()
    assert (row["mdmId"], row["mdmEntityType"], row["mdmCrosswalk"], row["mdmStagingCounter"]) == ("c_s-1", "mGolden", {"s": ["1"]}, 7)
    rejected = envelope.rejected_records(errors_of(staged, [Rule("EQUALS", "name", ("a",))]), "m", "t", "s", ["k"], ["k", "name"])
    assert rejected.columns == REJECTED_COLUMNS and rejected.first()["mdmErrors"] == ["EQUALS:name"]


def test_log_levels(spark):
    df = spark.createDataFrame([("DEBUG",), ("info",), ("WARNING",), ("WARN",), ("FATAL",), ("CRITICAL",), ("odd",), (None,)], "level string")
    assert rows(opslog.at_least_level(df, "level", "WARNING")) == [("ERROR",), ("ERROR",), ("WARN",), ("WARN",)]
    assert opslog.at_least_level(df, "level", "DEBUG").count() == 6


def test_task_rollup(spark):
    df = spark.createDataFrame(
        [("a", 1, "FAILED"), ("a", 2, "COMPLETED"), ("b", 1, "FAILED"), ("b", 2, "CANCELED"), ("c", 1, "RUNNING")],
        "task string, at int, status string")
    out = opslog.task_rollup(df, "task", "status", "at", retry_count=1)
    assert rows(out) == [("a", "COMPLETED", 1, False, True), ("b", "CANCELED", 2, True, True), ("c", "RUNNING", 0, False, False)]
    assert rows(opslog.all_done(out)) == [(3, 1, 1, False)]
    assert rows(opslog.all_done(out.where("task <> 'c'"))) == [(2, 1, 1, True)]


@pytest.mark.parametrize("record_type, picked", [("ALL", {1, 2, 3, 11, 12}), ("Golden", {1, 2, 3}), ("Rejected", {11, 12})])
def test_reprocess_a_model(spark, record_type, picked):
    golden = spark.createDataFrame([(1, 5), (2, 50), (3, None), (4, 50)], "id int, v int")
    rejected = spark.createDataFrame([(11, 5, ["OLD:v"]), (12, 60, ["OLD:v"]), (13, 5, ["OLD:v"])], "id int, v int, mdmErrors array<string>")
    tables = {"mGolden": golden, "mRejected": rejected, "lists": spark.createDataFrame([(1,), (2,), (3,), (11,), (12,)], "k int")}
    rules = [Rule("VALUE_COMPARE", "v", (">", 10))]
    wanted = Search(must=[Predicate("TERMS_FILTER", "id", values_field="k", values_query=Search(must=[has_type("lists")]))])
    out = m.reprocess_model(tables, "m", rules, "move", record_type, wanted)
    values = {1: 5, 2: 50, 3: None, 4: 50, 11: 5, 12: 60, 13: 5}
    bad = {i for i in picked if (values[i] or 0) > 10}
    assert {r["id"]: r["record_type"] for r in out.accepted.collect()} == {i: "Golden" if i < 10 else "Rejected" for i in picked - bad}
    assert {r["id"]: r["mdmErrors"] for r in out.failed.collect()} == {i: ["VALUE_COMPARE:v"] for i in bad}
    assert out.golden.columns == ["id", "v"] and {r["id"] for r in out.golden.collect()} == ({1, 2, 3, 4} - picked) | (picked - bad)
    after = {r["id"]: r["mdmErrors"] for r in out.rejected.collect()}
    assert after == {**{i: ["OLD:v"] for i in {11, 12, 13} - picked}, **{i: ["VALUE_COMPARE:v"] for i in bad}}
    copied = m.reprocess_model(tables, "m", rules, "copy", record_type, wanted)
    assert {r["id"] for r in copied.accepted.collect()} == picked - bad and {r["id"] for r in copied.failed.collect()} == bad
    assert rows(copied.golden) == rows(golden) and rows(copied.rejected) == rows(rejected)
    with pytest.raises(ValueError):
        m.reprocess_model(tables, "m", rules, "swap")
    everything = m.reprocess_model(tables, "m", [], record_type="ALL")
    assert everything.golden.count() == 7 and everything.rejected.count() == 0
