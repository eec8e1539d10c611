"""Schemas inferred, checked and enforced over whole tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from goldspan.jobs.base import Tables, job
from goldspan.operators import schema as s
from goldspan.operators.master import duplicate_keys
from goldspan.sources.records import json_column


def order_records(t: Tables):
    """Orders as JSON texts; the amount of urgent orders is written as text, others lack it when small."""
    amount = F.concat_ws(
        ",",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.format_string('"amount":"%s"', F.col("o_totalprice").cast("string")))
        .when(F.col("o_totalprice") >= 20000, F.format_string('"amount":%s', F.col("o_totalprice").cast("string"))),
        F.when(F.col("o_orderstatus") == "P", F.lit('"Open":true')))
    head = F.format_string('"Id":%d,"buyer":{"key":%d},"tags":["%s"]', "o_orderkey", "o_custkey", "o_orderpriority")
    return t.orders.select("o_orderkey", F.concat(F.lit("{"), F.concat_ws(",", head, F.nullif(amount, F.lit(""))), F.lit("}")).alias("record"))


def first_record(t: Tables) -> dict:
    """One sample, as a sender would give it: the record of the smallest key."""
    return json.loads(order_records(t).orderBy("o_orderkey").limit(1).first()["record"])


@job("sch_infer", "SELECT o_orderkey AS \"Id\", o_custkey AS buyer_key, o_orderpriority AS tag FROM orders")
def _(t: Tables):
    """The schema of one record reads every record."""
    schema = s.infer_from_sample(first_record(t))
    parsed = json_column(order_records(t), "record", schema)
    return parsed.select("Id", F.col("buyer.key").alias("buyer_key"), F.col("tags")[0].alias("tag"))


@job("sch_infer_all", """
SELECT 'OBJECT<Id: BIGINT, ' || CASE WHEN bool_or(o_orderstatus = 'P') THEN 'Open: BOOLEAN, ' ELSE '' END
   || 'amount: VARIANT, buyer: OBJECT<key: BIGINT>, tags: ARRAY<STRING>>' AS schema
FROM orders""")
def _(t: Tables):
    return s.infer_json_column(order_records(t), "record")


@job("sch_crosswalk_check", """SELECT l_orderkey, l_linenumber, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def _(t: Tables):
    crosswalk = s.check_crosswalk(t.lineitem.columns, ["l_orderkey", "l_linenumber", "l_partkey"])
    return duplicate_keys(t.lineitem, crosswalk)


FIELD_TREE = [
    {"mdmName": "p_partkey", "mdmMappingDataType": "LONG"},
    {"mdmName": "p_name", "mdmMappingDataType": "DOUBLE"},
    {"mdmName": "p_retailprice", "mdmMappingDataType": "ENUM"},
    {"mdmName": "maker", "mdmMappingDataType": "NESTED", "mdmFields": [
        {"mdmName": "p_brand", "mdmMappingDataType": "STRING"},
        {"mdmName": "p_size", "mdmMappingDataType": "BOOLEAN"}]},
]


@job("sch_model_types", """SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS p_name, p_brand,
     p_size <> 0 AS p_size, 'TYPE:p_name' AS errors FROM part""")
def _(t: Tables):
    """A field tree gives the types, nested ones included; the table is read in them."""
    types = s.model_types(FIELD_TREE)
    flat = {k: v for name, v in types.items() for k, v in (v.items() if isinstance(v, dict) else [(name, v)])}
    typed = s.enforce(t.part.select(*flat), flat)
    return typed.select("p_partkey", "p_name", "p_brand", "p_size", F.array_join("mdmErrors", ";").alias("errors"))


DIRTY_SQL = """
dirty AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
                 CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'view' THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_id
          FROM events)"""


@job("sch_enforce", f"""WITH {DIRTY_SQL} SELECT event_id, TRY_CAST(value AS DOUBLE) AS value, TRY_CAST(user_id AS BIGINT) AS user_id,
     concat_ws(';', CASE WHEN value = 'n/a' THEN 'TYPE:value' END, CASE WHEN user_id LIKE 'x%' THEN 'TYPE:user_id' END) AS errors FROM dirty""")
def _(t: Tables):
    kind = F.col("event_type")
    dirty = t.events.select(
        "event_id", F.when(kind == "error", "n/a").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(kind == "click", F.lit(None)).when(kind == "view", F.concat(F.lit("x"), "user_id"))
         .otherwise(F.col("user_id").cast("string")).alias("user_id"))
    typed = s.enforce(dirty, {"value": "double", "user_id": "long"})
    return typed.select("event_id", "value", "user_id", F.array_join("mdmErrors", ";").alias("errors"))


@job("sch_from_sample", """SELECT o_orderkey AS id, 'id:long:reuse;buyer:nested:refused;tags:nested:refused;amount:double:conflict' AS report FROM orders""")
def _(t: Tables):
    """A sample record against a field catalog; the accepted fields are then read from every record."""
    sample = {k: v for k, v in first_record(t).items() if k in ("Id", "buyer", "tags")} | {"amount": 1.5}
    report = s.model_from_sample(sample, {"id": "LONG", "amount": "STRING"})
    taken = [r["field"] for r in report if r["action"] in ("create", "reuse")]
    parsed = json_column(order_records(t), "record", s.infer_from_sample(sample))
    lowered = parsed.select(*[F.col(c).alias(c.lower()) for c in parsed.columns if c.lower() in taken])
    return lowered.withColumn("report", F.lit(";".join(f"{r['field']}:{r['type']}:{r['action']}" for r in report)))


@job("sch_compat", """
SELECT 'Id' AS field, 'BIGINT' AS actual_type, 'BIGINT' AS declared_type, 'same' AS status
UNION ALL SELECT 'buyer', 'OBJECT<key: BIGINT>', 'STRING', 'conflict'
UNION ALL SELECT 'tags', 'ARRAY<STRING>', NULL, 'extra'
UNION ALL SELECT 'Open', 'BOOLEAN', 'BOOLEAN', 'same' WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'amount', 'VARIANT', 'STRING', 'conflict'
UNION ALL SELECT 'shipped', NULL, 'TIMESTAMP', 'missing'""")
def _(t: Tables):
    """Fields seen in any record of a JSON table against the declared ones; a field of two types is a VARIANT."""
    order_records(t).createOrReplaceTempView("order_records")
    seen = t.spark.sql("""SELECT key AS field, schema_of_variant_agg(value) AS type
                          FROM order_records, LATERAL variant_explode(parse_json(record)) GROUP BY key""")
    declared = t.spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(k).alias("type")) for f, k in [
            ("Id", "BIGINT"), ("buyer", "STRING"), ("Open", "BOOLEAN"), ("amount", "STRING"), ("shipped", "TIMESTAMP")]])))
    return s.compare_fields(seen, declared)
