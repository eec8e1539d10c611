"""Writes: staging intake with accounting, model tables, SQL results, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldspan.jobs import fixtures as fx
from goldspan.jobs.base import Tables, job
from goldspan.operators import intake, sinks
from goldspan.session import workspace
from goldspan.sources.lake import Lake
from goldspan.sources.tables import StepOutputs


@job("snk_staging_write", """SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS day FROM events
     UNION ALL SELECT event_id + 1000000000000, value, strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'view'""")
def _(t: Tables):
    """Two sends to one staging table, the second appended to the first."""
    lake = Lake(t.spark, workspace(t.spark, "intake"))
    events = t.events.select("event_id", "value", "ts", "event_type")
    sinks.write_staging(lake, events, "web", "events", ["event_id"], "ts")
    again = events.where("event_type = 'view'").withColumn("event_id", F.col("event_id") + 1000000000000)
    sinks.write_staging(lake, again, "web", "events", ["event_id"], "ts")
    stored = lake.scan("staging", "web_events", prefix="2024")
    return stored.select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))


@job("snk_send", """
WITH n AS (SELECT event_id, value, event_type = 'error' AS bad, row_number() OVER (ORDER BY event_id) - 1 AS r FROM events)
SELECT CASE WHEN bad THEN 'staging_rejected' ELSE 'staging' END AS space, CAST(floor(r / 250) AS BIGINT) + 1 AS sequence,
       count(*) AS n, round(sum(CASE WHEN NOT bad THEN value END), 2) AS total, max(CASE WHEN bad THEN 'TYPE:value' END) AS error,
       (SELECT count(*) FROM events) AS total_records, CAST(ceil((SELECT count(*) FROM events) / 250.0) AS BIGINT) AS total_requests
FROM n GROUP BY 1, 2""")
def _(t: Tables):
    """Events sent with the values of errors as text, read back from both spaces with the batch's account."""
    lake = Lake(t.spark, workspace(t.spark, "send"))
    value = F.when(F.col("event_type") == "error", "broken").otherwise(F.col("value").cast("string"))
    dirty = t.events.select("event_id", "ts", value.alias("value"))
    account = intake.send(lake, dirty, "web", "events", ["event_id"], "ts", "b1", step_size=250, types={"value": "double"})
    stored = lake.staging("web", "events").groupBy("space", "sequence").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), F.max(F.element_at("mdmErrors", 1)).alias("error"))
    records, requests = account.select("total_records").scalar(), account.select("total_requests").scalar()
    return stored.withColumns({"total_records": records, "total_requests": requests})


@job("snk_batch", """
WITH e AS (SELECT event_id, value, event_type, row_number() OVER (PARTITION BY event_type = 'view' ORDER BY event_id) - 1 AS r FROM events),
n AS (SELECT CAST(ceil(count(*) / 300.0) AS BIGINT) AS first FROM events WHERE event_type <> 'view')
SELECT event_id, CASE WHEN event_type = 'view' THEN event_type END AS kind, value,
  CAST(floor(r / 300) AS BIGINT) + 1 + CASE WHEN event_type = 'view' THEN (SELECT first FROM n) ELSE 0 END AS sequence,
  (SELECT count(*) FROM events) AS total_records,
  (SELECT first FROM n) + CAST(ceil((SELECT count(*) FROM events WHERE event_type = 'view') / 300.0) AS BIGINT) AS total_requests
FROM e""")
def _(t: Tables):
    """One batch of two sends to a table declared by the first: the crosswalk comes from the declaration, the second
    send's own field is added to it as the table is flexible. A batch that never ends adds nothing."""
    lake = Lake(t.spark, workspace(t.spark, "batch"))
    events = t.events.select("event_id", "value", "ts", "event_type")
    batch = intake.Batch(lake, "b1")
    batch.send(events.where("event_type <> 'view'").drop("event_type"), "web", "clicks", "ts", step_size=300,
               auto_create_schema=True, crosswalk_auto_create=["event_id"], flexible_schema=True)
    views = events.where("event_type = 'view'").withColumnRenamed("event_type", "kind").withColumn("value", F.col("value").cast("string"))
    batch.send(views, "web", "clicks", "ts", step_size=300)
    account = batch.end()
    intake.Batch(lake, "b2").send(views, "web", "clicks", "ts")
    records, requests = account.select("total_records").scalar(), account.select("total_requests").scalar()
    return lake.scan("staging", "web_clicks").select("event_id", "kind", "value", "sequence").withColumns(
        {"total_records": records, "total_requests": requests})


@job("snk_model_write", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def _(t: Tables):
    """The first write is replaced by the second, which the third adds to."""
    path = workspace(t.spark, "model")
    customers = t.customer.select("c_custkey", "c_acctbal")
    sinks.write_model(customers, path)
    sinks.write_model(customers.where("c_acctbal >= 0"), path, delete_old_records=True)
    sinks.write_model(t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal")), path)
    return t.spark.read.parquet(path)


SLICES_SQL = """
numbered AS (SELECT event_id, user_id, ts, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 500) AS BIGINT) + 1 AS sequence,
               count(*) OVER () AS total FROM events)"""


@job("snk_batch_slices", f"WITH {SLICES_SQL} SELECT event_id, sequence, least(sequence * 500, total) AS cumulative FROM numbered")
def _(t: Tables):
    return sinks.batch_slices(t.events.select("event_id"), ["event_id"], 500)


@job("snk_batch_summary", f"""WITH {SLICES_SQL} SELECT 'batch-' || (sequence % 3) AS batch_id, count(*) AS total_records,
     count(DISTINCT sequence) AS total_requests, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started,
     strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended FROM numbered GROUP BY 1""")
def _(t: Tables):
    """Requests of 500 records sent in three batches."""
    sliced = sinks.batch_slices(t.events.select("event_id", "ts"), ["event_id"], 500)
    batch = F.concat(F.lit("batch-"), (F.col("sequence") % 3).cast("string"))
    summary = sinks.batch_summary(sliced.withColumn("batch_id", batch), started="ts", ended="ts")
    return summary.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started", "ended")})


@job("snk_process_sql", """SELECT l_returnflag, l_linenumber FROM lineitem GROUP BY ALL
     UNION ALL SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_quantity = 1""")
def _(t: Tables):
    """A result stored with exact duplicates dropped, then another added as it is."""
    spark, path = t.view("lineitem"), workspace(t.spark, "processed")
    sinks.process_sql(spark, "SELECT l_returnflag, l_linenumber FROM lineitem", path, clear_target=True, send_realtime=True)
    return sinks.process_sql(spark, "SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_quantity = 1", path)


@job("snk_jsonl", f"WITH {fx.SPARSE_SQL} SELECT c_custkey, c_mktsegment FROM sparse UNION ALL SELECT s_suppkey, NULL FROM supplier")
def _(t: Tables):
    path = workspace(t.spark, "jsonl")
    sinks.write_json_lines(fx.sparse(t).select("c_custkey", "c_mktsegment"), path)
    sinks.write_json_lines(t.supplier.select(F.col("s_suppkey").alias("c_custkey")), path)
    return t.spark.read.schema("c_custkey long, c_mktsegment string").json(path)


@job("snk_materialise", "SELECT p_brand, count(*) AS n, true AS existed, false AS exists_after FROM part GROUP BY p_brand")
def _(t: Tables):
    outputs = StepOutputs(t.spark, workspace(t.spark, "steps"))
    outputs.save(t.part, "brands")
    outputs.save(t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), "brands")
    outputs.save(t.part, "dropped")
    existed = outputs.exists("dropped")
    outputs.remove("dropped")
    return outputs.load("brands").select(
        "p_brand", "n", F.lit(existed).alias("existed"), F.lit(outputs.exists("dropped")).alias("exists_after"))
