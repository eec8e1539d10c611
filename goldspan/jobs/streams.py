"""Streaming jobs run over everything that has arrived (availableNow)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldspan.jobs import fixtures as fx
from goldspan.jobs.base import Tables, job
from goldspan.operators.rules import Rule
from goldspan.operators.sinks import batch_summary
from goldspan.session import workspace
from goldspan.streaming import jobs as streams
from goldspan.streaming.sources import run_available, stream_of, write_batch
from goldspan.streaming.subscription import Subscription

COLUMNS = ["event_id", "user_id", "event_type", "value"]
MIDDLE = "2024-01-16"


def arrivals(t: Tables):
    """(folder, send): ``send('early'|'late')`` lets that half of the events arrive."""
    folder = workspace(t.spark, "arrivals")
    halves = {"early": f"ts < '{MIDDLE}'", "late": f"ts >= '{MIDDLE}'"}
    return folder, lambda half: t.events.where(halves[half]).write.mode("append").parquet(folder)


@job("str_subscription", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables):
    folder, send = arrivals(t)
    sub = Subscription(t.spark, folder, workspace(t.spark, "subscription"), "web", "event")
    for half in ("early", "late"):
        send(half)
        sub.play()
    return sub.delivered().select(*COLUMNS)


@job("str_pause_play", f"SELECT event_id, user_id, event_type, value, ts < TIMESTAMP '{MIDDLE}' AS before_pause FROM events")
def _(t: Tables):
    """Records that arrive while nothing runs are delivered once it runs again."""
    folder, send = arrivals(t)
    root = workspace(t.spark, "subscription")
    send("early")
    Subscription(t.spark, folder, root, "web", "event").play()
    send("late")
    resumed = Subscription(t.spark, folder, root, "web", "event")  # nothing but the checkpoint is kept
    resumed.play()
    delivered = t.spark.read.parquet(f"{resumed.root}/delivered")
    return delivered.select(*COLUMNS, (F.col("batch_id") == 0).alias("before_pause"))


@job("str_clear", f"SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '{MIDDLE}'")
def _(t: Tables):
    folder, send = arrivals(t)
    sub = Subscription(t.spark, folder, workspace(t.spark, "subscription"), "web", "event")
    send("early")
    sub.clear()
    send("late")
    sub.play()
    return sub.delivered().select(*COLUMNS)


@job("str_subscription_info", f"""SELECT count(*) FILTER (ts < TIMESTAMP '{MIDDLE}') AS delivered, CAST(0 AS BIGINT) AS discarded,
     count(*) FILTER (ts >= TIMESTAMP '{MIDDLE}') AS pending FROM events""")
def _(t: Tables):
    folder, send = arrivals(t)
    sub = Subscription(t.spark, folder, workspace(t.spark, "subscription"), "web", "event")
    send("early")
    sub.play()
    send("late")
    return sub.info()


@job("str_bounded", """SELECT 'delivered' AS state, count(*) FILTER (event_id % 5 < 3) AS n_records, CAST(3 AS BIGINT) AS n_batches FROM events
     UNION ALL SELECT 'discarded', count(*) FILTER (event_id % 5 >= 3), CAST(2 AS BIGINT) FROM events""")
def _(t: Tables):
    """Three files come in three batches, two more are passed over in two."""
    folder, root = workspace(t.spark, "arrivals"), workspace(t.spark, "subscription")
    sub = Subscription(t.spark, folder, root, "web", "event", max_files=1)
    for file in range(5):
        # one file a time: the number of files is what this query is about
        t.events.where(F.col("event_id") % 5 == file).repartition(1).write.mode("append").parquet(folder)
        if file == 2:
            sub.play()
    sub.clear()
    return sub.batches().groupBy("state").agg(F.sum("n_records").alias("n_records"), F.count(F.lit(1)).alias("n_batches"))


@job("str_intake", f"""SELECT CASE WHEN ts < TIMESTAMP '{MIDDLE}' THEN 0 ELSE 1 END AS batch_id, count(*) AS total_records,
     count(*) FILTER (value < 2) AS rejected, count(DISTINCT event_type) AS total_requests FROM events GROUP BY 1""")
def _(t: Tables):
    """Two arrivals, each validated, stored and accounted for under its batch id."""
    folder, send = arrivals(t)
    root = workspace(t.spark, "intake")
    rules = [Rule("VALUE_COMPARE", "value", ("<", 2.0))]
    for half in ("early", "late"):
        send(half)
        stored = streams.intake(stream_of(t.spark, folder), rules, root)
    summary = batch_summary(stored, sequence="event_type")
    rejected = stored.groupBy("batch_id").agg(F.count_if(F.size("mdmErrors") > 0).alias("rejected"))
    return summary.join(rejected, "batch_id")


@job("str_merge_latest", f"""WITH {fx.STAGED_SQL} SELECT "mdmId", max("mdmCounterForEntity") AS "mdmCounterForEntity" FROM
     (SELECT *, max("mdmCounterForEntity") OVER (PARTITION BY "mdmId") AS top, bool_or("mdmDeleted") OVER (PARTITION BY "mdmId", "mdmCounterForEntity") AS gone FROM staged)
     WHERE "mdmCounterForEntity" = top AND NOT gone GROUP BY 1""")
def _(t: Tables):
    """Records in two arrivals, compacted in between; each step starts anew and knows nothing but the folder."""
    folder, root = workspace(t.spark, "arrivals"), workspace(t.spark, "latest")
    # equal counters of an id are settled in favour of the deleted record, so the SQL can say the same
    rows = fx.staged(t).select("mdmId", "mdmCounterForEntity", "mdmDeleted", "mdmLastUpdated")
    for late in (False, True):
        after = F.col("mdmLastUpdated") >= F.to_timestamp(F.lit("1998-06-01")).cast("timestamp_ntz")
        rows.where(after if late else ~after).write.mode("append").parquet(folder)
        streams.LatestTable(t.spark, root).feed(stream_of(t.spark, folder))
        if not late:
            streams.LatestTable(t.spark, root).compact()
    return streams.LatestTable(t.spark, root).read().select("mdmId", "mdmCounterForEntity")


@job("str_dedupe", "SELECT event_id, user_id, event_type, value FROM events")
def _(t: Tables):
    """Every event arrives twice; the watermark spans the whole month."""
    events = stream_of(t.spark, t.path("events"))
    twice = events.unionByName(stream_of(t.spark, t.path("events")))
    return streams.dedupe(twice, "event_id", "ts", "60 days", workspace(t.spark, "dedupe")).select(*COLUMNS)


@job("str_date_histogram", """SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS bucket, event_type,
     count(*) AS doc_count FROM events GROUP BY 1, 2""")
def _(t: Tables):
    """Counts that the second arrival goes on adding to."""
    folder, send = arrivals(t)
    root = workspace(t.spark, "histogram")
    for half in ("early", "late"):
        send(half)
        out = streams.date_histogram(stream_of(t.spark, folder), "ts", "6 hours", "60 days", root, ["event_type"])
    return out.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss"))


@job("str_page_callback", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t: Tables):
    """A user's callback on each arriving page: here it stores sums, which then add up."""
    folder, send = arrivals(t)
    root = workspace(t.spark, "pages")

    def callback(page, batch_id):
        sums = page.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        write_batch(sums, f"{root}/sums", batch_id)

    for half in ("early", "late"):
        send(half)
        run_available(stream_of(t.spark, folder), callback, f"{root}/checkpoint")
    stored = t.spark.read.parquet(f"{root}/sums")
    return stored.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))
