import datetime

import pytest
from pyspark.sql import functions as F

from goldspan.operators.rules import Rule
from goldspan.session import path_exists, workspace
from goldspan.sources.manifest import Manifest
from goldspan.streaming import jobs
from goldspan.streaming.sources import run_available, stream_of, write_batch
from goldspan.streaming.subscription import Subscription

from conftest import SMALL, rows


def send(spark, folder, data, schema="id int, v int"):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def test_subscription(spark, folder):
    root = workspace(spark, "sub")
    send(spark, folder, [(1, 1), (2, 2)])
    sub = Subscription(spark, folder, root, "c", "m")
    assert rows(sub.info()) == [(0, 0, 2)]
    sub.play()
    assert rows(sub.delivered()) == [(1, 1), (2, 2)] and rows(sub.info()) == [(2, 0, 0)]
    sub.play()  # nothing new, nothing twice
    assert sub.delivered().count() == 2
    send(spark, folder, [(3, 3)])
    assert rows(sub.info()) == [(2, 0, 1)]
    Subscription(spark, folder, root, "c", "m").clear()
    assert rows(sub.info()) == [(2, 1, 0)]
    send(spark, folder, [(4, 4)])
    sub.play()
    assert rows(sub.delivered()) == [(1, 1), (2, 2), (4, 4)] and rows(sub.info()) == [(3, 1, 0)]
    other = Subscription(spark, folder, root, "c2", "m")
    other.play()
    assert other.delivered().count() == 4


def test_a_failed_delivery_is_repeated_whole(spark, folder):
    root = workspace(spark, "sub")
    send(spark, folder, [(1, 1), (2, 2)])
    sub = Subscription(spark, folder, root, "c", "m")
    seen = []

    def broken(batch, batch_id):
        write_batch(batch, f"{sub.root}/delivered", batch_id)
        seen.append(batch_id)
        raise RuntimeError("down")

    with pytest.raises(Exception):
        sub.play(broken)
    sub.play()
    assert seen == [0] and rows(sub.delivered()) == [(1, 1), (2, 2)] and rows(sub.info()) == [(2, 0, 0)]


VERSIONS = "mdmId string, mdmCounterForEntity long, mdmDeleted boolean"


def test_latest_table(spark, folder):
    """Every step starts anew and knows nothing but the folder."""
    root = workspace(spark, "latest")
    table = lambda: jobs.LatestTable(spark, root)
    with pytest.raises(ValueError, match="not been fed"):
        table().read()
    send(spark, folder, [("a", 1, False), ("a", 2, False), ("b", 1, False), ("c", 9, True)], VERSIONS)
    table().feed(stream_of(spark, folder))
    assert rows(table().read()) == [("a", 2, False), ("b", 1, False)]
    send(spark, folder, [("a", 1, False), ("b", 2, True), ("c", 3, False), ("d", 1, False)], VERSIONS)
    table().feed(stream_of(spark, folder))
    assert rows(table().read()) == [("a", 2, False), ("d", 1, False)]  # a late version of c does not bring it back
    before = table().read()
    table().compact()
    assert rows(table().read()) == rows(before) == [("a", 2, False), ("d", 1, False)]  # also for a reader that has begun
    assert table().state()["deltas"] == [] and table().state()["last"] == 1
    send(spark, folder, [("c", 10, False)], VERSIONS)
    table().feed(stream_of(spark, folder))
    assert len(table().state()["deltas"]) == 1
    want = [("a", 2, False), ("c", 10, False), ("d", 1, False)]
    assert rows(table().read()) == want
    table().compact()
    assert rows(table().read()) == want


def test_a_latest_table_sends_its_records_once(spark, folder):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, False), ("b", 1, True)], "mdmId string, mdmCounterForEntity long, mdmDeleted boolean")
    df.write.parquet(folder)
    table = jobs.LatestTable(spark, f"{folder}-latest")
    table.feed(stream_of(spark, folder))
    out = table.read()
    assert [tuple(r) for r in out.collect()] == [("a", 2, False)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def files(spark, root):
    return sorted({"/" + "/".join(f.split("/")[-3:-1]) 
                   for kind in ("bases", "deltas") if path_exists(spark, f"{root}/{kind}") for f in spark.read.parquet(f"{root}/{kind}/*").inputFiles()})


def test_compaction_removes_what_it_covers(spark, folder):
    root = workspace(spark, "latest")
    table = jobs.LatestTable(spark, root)
    for i in range(6):
        send(spark, folder, [(f"k{i}", 1, False), ("all", i, False)], VERSIONS)
        table.feed(stream_of(spark, folder))
        if i % 2:
            table.compact()
    state = table.state()
    assert state["deltas"] == [] and state["last"] == 5 and table.read().count() == 7
    # the base, and what the state before the last compaction consisted of: a base and two deltas
    assert len(files(spark, root)) == 4 and f"/{state['base']}" in files(spark, root)
    assert len(table.manifest.versions()) == 2


def test_a_delta_that_was_not_published_is_not_read(spark, folder, monkeypatch):
    """The batch dies behind its delta; it is replayed, and a replay of a batch that is in adds nothing."""
    root = workspace(spark, "latest")
    table = jobs.LatestTable(spark, root)
    send(spark, folder, [("a", 1, False)], VERSIONS)
    table.feed(stream_of(spark, folder))
    send(spark, folder, [("a", 2, False), ("b", 1, False)], VERSIONS)
    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", lambda self, change: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception):
            table.feed(stream_of(spark, folder))
    assert rows(table.read()) == [("a", 1, False)] and len(files(spark, root)) == 2
    table.feed(stream_of(spark, folder))
    assert rows(table.read()) == [("a", 2, False), ("b", 1, False)]
    published = table.state()
    with monkeypatch.context() as m:  # a batch that ended but whose end the checkpoint does not know
        m.setattr(jobs, "run_available", lambda stream, each, *a: each(spark.createDataFrame([("z", 9, False)], VERSIONS), published["last"]))
        table.feed(None)
    assert table.state() == published


def test_two_writers_of_a_version(spark, folder, monkeypatch):
    """A batch arrives while the table is compacted: neither is lost. A version that was begun and never ended is replaced."""
    root = workspace(spark, "latest")
    table = jobs.LatestTable(spark, root)
    send(spark, folder, [("a", 1, False)], VERSIONS)
    table.feed(stream_of(spark, folder))
    plain_merge = jobs.merge_latest

    def slow(df, *a, **b):
        monkeypatch.setattr(jobs, "merge_latest", plain_merge)
        send(spark, folder, [("b", 1, False)], VERSIONS)
        jobs.LatestTable(spark, root).feed(stream_of(spark, folder))
        return plain_merge(df, *a, **b)

    monkeypatch.setattr(jobs, "merge_latest", slow)
    table.compact()
    assert rows(table.read()) == [("a", 1, False), ("b", 1, False)] and len(table.state()["deltas"]) == 1
    spark.range(0).write.json(f"{root}/manifests/version={table.manifest.latest()[0] + 1}")
    table.compact()
    assert table.state()["deltas"] == [] and rows(table.read()) == [("a", 1, False), ("b", 1, False)]


def test_three_files_come_in_three_batches(spark, folder):
    root = workspace(spark, "sub")
    for i in range(3):
        send(spark, folder, [(i, i)] * (i + 1))
    seen = []
    sub = Subscription(spark, folder, root, "c", "m", max_files=1)
    sub.play(lambda batch, i: seen.append((i, batch.count())))
    assert [i for i, _ in seen] == [0, 1, 2] and sorted(n for _, n in seen) == [1, 2, 3]
    assert rows(sub.batches().select("n_records", "state")) == [(1, "delivered"), (2, "delivered"), (3, "delivered")]
    small = Subscription(spark, folder, root, "c2", "m", max_bytes=1)
    small.play()
    assert small.batches().count() == 3 and small.delivered().count() == 6
    with pytest.raises(ValueError):
        stream_of(spark, folder, max_files=1, max_bytes=1 << 30)


def test_a_delivery_that_dies_in_the_middle_goes_on_there(spark, folder):
    root = workspace(spark, "sub")
    for i in range(4):
        send(spark, folder, [(i, i)])
    seen = []

    def callback(batch, i):
        if len(seen) == 2:
            seen.append(None)
            raise RuntimeError("down")
        seen.extend(r["id"] for r in batch.collect())

    sub = Subscription(spark, folder, root, "c", "m", max_files=1)
    with pytest.raises(Exception):
        sub.play(callback)
    sub.play(callback)
    assert sorted(x for x in seen if x is not None) == [0, 1, 2, 3] and rows(sub.info()) == [(4, 0, 0)]


def test_clear_reads_no_column(spark, folder, monkeypatch):
    from goldspan.streaming import subscription
    for i in range(3):
        send(spark, folder, [(i, i)] * 2)
    queries = []
    run = subscription.run_available
    monkeypatch.setattr(subscription, "run_available", lambda *a: queries.append(run(*a)))
    sub = Subscription(spark, folder, workspace(spark, "sub"), "c", "m", max_files=2)
    sub.clear()
    assert rows(sub.info()) == [(0, 6, 0)] and sub.batches().count() == 2
    plan = queries[0]._jsq.explainInternal(False)
    assert "ReadSchema: struct<>" in plan
    send(spark, folder, [(9, 9)])
    sub.play()
    assert rows(sub.delivered()) == [(9, 9)]


def test_a_replayed_batch_replaces_itself(spark, folder):
    df = spark.createDataFrame([(1,)], "a int")
    for _ in range(2):
        write_batch(df, folder, 0)
    write_batch(df, folder, 1)
    assert spark.read.parquet(folder).count() == 2


@pytest.mark.parametrize("salts", [0, 32])
def test_dedupe(spark, folder, salts):
    start = datetime.datetime(2024, 1, 1)
    schema = "event_id int, ts timestamp"
    # one id makes up most of the first arrival; later arrivals repeat ids, one of them late
    first = [(1, start)] * 500 + [(i, start) for i in range(2, 100)]
    spark.createDataFrame(first, schema).repartition(4).write.parquet(folder)
    root = workspace(spark, "dedupe")
    jobs.dedupe(stream_of(spark, folder), "event_id", "ts", "10 days", root, salts)
    send(spark, folder, [(1, start), (5, start), (200, start + datetime.timedelta(days=1))], schema)
    out = jobs.dedupe(stream_of(spark, folder), "event_id", "ts", "10 days", root, salts)
    assert sorted(r["event_id"] for r in out.collect()) == [*range(1, 100), 200]


def test_date_histogram_goes_on_counting(spark, folder):
    root = workspace(spark, "hist")
    at = datetime.datetime(2024, 1, 1, 5)
    for n in (3, 2):
        send(spark, folder, [(i, at) for i in range(n)], "id int, ts timestamp")
        out = jobs.date_histogram(stream_of(spark, folder), "ts", "1 day", "2 days", root)
    assert rows(out) == [(datetime.datetime(2024, 1, 1), 5)]


def test_intake(spark, folder):
    root = workspace(spark, "intake")
    send(spark, folder, [(1, 1), (2, 50)])
    stored = jobs.intake(stream_of(spark, folder), [Rule("VALUE_COMPARE", "v", (">", 10))], root)
    assert rows(stored.select("id", F.size("mdmErrors"), "batch_id")) == [(1, 0, 0), (2, 1, 0)]


def test_one_file_as_a_stream(spark):
    seen = []
    run_available(stream_of(spark, f"{SMALL}/events.parquet"), lambda b, i: seen.append(b.count()), workspace(spark, "one"))
    assert seen == [1000]
