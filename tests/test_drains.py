"""Queries that drain a feed: what their look-ups read, where their state is kept, how they are fed."""

import json

from pyspark.sql import functions as F

from rigpulse.plans import catalog
from rigpulse.session import scratch_dir
from rigpulse.sinks import compaction
from rigpulse.sources import decode as D
from rigpulse.sources import folders
from rigpulse.sources import warehouse as WH
from rigpulse.streaming import dedupe
from rigpulse.streaming import jobs as J
from tests.helpers import events, rows
from tests.test_stored_streams import live, stored
from tests.test_writes_and_streams import Feed, at

SMALL = "/root/testdata/sf0.001"


def _noted(spark, checkpoint, batch=0):
    return json.loads(folders.text(spark, f"{checkpoint}/offsets/{batch}").split("\n")[1])


def _looked_into(monkeypatch, part):
    """Folders read from now on whose path holds ``part``."""
    seen, read = [], folders.read

    def spied(spark, root, paths, schema):
        chosen = list(paths)
        seen.extend(p for p in chosen if part in p)
        return read(spark, root, chosen, schema)

    monkeypatch.setattr(folders, "read", spied)
    return seen


def test_batches_whose_ids_are_in_the_state_are_not_looked_up(spark, monkeypatch):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    looked = _looked_into(monkeypatch, "/readings/")
    for i in range(3):
        feed.add(D.encode(events(spark, {"event_id": f"n{i}"}, {"event_id": "again"})))
    live(feed, out)
    feed.add(D.encode(events(spark, {"event_id": "n3"}, {"event_id": "again"})))
    live(feed, out)
    assert looked == []
    found = [("again",), *[(f"n{i}",) for i in range(4)]]
    assert rows(stored(spark, out, "readings"), "event_id") == found
    # Another checkpoint's state knows none of them.
    live(feed, out, "anew")
    assert looked and rows(stored(spark, out, "readings"), "event_id") == found


def test_archive_batches_in_the_state_are_not_looked_up(spark, monkeypatch):
    feed = Feed(spark)
    looked = _looked_into(monkeypatch, "/arc/")
    archive = lambda c: J.drain(
        J.archive_query(feed.stream(), f"{feed.root}/arc", f"{feed.root}/{c}", J.DRAIN)
    )
    for _ in range(2):
        feed.add(D.encode(events(spark, {"event_id": "a"})))
    archive("c")
    assert looked == []
    archive("anew")
    assert looked and spark.read.parquet(f"{feed.root}/arc").count() == 1


def test_batches_the_state_has_forgotten_are_looked_up(spark):
    feed = Feed(spark)
    for i in range(3):
        feed.add(D.encode(events(spark, {"event_id": f"n{i}"})))
    live(feed, f"{feed.root}/out")
    checkpoint = f"{feed.root}/c"
    mark = _noted(spark, checkpoint, 2)["batchWatermarkMs"]
    memory = dedupe.MEMORY_MINUTES * 60_000
    assert dedupe.remembered(spark, checkpoint, 2, {}) == [1, 0]
    assert dedupe.remembered(spark, checkpoint, 2, {0: mark - memory}) == [1]
    assert dedupe.remembered(spark, checkpoint, 2, {0: mark - memory + 1}) == [1, 0]
    assert dedupe.remembered(spark, checkpoint, 0, {}) == []


def test_merged_days_are_looked_up_whatever_their_number(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    for i in range(3):
        feed.add(D.encode(events(spark, {"event_id": f"n{i}"})))
    live(feed, out)
    path, day = f"{out}/readings", at().date()
    sent = events(spark, {"event_id": "n0"}, {"event_id": "n2"}, {"event_id": "new"})
    batch = sent.withColumn(dedupe.ARRIVED, F.current_timestamp())

    def unseen(held):
        fresh = dedupe.unseen(
            batch, path, J.READINGS_STORED, "event_id", "timestamp",
            dedupe.day_folder("timestamp"), 7, held,
        )
        return rows(fresh, "event_id")

    assert unseen([0, 1, 2]) == [("n0",), ("n2",), ("new",)]
    assert unseen([1, 2]) == [("n2",), ("new",)]
    compaction.compact(spark, path, at(days=2).date(), grace=-1.0)  # 0 and 1 into 1
    assert unseen([1, 2]) == [("n2",), ("new",)]
    compaction.settle(spark, path)
    assert sorted(folders.batches(spark, folders.days(spark, path)[day])) == [1, 2]
    assert unseen([1, 2]) == [("n2",), ("new",)]
    assert unseen([]) == [("new",)]


def test_a_drain_keeps_few_stores_and_the_session_its_settings(spark):
    key = J.STATE_PARTITIONS_KEY
    with J.settings(spark, {key: "600"}):
        few = J.drain_conf(spark)[key]
        with J.settings(spark, J.drain_conf(spark)):
            assert spark.conf.get(J.PROVIDER_KEY) == J.STATE_STORE_CONF[J.PROVIDER_KEY]
        assert spark.conf.get(key) == "600"
    assert int(few) == 4 * spark.sparkContext.defaultParallelism
    assert J.drain_conf(spark)[key] == spark.conf.get(key)
    assert "HDFSBacked" in spark.conf.get(J.PROVIDER_KEY)


def test_the_whole_job_holds_the_windows_of_a_batch(spark, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_MESSAGES", 100)
    monkeypatch.setattr(catalog, "JOB_FILES", 2, raising=False)
    made, drained = [], J.drain

    def drain(*queries):
        made.extend(queries)
        drained(*queries)

    monkeypatch.setattr(J, "drain", drain)
    w = WH.Warehouse(spark, SMALL)
    catalog._QUERIES["stream_all_tables"](spark, SMALL)
    sent = w.events().count()
    for query in made:
        taken = [p for p in query.recentProgress if p.numInputRows]
        assert sum(p.numInputRows for p in taken) == sent and len(taken) >= sent // 200
        assert all(p.numInputRows < 400 for p in taken)
        late = sum(s.numRowsDroppedByWatermark for p in taken for s in p.stateOperators)
        assert late == 0
        if query.name == "windows":
            assert max(s.numRowsTotal for p in taken for s in p.stateOperators) < 6 * 400


def test_ids_are_kept_on_disk_and_windows_in_memory(spark):
    root = scratch_dir(spark, "stores")
    catalog._run_whole_job(WH.Warehouse(spark, SMALL), root, 2)
    for name, kind in (("live", "RocksDB"), ("archive", "RocksDB"), ("windows", "HDFSBacked")):
        noted = _noted(spark, f"{root}/checkpoint/{name}")
        assert kind in noted["conf"][J.PROVIDER_KEY]
        assert folders.exists(spark, f"{root}/checkpoint/{name}/offsets/1")


def test_alerts_are_fed_in_order_of_time(spark, monkeypatch):
    seen, real = {}, J.live_query

    def watched(stream, root, checkpoint, trigger):
        J.drain(J.append_query(stream, f"{root}/copy", f"{root}/copied", trigger))
        seen["at"] = root
        return real(stream, root, checkpoint, trigger)

    monkeypatch.setattr(J, "live_query", watched)
    catalog._store_all_alerts(WH.Warehouse(spark, SMALL))
    copy = spark.read.parquet(f"{seen['at']}/copy")
    w = WH.Warehouse(spark, SMALL)
    sent = w.messages().unionByName(catalog._alert_messages(w))
    columns = ["value", "topic", "timestamp"]
    assert copy.select(columns).exceptAll(sent.select(columns)).isEmpty()
    assert copy.count() == sent.count()
    spans = copy.groupBy("batch_id").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    spans = spans.orderBy("batch_id").collect()
    assert len(spans) == catalog.FEED_BATCHES
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))
