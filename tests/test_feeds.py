"""Micro-batches of any size: files they write, files they are fed by."""

from datetime import datetime, timedelta
from types import SimpleNamespace

from pyspark.sql import functions as F

from rigpulse.plans import catalog
from rigpulse.session import scratch_dir
from rigpulse.sources import decode as D
from rigpulse.sources import folders
from rigpulse.streaming import jobs as J
from rigpulse.streaming import late as LA
from tests.helpers import events, rows
from tests.test_writes_and_streams import Feed, at


def taken(query):
    """Rows of the micro-batches that had any."""
    J.drain(query)
    return [p.numInputRows for p in query.recentProgress if p.numInputRows]


def test_a_batch_of_a_query_with_state_writes_a_file_per_folder(spark):
    feed = Feed(spark)
    sent = [{"site_id": f"s{i % 3}", "timestamp": at(days=i % 2)} for i in range(120)]
    feed.add(D.encode(events(spark, *sent)))
    J.drain(J.archive_query(feed.stream(), f"{feed.root}/arc", f"{feed.root}/c", J.DRAIN))
    J.drain(J.live_query(feed.stream(), f"{feed.root}/out", f"{feed.root}/live", J.DRAIN))
    assert folders.file_count(spark, f"{feed.root}/arc") == 6
    assert folders.file_count(spark, f"{feed.root}/out/readings") == 2


def test_a_slice_of_many_files_is_one_batch(spark, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_MESSAGES", 20, raising=False)
    root = scratch_dir(spark, "slices")
    w = SimpleNamespace(spark=spark, events=lambda: events(spark, *[{} for _ in range(200)]))
    send = catalog._split_feed(w, root, 2)
    stream = send(0, 1)
    assert folders.file_count(spark, f"{root}/in") == 10
    sizes = [spark.read.parquet(f"{root}/sent/slice={i}").count() for i in (0, 1)]
    assert taken(J.live_query(stream, f"{root}/out", f"{root}/c", J.DRAIN)) == sizes
    assert taken(J.live_query(send(1), f"{root}/out", f"{root}/c", J.DRAIN)) == sizes[1:]


def test_the_batches_of_a_feed_do_not_grow_with_its_files(spark):
    root = scratch_dir(spark, "spread")
    messages = D.encode(events(spark, *[{"timestamp": at(minutes=i)} for i in range(120)]))
    messages.repartition(30).write.parquet(f"{root}/in")
    stream = catalog._spread_feed(SimpleNamespace(spark=spark), f"{root}/in")
    batches = taken(J.live_query(stream, root, f"{root}/c", J.DRAIN))
    assert len(batches) <= catalog.FEED_BATCHES and sum(batches) == 120


def test_parts_with_late_rows_are_sent_by_all_tasks(spark):
    start = datetime(2024, 1, 1)
    sent = [{"event_id": str(i), "timestamp": start + timedelta(hours=i)} for i in range(700)]
    w = SimpleNamespace(spark=spark, events=lambda: events(spark, *sent).repartition(4))
    root = catalog._run_with_late_rows(w)
    assert folders.file_count(spark, f"{root}/in") > 3
    # Every seventh event came a part later, behind all but the last minutes of the part before.
    days = lambda i: (start + timedelta(hours=i)).day
    late = [(str(i),) for i in range(0, 700, 7) if days(i) <= 20]
    assert rows(LA.late_events(spark, root), "event_id") == sorted(late)
    assert spark.read.parquet(f"{root}/on_time").where(F.col("batch_id") >= 0).count() == 700 - len(late)
