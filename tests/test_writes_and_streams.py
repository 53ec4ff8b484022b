"""Writes that are run twice, and streaming queries against their batch results."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from rigpulse.operators import alerts as A
from rigpulse.operators import windows as W
from rigpulse.operators.enrich import enrich, with_site
from rigpulse.operators.latest import status_feed
from rigpulse.schemas import (
    ALERTS,
    SENSOR_READINGS,
    STATUS_EVENT,
    TOPIC_ALERTS,
    TOPIC_SENSOR,
    TOPIC_STATUS,
)
from rigpulse.session import scratch_dir
from rigpulse.sinks import tables as S
from rigpulse.sources import decode as D
from rigpulse.sources import streams, tables
from rigpulse.streaming import jobs as J
from rigpulse.streaming.progress import progress_frame
from tests.helpers import equipment, events, plan, readings, rows, sites

T0 = datetime(2025, 1, 1)


def at(**shift):
    return T0 + timedelta(**shift)


# Writes


def test_stored_shape_rounds_half_up(spark):
    stored = S.stored_readings(events(spark, {"engine_temp_c": 90.125, "oil_pressure_kpa": 300.05}))
    assert stored.schema == SENSOR_READINGS
    row = stored.first()
    assert (str(row.engine_temp_c), str(row.oil_pressure_kpa)) == ("90.13", "300.1")


def test_kpi_rerun_replaces_its_day_only(spark):
    path = scratch_dir(spark, "kpi")
    fields = "equipment_id string, kpi_date date, n int"
    first = [("a", T0.date(), 1), ("b", T0.date(), 1), ("a", at(days=1).date(), 1)]
    S.write_kpis(spark.createDataFrame(first, fields), path)
    S.write_kpis(spark.createDataFrame([("a", T0.date(), 2)], fields), path)
    assert rows(spark.read.parquet(path), "equipment_id", "kpi_date", "n") == [
        ("a", T0.date(), 2),
        ("a", at(days=1).date(), 1),
    ]


def test_insert_absent_is_idempotent(spark):
    path = scratch_dir(spark, "insert")
    batch = readings(spark, {"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"})
    batch.where("event_id = 'b'").write.parquet(path)
    for _ in range(3):
        S.insert_absent(batch, spark.read.parquet(path), path, ["event_id"])
    assert rows(spark.read.parquet(path), "event_id") == [("a",), ("b",)]


def test_absent_rows_picks_by_order(spark):
    incoming = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, n int")
    stored = spark.createDataFrame([("b", 0)], "k string, n int")
    assert rows(S.absent_rows(incoming, stored, ["k"], [F.col("n")])) == [("a", 1)]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "k string, n int")
    assert rows(S.upsert(old, new, ["k"])) == [("a", 1), ("b", 2), ("c", 2)]


def test_batch_written_again_replaces_itself(spark):
    path = scratch_dir(spark, "batches")
    for ids, batch in ((["a", "b"], 0), (["c"], 1), (["a", "b"], 0), ([], 1)):
        frame = events(spark, *[{"event_id": i} for i in ids or ["x"]])
        S.write_batch(frame if ids else frame.where(F.lit(False)), path, batch)
    assert rows(spark.read.parquet(path), "event_id") == [("a",), ("b",)]


def test_dated_table_prunes_days_and_replays(spark):
    path = scratch_dir(spark, "dated")
    times = [at(hours=h) for h in (-1, 0, 23, 24, 47, 48)]
    frame = readings(spark, *[{"timestamp": t} for t in times])
    for batch in (0, 0, 1):
        S.write_dated(S.to_schema(frame, SENSOR_READINGS), path, "recorded_at", batch)
    found = tables.read_dated(spark, path, SENSOR_READINGS, "recorded_at", T0, at(days=2))
    assert rows(found, "recorded_at") == [(t,) for t in times[1:5] for _ in range(2)]
    assert "on_day" in plan(found).split("PartitionFilters: [")[1].split("]")[0]


# Streams


class Feed:
    """A folder of message files; each call adds one file, so one micro-batch."""

    def __init__(self, spark):
        self.spark = spark
        self.root = scratch_dir(spark, "feed")
        self.n = 0

    def add(self, messages):
        messages.coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        self.n += 1

    def stream(self):
        return streams.file_stream(
            self.spark, f"{self.root}/in", max_files_per_trigger=1, name_glob="*.parquet"
        )


def _send(feed, *changes):
    feed.add(D.encode(events(feed.spark, *changes)))


def _drain_windows(feed):
    """Every file so far as a micro-batch of its own."""
    J.drain(J.window_query(feed.stream(), f"{feed.root}/w", f"{feed.root}/c", J.DRAIN))
    return J.current_windows(feed.spark, f"{feed.root}/w")


def test_late_events(spark):
    feed = Feed(spark)
    _send(feed, {"event_id": "now", "timestamp": at(minutes=31)})
    _drain_windows(feed)
    _send(feed, {"event_id": "late", "timestamp": at(minutes=22)})
    _drain_windows(feed)
    _send(feed, {"event_id": "too late", "timestamp": at(minutes=5)})
    found = _drain_windows(feed)
    starts = [r[0] for r in rows(found, "window_start")]
    assert starts == [at(minutes=m) for m in (*range(18, 23), *range(27, 32))]


def test_windows_over_several_batches_equal_batch(spark):
    feed = Feed(spark)
    parts = [
        [{"event_id": f"{b}-{i}", "timestamp": at(seconds=97 * b + 41 * i), "engine_temp_c": 95.0 + b}
         for i in range(12)]
        for b in range(3)
    ]
    for part in parts:
        _send(feed, *part)
    found = _drain_windows(feed)
    whole = enrich(events(spark, *[c for part in parts for c in part]))
    names = ["window_start", "reading_count", "anomaly_count", "max_engine_temp"]
    assert rows(found, *names) == rows(W.sliding_stats_by_pane(whole), *names)


def test_stateless_tables_take_late_rows_and_survive_restart(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"

    def drain():
        J.drain(*J.run_all(feed.stream(), out, f"{feed.root}/c", [J.DRAIN] * 3))

    _send(feed, {"event_id": "now", "timestamp": at(hours=3), "engine_temp_c": 120.0})
    drain()
    drain()
    _send(feed, {"event_id": "late", "timestamp": at(minutes=5)})
    bad = D.encode(events(spark, {})).withColumn("value", F.encode(F.lit("junk"), "UTF-8"))
    feed.add(bad)
    drain()
    stored = tables.read_dated(spark, f"{out}/readings", SENSOR_READINGS, "recorded_at")
    assert rows(stored, "event_id") == [("late",), ("now",)]
    assert rows(J.current_latest(spark, f"{out}/latest"), "event_id") == [("now",)]
    alerts = tables.read_dated(spark, f"{out}/alerts", ALERTS, "triggered_at")
    assert rows(alerts, "alert_type") == [("HIGH_ENGINE_TEMP",), ("WARN_ENGINE_TEMP",)]
    assert rows(spark.read.parquet(f"{out}/quarantine"), "value", "problem") == [("junk", "malformed")]
    archived = tables.read_archive(spark, f"{out}/archive", T0, at(days=1))
    assert rows(archived, "event_id", "is_critical") == [("late", False), ("now", True)]


def test_latest_table_over_batches(spark):
    feed = Feed(spark)
    batches = [
        [{"event_id": "a", "timestamp": at(hours=2)}, {"event_id": "b", "equipment_id": "m2"}],
        [{"event_id": "c", "timestamp": at(hours=1)}],
        [{"event_id": "d", "equipment_id": "m2", "timestamp": at(hours=5)}],
        [{"event_id": "z", "timestamp": at(hours=2)}, {"event_id": "e", "equipment_id": "m3"}],
    ]
    expected = [
        [("m1", "a"), ("m2", "b")],
        [("m1", "a"), ("m2", "b")],
        [("m1", "a"), ("m2", "d")],
        [("m1", "z"), ("m2", "d"), ("m3", "e")],
    ]
    for batch, latest in zip(batches, expected):
        _send(feed, *batch)
        J.drain(J.latest_query(feed.stream(), f"{feed.root}/l", f"{feed.root}/c", J.DRAIN))
        found = J.current_latest(spark, f"{feed.root}/l")
        assert rows(found, "equipment_id", "event_id") == latest


def test_standing_latest_starts_from_the_stored_readings(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    assert J.stored_so_far(spark, out).count() == 0
    _send(feed, {"equipment_id": "silent", "event_id": "old"}, {"equipment_id": "m1", "event_id": "a"})
    J.drain(J.live_query(feed.stream(), out, f"{feed.root}/live", J.DRAIN))
    later = Feed(spark)
    for event_id, hour in (("b", 1), ("c", 2)):
        _send(later, {"equipment_id": "m1", "event_id": event_id, "timestamp": at(hours=hour)})
        J.drain(J.latest_query(
            later.stream(), f"{out}/latest", f"{later.root}/c", J.DRAIN,
            seed=lambda session: J.stored_so_far(session, out),
        ))
        newest = rows(J.current_latest(spark, f"{out}/latest"), "equipment_id", "event_id")
        assert newest == [("m1", event_id), ("silent", "old")]


def test_duplicates_within_the_watermark(spark):
    feed = Feed(spark)
    for minute in (0, 3, 5):
        _send(feed, {"event_id": "same", "timestamp": T0}, {"event_id": f"e{minute}", "timestamp": at(minutes=minute)})
    unique = J.sensor_stream(feed.stream(), dedupe=True).select("event_id")
    query = J.append_query(unique, f"{feed.root}/out", f"{feed.root}/c", J.DRAIN)
    J.drain(query)
    assert rows(spark.read.parquet(f"{feed.root}/out"), "event_id") == [
        ("e0",), ("e3",), ("e5",), ("same",)
    ]
    progress = progress_frame(spark, query)
    assert progress.agg(F.sum("input_rows")).first()[0] == 6
    assert progress.agg(F.max("watermark")).first()[0] is not None


def test_closed_windows_in_append_mode(spark):
    feed = Feed(spark)
    _send(feed, {"timestamp": T0}, {"timestamp": at(minutes=1)})
    _send(feed, {"timestamp": at(minutes=30)})
    stats = W.sliding_stats(enrich(J.sensor_stream(feed.stream())))
    J.drain(J.append_query(stats, f"{feed.root}/out", f"{feed.root}/c", J.DRAIN))
    starts = [r[0] for r in rows(spark.read.parquet(f"{feed.root}/out"), "window_start")]
    assert starts == [at(minutes=m) for m in range(-4, 2)]


def test_site_lookup_keeps_unknown_sites(spark):
    feed = Feed(spark)
    _send(feed, {"event_id": "a"}, {"event_id": "b", "site_id": "s9"})
    placed = with_site(J.sensor_stream(feed.stream()), sites(spark, "s1"))
    J.drain(J.append_query(placed.select("event_id", "site_name"), f"{feed.root}/o", f"{feed.root}/c", J.DRAIN))
    assert rows(spark.read.parquet(f"{feed.root}/o"), "event_id", "site_name") == [
        ("a", "site s1"), ("b", None)
    ]


def test_two_topics_in_one_query(spark):
    feed = Feed(spark)
    hot = events(spark, {"engine_temp_c": 120.0})
    sent = A.limit_alerts(hot).withColumnRenamed("triggered_at", "timestamp")
    alerts = D.encode(sent, topic=TOPIC_ALERTS, schema=D.ALERT_EVENT)
    feed.add(D.encode(hot).unionByName(alerts))
    out = f"{feed.root}/out"

    def write_sensors(batch, batch_id):
        S.write_batch(S.stored_readings(D.decode(batch)), f"{out}/readings", batch_id)

    def write_alerts(batch, batch_id):
        typed = D.valid(D.parse(batch, D.ALERT_EVENT, D.ALERT_REQUIRED, ALERTS, "alerts"), D.ALERT_EVENT)
        S.write_batch(A.from_alert_events(typed), f"{out}/alerts", batch_id)

    writers = {TOPIC_SENSOR: write_sensors, TOPIC_ALERTS: write_alerts}
    J.drain(J.routed_query(feed.stream(), writers, f"{feed.root}/c", J.DRAIN))
    assert spark.read.parquet(f"{out}/readings").count() == 1
    assert rows(spark.read.parquet(f"{out}/alerts"), "alert_type") == [("HIGH_ENGINE_TEMP",)]


def test_status_feed_as_messages(spark):
    fleet = equipment(spark, ("m1", "s1", "haul_truck", 250, True))
    beats = status_feed(readings(spark, *[{"timestamp": at(minutes=i)} for i in range(10)]), fleet)
    sent = D.encode(beats, topic=TOPIC_STATUS, schema=STATUS_EVENT)
    assert rows(sent.select("key", "topic", F.col("value").cast("string"))) == [
        (
            "m1",
            "equipment-status",
            '{"equipment_id":"m1","site_id":"s1","status":"operating",'
            '"timestamp":"2025-01-01T00:09:00.000000Z"}',
        )
    ]


def test_jdbc_appends_in_pages(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(
        DataFrameWriter, "jdbc", lambda self, *args, **kwargs: seen.append((args, kwargs))
    )
    S.append_jdbc(readings(spark, {}), "u", "daily_kpi", {"user": "x"}, S.KPI_PAGE)
    options = {"user": "x", "batchsize": "100"}
    assert seen == [(("u", "daily_kpi"), {"mode": "append", "properties": options})]


def test_windows_on_the_console(spark):
    feed = Feed(spark)
    _send(feed, {})
    J.drain(J.window_console(feed.stream(), f"{feed.root}/c", J.DRAIN))


def test_triggers():
    assert J.Trigger("10 seconds").options() == {"processingTime": "10 seconds"}
    assert J.DRAIN.options() == {"availableNow": True}
