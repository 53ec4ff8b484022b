"""Tables a stream writes while others change them: resends, two topics, resolving, totals."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rigpulse.operators import alerts as A
from rigpulse.operators import health as H
from rigpulse.operators import windows as W
from rigpulse.operators.enrich import enrich
from rigpulse.operators.latest import latest_per_key
from rigpulse.plans import jobs
from rigpulse.schemas import ALERT_EVENT, ALERTS, SENSOR_READINGS, TOPIC_ALERTS
from rigpulse.session import saved, scratch_dir
from rigpulse.sinks import alerts as SA
from rigpulse.sinks.tables import to_schema
from rigpulse.sources import decode as D
from rigpulse.sources import folders, tables
from rigpulse.streaming import dedupe
from rigpulse.streaming import jobs as J
from rigpulse.streaming import late as LA
from rigpulse.streaming import progress as P
from rigpulse.streaming import totals as TO
from tests.helpers import equipment, events, plan, rows, sites
from tests.test_writes_and_streams import Feed, at

T0 = datetime(2025, 1, 1)
HOT = {"engine_temp_c": 120.0}


def live(feed, out, checkpoint="c"):
    J.drain(J.live_query(feed.stream(), out, f"{feed.root}/{checkpoint}", J.DRAIN))


def stored(spark, out, name):
    schema, column = (
        (ALERTS, "triggered_at") if name == "alerts" else (SENSOR_READINGS, "recorded_at")
    )
    return tables.read_dated(spark, f"{out}/{name}", schema, column)


def device(spark, *changes):
    sent = A.limit_alerts(events(spark, *changes)).withColumnRenamed("triggered_at", "timestamp")
    return D.encode(sent, topic=TOPIC_ALERTS, schema=ALERT_EVENT)


def test_resends_are_stored_once(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    first = {"event_id": "a", "timestamp": T0, **HOT}
    feed.add(D.encode(events(spark, first, first)).unionByName(device(spark, first)))
    feed.add(D.encode(events(spark, first, {"event_id": "b", "timestamp": at(days=1)})))
    live(feed, out)
    feed.add(D.encode(events(spark, first)).unionByName(device(spark, first)))
    live(feed, out)
    # Another query, without the state of the first, writing the same tables.
    live(feed, out, "anew")
    assert rows(stored(spark, out, "readings"), "event_id") == [("a",), ("b",)]
    types = rows(stored(spark, out, "alerts"), "alert_type")
    assert types == [("HIGH_ENGINE_TEMP",), ("HIGH_ENGINE_TEMP",), ("WARN_ENGINE_TEMP",)]


def test_what_may_be_stored_already(spark):
    now = datetime(2025, 1, 1, 12)
    ages = {"fresh": 60, "old": 600, "edge": 530, "ahead": -50, "far ahead": -90, "none": None}
    frame = spark.createDataFrame(
        [(k, None if v is None else now - timedelta(seconds=v), now) for k, v in ages.items()],
        f"name string, at timestamp, {dedupe.ARRIVED} timestamp",
    )
    suspects = frame.where(dedupe.may_be_stored(F.col("at")))
    assert rows(suspects, "name") == [("far ahead",), ("none",), ("old",)]


def test_lookup_reads_only_the_folders_of_the_batch(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    feed.add(D.encode(events(spark, *[{"timestamp": at(days=d)} for d in range(5)])))
    live(feed, out)
    batch = events(spark, {"event_id": "e0002", "timestamp": at(days=2)}, {"event_id": "n", "timestamp": at(days=2)})
    batch = batch.withColumn(dedupe.ARRIVED, F.lit("2025-02-01").cast("timestamp"))
    fresh = dedupe.unseen(
        batch, f"{out}/readings", J.READINGS_STORED, "event_id", "timestamp",
        dedupe.day_folder("timestamp"), 7,
    )
    assert rows(fresh, "event_id") == [("n",)]
    text = plan(fresh)
    assert "on_day=2025-01-03" in text and "on_day=2025-01-01" not in text
    again = dedupe.unseen(
        batch, f"{out}/readings", J.READINGS_STORED, "event_id", "timestamp",
        dedupe.day_folder("timestamp"), 0,
    )
    assert again.count() == 2  # a replay of the batch that stored them


@pytest.mark.parametrize("site", ["s1", "a/b", "50%", "x=y:z", "é ü"])
def test_archive_folders_by_name(spark, site):
    feed = Feed(spark)
    event = {"event_id": "a", "site_id": site, "timestamp": T0}
    for checkpoint in ("c", "anew"):
        feed.add(D.encode(events(spark, event)))
        J.drain(J.archive_query(feed.stream(), f"{feed.root}/arc", f"{feed.root}/{checkpoint}", J.DRAIN))
    found = tables.read_archive(spark, f"{feed.root}/arc", T0, at(days=1))
    assert rows(found, "event_id", "site_id") == [("a", site)]


def test_refused_records_by_topic(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    good = events(spark, {"event_id": "a"})
    junk = lambda topic: D.encode(good, topic=topic).withColumn("value", F.encode(F.lit("junk"), "UTF-8"))
    long = device(spark, HOT).withColumn(
        "value", F.encode(F.regexp_replace(F.col("value").cast("string"), '"metric":"[^"]*"', f'"metric":"{"m" * 51}"'), "UTF-8")
    )
    odd = D.encode(events(spark, {"event_id": "b", "status": "asleep"}))
    feed.add(D.encode(good).unionByName(junk("sensor-events")).unionByName(junk(TOPIC_ALERTS)).unionByName(junk("other")).unionByName(long).unionByName(odd))
    live(feed, out)
    assert rows(stored(spark, out, "readings"), "event_id") == [("a",)]
    found = {n: rows(spark.read.parquet(f"{out}/{n}"), "problem") for n in folders.names(spark, out) if n.startswith("quar")}
    assert found == {
        "quarantine": [("malformed",), ("unknown_value",)],
        "quarantine_alerts": [("malformed",), ("too_long",)],
        "quarantine_topics": [("unknown_topic",)],
    }


def test_stream_job_reads_both_topics(spark, monkeypatch):
    """The job's main, with files in place of the broker and the streams run until drained."""
    feed = Feed(spark)
    out = f"{feed.root}/out"
    feed.add(D.encode(events(spark, {"event_id": "a"})).unionByName(device(spark, HOT)))
    asked = {}

    def source(session, servers, **options):
        asked.update(options)
        return feed.stream()

    run = J.run_all
    monkeypatch.setattr(jobs, "kafka_stream", source)
    monkeypatch.setattr(jobs, "build_session", lambda name, **conf: asked.update(conf) or spark)
    monkeypatch.setattr(
        jobs.streams, "run_all",
        lambda m, root, c, **k: J.drain(*run(m, root, c, [J.DRAIN] * 3, **k)),
    )
    monkeypatch.setattr(type(spark.streams), "awaitAnyTermination", lambda self: None)
    jobs.main(["stream", "--root", out, "--checkpoint", f"{feed.root}/c", "--servers", "b:1", "--state-partitions", "12"])
    assert asked["topics"] == ("sensor-events", "equipment-alerts")
    assert asked["spark.sql.shuffle.partitions"] == "12"
    assert rows(stored(spark, out, "readings"), "event_id") == [("a",)]
    assert rows(stored(spark, out, "alerts"), "alert_type") == [("HIGH_ENGINE_TEMP",)]
    assert J.current_windows(spark, f"{out}/windows").count() == 5


def _alerts_of_days(spark, out, days=4):
    feed = Feed(spark)
    feed.add(D.encode(events(spark, *[{"event_id": f"d{d}", "timestamp": at(days=d), **HOT} for d in range(days)])))
    live(feed, out)
    return feed


def test_resolving_touches_only_its_folders(spark):
    out = scratch_dir(spark, "resolve")
    _alerts_of_days(spark, out)
    path = f"{out}/alerts"
    alerts = stored(spark, out, "alerts").where(F.dayofmonth("triggered_at") == 2)
    ids = saved(spark, alerts.select("alert_id", "triggered_at"), "ids")
    touched = SA.touched_folders(spark, path, ids)
    assert [t.rsplit("/", 2)[1] for t in touched] == ["on_day=2025-01-02"]
    text = plan(SA.rewritten(spark, path, ids, "2025-01-09", touched))
    assert "on_day=2025-01-02" in text and "on_day=2025-01-03" not in text
    assert SA.resolve_stored(spark, path, ids, "2025-01-09 00:00:00") == 2
    assert SA.resolve_stored(spark, path, ids, "2025-01-10 00:00:00") == 0
    now = stored(spark, out, "alerts")
    assert rows(now.where("resolved_at IS NOT NULL"), "resolved_at") == [(datetime(2025, 1, 9),)] * 2
    assert now.count() == 8
    assert jobs.run_resolve(spark, out, ["unknown"], "2025-01-09 00:00:00") == 0
    held = TO.totals(spark, out).where("table = 'alerts'").agg(F.sum("open"), F.sum("critical"), F.sum("rows")).first()
    assert tuple(held) == (6, 3, 8)


def test_resolving_that_ended_in_between_is_finished(spark, monkeypatch):
    out = scratch_dir(spark, "resolve-crash")
    _alerts_of_days(spark, out, 2)
    path = f"{out}/alerts"
    ids = saved(spark, stored(spark, out, "alerts").select("alert_id"), "ids")
    place = SA._put_in_place
    monkeypatch.setattr(SA, "_put_in_place", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        SA.resolve_stored(spark, path, ids, "2025-01-09 00:00:00")
    assert stored(spark, out, "alerts").where("resolved_at IS NOT NULL").count() == 0
    monkeypatch.setattr(SA, "_put_in_place", place)
    SA.finish_pending(spark, path)
    assert stored(spark, out, "alerts").where("resolved_at IS NULL").count() == 0
    assert folders.hidden(spark, f"{path}/_resolving", done=False) == []


def test_a_replayed_batch_keeps_what_was_resolved(spark):
    out = scratch_dir(spark, "resolve-replay")
    _alerts_of_days(spark, out, 2)
    path = f"{out}/alerts"
    batch = saved(spark, stored(spark, out, "alerts"), "batch")
    SA.resolve_stored(spark, path, batch.limit(1).select("alert_id"), "2025-01-09 00:00:00")
    SA.write_alerts(batch, path, 0)
    now = stored(spark, out, "alerts")
    assert (now.count(), now.where("resolved_at IS NOT NULL").count()) == (4, 1)


def _figures(spark, out, fleet, as_of):
    readings, alerts = stored(spark, out, "readings"), stored(spark, out, "alerts")
    newest = saved(spark, latest_per_key(readings), "newest")
    standing = TO.ingest_stats_standing(spark, out, newest, fleet, as_of)
    scanned = H.ingest_stats(readings, fleet, alerts, as_of)
    assert rows(standing.select(*scanned.columns)) == rows(scanned)
    healthy = TO.ingest_health_standing(spark, out, as_of, 1)
    assert rows(healthy) == rows(H.ingest_health(readings, alerts, as_of, 1))
    return standing


def test_totals_equal_the_scan_at_every_step(spark):
    feed = Feed(spark)
    out, as_of = f"{feed.root}/out", "2025-01-03 00:30:00"
    fleet = equipment(spark, ("m1", "s1", "haul_truck", 250, True))
    parts = [
        [{"event_id": f"x{b}{i}", "timestamp": at(hours=9 * b, minutes=20 * i), **(HOT if i % 2 else {})} for i in range(4)]
        for b in range(6)
    ]
    for n, part in enumerate(parts):
        feed.add(D.encode(events(spark, *part)))
        live(feed, out)
        if n in (1, 3, 4):
            TO.fold(spark, out)
        if n in (0, 3, 5):
            _figures(spark, out, fleet, as_of)
    TO.write_batch_totals(*[to_schema(stored(spark, out, t).limit(0), s) for t, s in (("readings", SENSOR_READINGS), ("alerts", ALERTS))], out, 99)
    TO.fold(spark, out)
    TO.fold(spark, out)
    ids = saved(spark, stored(spark, out, "alerts").limit(3).select("alert_id"), "ids")
    SA.resolve_stored(spark, f"{out}/alerts", ids, as_of)
    for _ in range(2):
        jobs.run_maintenance(
            stored(spark, out, "readings").withColumn("hours_since_service", F.lit(260.0)),
            fleet, sites(spark, "s1"), f"{out}/alerts", f"{out}/logs", as_of,
        )
    text = plan(_figures(spark, out, fleet, as_of))
    assert jobs.run_health_check_standing(spark, out, as_of, 0)["healthy"]
    scans = [line for line in text.splitlines() if "FileScan" in line and "/readings/on_day" in line]
    assert scans and not any("2025-01-01" in line for line in scans)


def test_latest_folders_do_not_change_under_a_reader(spark):
    feed = Feed(spark)
    path = f"{feed.root}/latest"

    def step(event_id, hour, grace=J.LATEST_GRACE):
        feed.add(D.encode(events(spark, {"event_id": event_id, "timestamp": at(hours=hour)})))
        J.drain(J.latest_query(feed.stream(), path, f"{feed.root}/c", J.DRAIN, grace=grace))

    step("a", 1)
    reader = J.current_latest(spark, path)
    for n, name in enumerate("bcd"):
        step(name, 2 + n)
    assert rows(reader, "event_id") == [("a",)]  # planned before, read after three more batches
    assert rows(J.current_latest(spark, path), "event_id") == [("d",)]
    # A folder that is being written has no mark yet and is not read.
    folders.make(spark, f"{path}/batch_id=999")
    assert rows(J.current_latest(spark, path), "event_id") == [("d",)]
    assert len(J._finished(spark, path)) == 4
    step("e", 9, grace=-1)
    assert [b for b, _ in J._finished(spark, path)] == [3, 4]
    assert rows(J.current_latest(spark, path), "event_id") == [("e",)]


def test_late_rows_are_set_aside_and_added(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    parts = [
        [{"event_id": "a", "timestamp": at(minutes=31)}, {"event_id": "b", "timestamp": at(minutes=2)}],
        [{"event_id": "c", "timestamp": at(minutes=22)}, {"event_id": "late", "timestamp": at(minutes=3)},
         {"event_id": "late too", "timestamp": at(minutes=20), "engine_temp_c": 130.0}],
        [{"event_id": "late", "timestamp": at(minutes=3)}, {"event_id": "d", "timestamp": at(minutes=40)}],
    ]
    for n, part in enumerate(parts):
        feed.add(D.encode(events(spark, *part)))
        J.drain(J.live_query(feed.stream(), out, f"{feed.root}/c", J.DRAIN, split_late=True))
        if n != 1:  # one batch, then two in one
            query = J.split_window_query(spark, out, f"{feed.root}/w", J.DRAIN)
            J.drain(query)
            assert LA.dropped(query) == 0
    assert rows(LA.late_events(spark, out), "event_id") == [("late",), ("late too",)]
    # Without the split the state drops rows, as many as the progress rows say.
    plain = J.window_query(feed.stream(), f"{out}/windows", f"{feed.root}/plain", J.DRAIN)
    J.drain(plain)
    assert LA.dropped(plain) > 0
    unique = [c for part in parts[:2] for c in part] + parts[2][1:]
    whole = W.sliding_stats_by_pane(enrich(events(spark, *unique)))
    assert rows(LA.corrected_windows(spark, out), *W.WINDOW_COLUMNS) == rows(whole, *W.WINDOW_COLUMNS)


def test_a_replayed_split_changes_nothing(spark):
    out = scratch_dir(spark, "split-replay")
    for n, minute in enumerate((31, 5)):
        frame = events(spark, {"event_id": f"e{n}", "timestamp": at(minutes=minute)})
        for _ in range(2):
            LA.write_split(frame, out, n, J.WATERMARK)
        TO.write_batch_totals(
            J.stored_readings(frame), J.alert_rows(frame), out, n
        )
    assert rows(LA.late_events(spark, out), "event_id") == [("e1",)]
    assert spark.read.parquet(f"{out}/on_time").count() == 1


def test_offsets_and_lag_of_topics():
    class Source:
        startOffset = '{"sensor-events":{"0":5,"1":7}}'
        endOffset = '{"sensor-events":{"0":9,"1":7}}'
        latestOffset = '{"sensor-events":{"0":30,"1":7}}'

    class Files:
        startOffset, endOffset, latestOffset = None, '{"logOffset":3}', None

    class Batch:
        sources = [Source(), Files()]

    assert P._offsets(Batch()) == [
        (0, "sensor-events", "0", 5, 9, 30),
        (0, "sensor-events", "1", 7, 7, 7),
        (1, "", "logOffset", None, 3, None),
    ]


def test_stream_health_from_progress(spark):
    def batch(query, number, at, end, latest):
        return (query, query, number, at, 10, 1.0, 1.0, None, 0, 0, None, None, [(0, "t", "0", 0, end, latest)])

    found = [
        batch("live", 0, "2025-01-01T00:00:00.000Z", 5, 50),
        batch("live", 1, "2025-01-01T00:09:00.000Z", 45, 50),
        batch("live", 1, "2025-01-01T00:09:30.000Z", 45, 50),
        batch("archive", 3, "2025-01-01T00:08:00.000Z", 50, 50),
    ]
    frame = spark.createDataFrame(found, P.PROGRESS)
    assert rows(P.source_lag(frame), "query", "lag") == [("archive", 0), ("live", 5)]
    assert rows(P.totals_by_query(frame), "query", "batches", "input_rows") == [("archive", 1, 10), ("live", 2, 20)]
    for as_of, lag, flowing in (("2025-01-01 00:10:00", 5, True), ("2025-01-01 00:10:00", 4, False), ("2025-01-01 00:14:00", 5, False)):
        assert P.stream_health(frame, as_of, most_lag=lag).first().flowing is flowing
    assert P.stream_health(frame.limit(0), "2025-01-01 00:10:00").first().flowing is False


def test_merged_days_read_the_same_at_every_step(spark):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    as_of = "2025-01-04 12:00:00"

    def step(*changes):
        feed.add(D.encode(events(spark, *changes)))
        live(feed, out)

    def seen():
        return rows(stored(spark, out, "readings"), "event_id")

    days = [{"event_id": f"d{d}", "timestamp": at(days=d), **HOT} for d in range(5)]
    for part in (days, [{"event_id": f"x{d}", "timestamp": at(days=d)} for d in range(5)], [{"event_id": "y", "timestamp": at(days=4)}]):
        step(*part)
    before, path = seen(), f"{out}/readings"
    assert len(before) == 11
    assert jobs.run_compaction(spark, out, as_of, grace=600.0)["readings"] == ["2025-01-01", "2025-01-02", "2025-01-03"]
    assert len(folders.batches(spark, f"{path}/on_day=2025-01-01")) == 2
    # The merged folder counts from now on, also for the lookup of ids, whatever is left beside it.
    folders.drop(spark, f"{path}/on_day=2025-01-01/batch_id=0")
    assert seen() == before
    step(days[0], days[1], {"event_id": "new", "timestamp": at(days=1)})
    assert seen() == sorted([*before, ("new",)])
    one = tables.read_dated(spark, path, SENSOR_READINGS, "recorded_at", at(days=1), at(days=2))
    assert rows(one, "event_id") == [("d1",), ("new",), ("x1",)] and "on_day=2025-01-03" not in plan(one)
    jobs.run_compaction(spark, out, as_of, grace=-1.0)
    assert seen() == sorted([*before, ("new",)])
    assert {d: len(folders.batches(spark, p)) for d, p in folders.days(spark, path).items() if d.day <= 3} == {
        T0.date(): 1, at(days=1).date(): 2, at(days=2).date(): 1
    }
    assert folders.file_count(spark, f"{path}/on_day=2025-01-01") == 1
    assert folders.merged_days(spark, path) == {}
    # The newest batch stays apart: it may be replayed. Another batch lets it be merged as well.
    step({"event_id": "z", "timestamp": at(days=4)})
    jobs.run_compaction(spark, out, as_of, grace=600.0)
    ids = saved(spark, stored(spark, out, "alerts").select("alert_id"), "ids")
    assert SA.resolve_stored(spark, f"{out}/alerts", ids, as_of) == 10
    jobs.run_retention(spark, out, "2025-06-01 00:00:00")
    assert seen() == [] and folders.merged_days(spark, path) == {}
    archived = tables.read_dated(spark, f"{out}/expired", SENSOR_READINGS, "recorded_at")
    assert rows(archived, "event_id") == sorted([*before, ("new",), ("z",)])


def test_compaction_that_ended_in_between(spark, monkeypatch):
    feed = Feed(spark)
    out = f"{feed.root}/out"
    for n in range(3):
        feed.add(D.encode(events(spark, {"event_id": f"a{n}", "timestamp": T0})))
        live(feed, out)
    before = rows(stored(spark, out, "readings"), "event_id")
    jobs.run_compaction(spark, out, "2025-01-04 12:00:00")
    rename = folders.rename
    monkeypatch.setattr(folders, "rename", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run_compaction(spark, out, "2025-01-04 12:00:00", grace=-1.0)
    assert rows(stored(spark, out, "readings"), "event_id") == before
    monkeypatch.setattr(folders, "rename", rename)
    jobs.run_compaction(spark, out, "2025-01-04 12:00:00", grace=-1.0)
    assert rows(stored(spark, out, "readings"), "event_id") == before


def test_old_versions_of_windows_are_dropped(spark):
    feed = Feed(spark)
    path = f"{feed.root}/windows"
    for n in range(4):
        feed.add(D.encode(events(spark, {"event_id": f"e{n}", "timestamp": at(seconds=20 * n)})))
        J.drain(J.window_query(feed.stream(), path, f"{feed.root}/c", J.DRAIN))
    before = rows(J.current_windows(spark, path))
    for grace in (600.0, -1.0):
        jobs.run_compaction(spark, feed.root, "2025-01-04 12:00:00", grace=grace)
        assert rows(J.current_windows(spark, path)) == before
    versions = spark.read.parquet(path).groupBy("window_start").count()
    assert versions.agg(F.max("count")).first()[0] == 2  # the merged one and the newest batch's
    days = folders.days(spark, path).values()
    assert max(len(folders.batches(spark, d)) for d in days) == 2


def test_windows_of_an_ordered_feed_leave_the_state(spark, monkeypatch):
    from rigpulse.plans import catalog as C
    from rigpulse.sources import warehouse as WH

    path, rows_of = scratch_dir(spark, "ordered"), "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    moments = [at(minutes=(37 * i) % 200) for i in range(200)] + [None]
    found = [(i, t, i % 2, "view", float(i), '{"k": 1}') for i, t in enumerate(moments)]
    spark.createDataFrame(found, rows_of).write.parquet(f"{path}/events.parquet")
    spark.createDataFrame(
        [(i, "n", i, 1.0, "m") for i in range(2)],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    ).write.parquet(f"{path}/customer.parquet")
    monkeypatch.setattr(C, "FILE_MESSAGES", 10)
    monkeypatch.setattr(C, "ORDERED_FILES", 4)
    w = WH.Warehouse(spark, path)
    query = J.window_query(C._ordered_feed(w), f"{path}/w", f"{path}/c", J.DRAIN)
    J.drain(query)
    kept = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators]
    assert LA.dropped(query) == 0 and len(kept) >= 5
    # Beside the windows of a batch only those the watermark still keeps, not of all 200 minutes.
    assert max(kept) < 150
    whole = W.sliding_stats_by_pane(w.enriched().where("timestamp IS NOT NULL"))
    assert rows(J.current_windows(spark, f"{path}/w"), "equipment_id", "window_start", "reading_count") == rows(
        whole, "equipment_id", "window_start", "reading_count"
    )


def test_texts_of_good_records_are_not_kept(spark, monkeypatch):
    feed, seen = Feed(spark), []
    bad = D.encode(events(spark, {})).withColumn("value", F.encode(F.lit("junk"), "UTF-8"))
    feed.add(D.encode(events(spark, {"event_id": "good", "timestamp": T0})).unionByName(bad))
    write = J.write_all_refused

    def look(batch, root, batch_id):
        seen.extend(rows(batch.select(F.col("_value").cast("string"), "problem")))
        write(batch, root, batch_id)

    monkeypatch.setattr(J, "write_all_refused", look)
    out = f"{feed.root}/out"
    live(feed, out)
    assert seen == [(None, None), ("junk", "malformed")]
    assert rows(spark.read.parquet(f"{out}/quarantine"), "value", "problem") == [("junk", "malformed")]
    assert rows(stored(spark, out, "readings"), "event_id") == [("good",)]
