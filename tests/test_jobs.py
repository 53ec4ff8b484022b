"""The scheduled jobs, each run twice."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rigpulse import schemas as C
from rigpulse.operators.alerts import limit_alerts
from rigpulse.operators import maintenance, retention
from rigpulse.operators.enrich import enrich
from rigpulse.operators.quality import GateFailed
from rigpulse.operators.windows import sliding_stats_by_pane
from rigpulse.plans import jobs
from rigpulse.session import RUNTIME_CONF, initial_partitions, scratch_dir
from rigpulse.sinks.tables import to_schema
from rigpulse.sources import decode as D
from rigpulse.sources import folders
from rigpulse.sources import tables as sources
from rigpulse.streaming import jobs as J
from rigpulse.streaming import totals as TO
from tests.helpers import BASE, equipment, events, plan, readings, rows, sites

T0 = datetime(2025, 1, 1)
AS_OF = "2025-01-02 00:00:00"
FLEET = [("m1", "s1", "haul_truck", 250, True), ("m2", "s1", "excavator", 500, True)]


def _day(spark, n=120):
    return readings(
        spark,
        *[
            {
                "equipment_id": f"m{1 + i % 2}",
                "timestamp": T0 + timedelta(minutes=5 * i),
                "hours_since_service": 240.0 + i * 0.1,
                "engine_temp_c": 101.0 if i % 10 == 0 else 90.0,
            }
            for i in range(n)
        ],
    )


def _empty(spark, schema, label):
    path = scratch_dir(spark, label)
    spark.createDataFrame([], schema).write.parquet(path)
    return path


def test_kpi_job_twice(spark):
    path = scratch_dir(spark, "kpi-job")
    frame = _day(spark)
    placed = to_schema(limit_alerts(frame), C.ALERTS)
    for _ in range(2):
        report = jobs.run_daily_kpi(frame, equipment(spark, *FLEET), placed, path, "2025-01-01")
        assert (report["row_count"], report["equipment_count"], report["kpi_rows"]) == (120, 2, 2)
    assert rows(spark.read.parquet(path), "equipment_id", "alert_count") == [("m1", 12), ("m2", 0)]


def test_kpi_job_stops_at_the_gate(spark):
    with pytest.raises(GateFailed):
        jobs.run_daily_kpi(
            _day(spark, 99), equipment(spark, *FLEET), limit_alerts(_day(spark)), "/unused", "2025-01-01"
        )


def test_maintenance_job_twice(spark):
    """On tables that do not exist before the first run."""
    root = scratch_dir(spark, "maintenance")
    alerts, logs = f"{root}/alerts", f"{root}/logs"
    for _ in range(2):
        counts, report = jobs.run_maintenance(
            _day(spark), equipment(spark, *FLEET), sites(spark, "s1"), alerts, logs, AS_OF
        )
        assert counts == {"total_equipment": 2, "due_count": 1, "overdue_count": 1}
        assert report.count() == 1
    assert rows(spark.read.parquet(alerts), "equipment_id", "severity", "acknowledged") == [
        ("m1", "CRITICAL", False)
    ]
    assert rows(spark.read.parquet(logs), "equipment_id", "service_date") == [("m1", date(2025, 1, 2))]


def test_service_alerts_look_up_one_day(spark, monkeypatch):
    """Each day adds its alert, and only that day's folder is looked up."""
    root = scratch_dir(spark, "maintenance-days")
    alerts, logs = f"{root}/alerts", f"{root}/logs"
    ranges = []
    read = jobs.sources.read_dated

    def noted(session, path, schema, column, start=None, end=None):
        if path == alerts:
            ranges.append((start, end))
        return read(session, path, schema, column, start, end)

    monkeypatch.setattr(jobs.sources, "read_dated", noted)
    times = ("2025-01-02 00:00:00", "2025-01-02 18:30:00", "2025-01-03 00:00:00")
    for as_of in times:
        jobs.run_maintenance(
            _day(spark), equipment(spark, *FLEET), sites(spark, "s1"), alerts, logs, as_of
        )
    assert [(a.day, b - a) for a, b in ranges] == [(d, timedelta(days=1)) for d in (2, 2, 3)]
    stored = read(spark, alerts, C.ALERTS, "triggered_at")
    assert rows(stored, "equipment_id", "triggered_at") == [
        ("m1", datetime(2025, 1, 2)), ("m1", datetime(2025, 1, 3))
    ]


def test_stored_rows_have_every_column_they_need(spark):
    """Seeds, service alerts and log entries violate no rule of their tables."""
    from rigpulse.operators.quality import column_rules, violations

    root = scratch_dir(spark, "maintenance-rules")
    jobs.run_maintenance(
        _day(spark), equipment(spark, *FLEET), sites(spark, "s1"), f"{root}/alerts", f"{root}/logs",
        AS_OF,
    )
    made = datetime(2025, 1, 1)
    stored = {
        "sites": jobs.sources.seed_sites(spark, made),
        "equipment": jobs.sources.seed_equipment(spark, made),
        "alerts": spark.read.parquet(f"{root}/alerts"),
        "maintenance_logs": spark.read.parquet(f"{root}/logs"),
    }
    for table, df in stored.items():
        rules = column_rules(
            C.NOT_NULL[table], C.MAX_LENGTHS[table], C.DOMAINS.get(table, {}), df.columns
        )
        assert rows(violations(df, rules).where("violations > 0")) == [], table


def test_service_alerts_join_the_streamed_ones(spark):
    root = scratch_dir(spark, "one-alerts-table")
    hot = {"engine_temp_c": 130.0, "timestamp": T0}
    D.encode(events(spark, hot)).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("key string, value binary, topic string, timestamp timestamp")
    J.drain(J.live_query(stream.parquet(f"{root}/in"), root, f"{root}/c", J.DRAIN))
    before = jobs.fleet_tables
    to_schema(equipment(spark, *FLEET), C.EQUIPMENT).write.parquet(f"{root}/equipment")
    to_schema(sites(spark, "s1"), C.SITES).write.parquet(f"{root}/sites")
    streamed = before(spark, root)["alerts"].count()
    jobs.run_maintenance(
        _day(spark), equipment(spark, *FLEET), sites(spark, "s1"), f"{root}/alerts", f"{root}/logs", AS_OF
    )
    assert before(spark, root)["alerts"].count() == streamed + 1


def test_bad_numbers_do_not_stop_the_stream(spark):
    root = scratch_dir(spark, "poison")
    stream = spark.readStream.schema("key string, value binary, topic string, timestamp timestamp")
    sent = [
        events(spark, {"event_id": "p1", "fuel_level_pct": 1000.0}, {"event_id": "p2", "fuel_level_pct": 999.996},
               {"event_id": "p3", "engine_temp_c": -10_000.0}, {"event_id": "g1", "fuel_level_pct": 999.99}),
        events(spark, {"event_id": "g2"}),
    ]
    for i, part in enumerate(sent):  # the second round restarts from the checkpoint
        D.encode(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        J.drain(J.live_query(stream.parquet(f"{root}/in"), root, f"{root}/c", J.DRAIN))
    assert rows(spark.read.parquet(f"{root}/readings"), "event_id") == [("g1",), ("g2",)]
    refused = spark.read.parquet(f"{root}/quarantine")
    assert rows(refused, "problem") == [("out_of_range",)] * 3


def test_numbers_that_are_not_finite(spark):
    frame = events(spark, *({"event_id": str(v), "engine_temp_c": v} for v in (float("nan"), float("inf"), 20.0, None)))
    bad = D.out_of_range(C.SENSOR_EVENT, C.SENSOR_READINGS)
    assert rows(frame.where(bad), "event_id") == [("inf",), ("nan",)]


def test_progress_log_keeps_every_batch(spark):
    from rigpulse.streaming.progress import ProgressLog

    root = scratch_dir(spark, "progress")
    for i in range(3):
        D.encode(events(spark, {"event_id": f"e{i}"})).coalesce(1).write.mode("append").parquet(f"{root}/in")
    log = ProgressLog(spark, f"{root}/log")
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(
            "key string, value binary, topic string, timestamp timestamp"
        )
        J.drain(J.live_query(stream.parquet(f"{root}/in"), root, f"{root}/c", J.DRAIN))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        assert log.read().agg(F.sum("input_rows")).first()[0] == 3
    finally:
        spark.streams.removeListener(log)


@pytest.mark.parametrize("words", [["stream", "--root", "r"], ["daily-kpi", "--root", "r", "--as-of", "soon"]])
def test_job_arguments_are_checked(words):
    with pytest.raises(SystemExit):
        jobs.main(words)


def test_health_job(spark):
    frame = _day(spark).limit(5).withColumn("recorded_at", F.lit("2025-01-01 23:59:00").cast("timestamp"))
    alerts = to_schema(limit_alerts(frame), C.ALERTS)
    assert jobs.run_health_check(frame, alerts, AS_OF, minimum=5)["recent_rows"] == 5
    with pytest.raises(GateFailed):
        jobs.run_health_check(frame, alerts, AS_OF, minimum=6)


def _stored_months(spark, root):
    """Readings of three months through the stream, a row for each day of some."""
    times = [datetime(2025, m, d) for m in (1, 2, 6) for d in (1, 15, 28)]
    D.encode(events(spark, *[{"event_id": f"r{i}", "timestamp": t} for i, t in enumerate(times)])).write.mode("append").parquet(f"{root}/in")
    _stream_in(spark, root)


def _stream_in(spark, root):
    stream = spark.readStream.schema("key string, value binary, topic string, timestamp timestamp")
    J.drain(J.live_query(stream.parquet(f"{root}/in"), root, f"{root}/c", J.DRAIN))


def _ids(spark, path):
    return rows(sources.read_dated(spark, path, C.SENSOR_READINGS, "recorded_at"), "event_id")


def test_retention_job(spark):
    root = scratch_dir(spark, "retention-job")
    _stored_months(spark, root)
    before = TO.totals(spark, root).where("table = 'readings'").agg(F.sum("rows")).first()[0]
    done = jobs.run_retention(spark, root, "2025-06-15 00:00:00")
    assert rows(done, "partition_name", "rows", "expired") == [
        ("sensor_readings_2025_01", 3, True),
        ("sensor_readings_2025_02", 3, True),
        ("sensor_readings_2025_06", 3, False),
    ]
    assert _ids(spark, f"{root}/readings") == [(f"r{i}",) for i in (6, 7, 8)]
    assert _ids(spark, f"{root}/expired") == [(f"r{i}",) for i in range(6)]
    day = sources.read_dated(
        spark, f"{root}/readings", C.SENSOR_READINGS, "recorded_at", datetime(2025, 6, 15), datetime(2025, 6, 16)
    )
    assert rows(day, "event_id") == [("r7",)]
    after = TO.totals(spark, root).where("table = 'readings'").agg(F.sum("rows")).first()[0]
    assert (before, after) == (9, 3)
    # A late row of an archived day, then the job twice more.
    D.encode(events(spark, {"event_id": "late", "timestamp": datetime(2025, 1, 15)})).write.mode("append").parquet(f"{root}/in")
    _stream_in(spark, root)
    for _ in range(2):
        jobs.run_retention(spark, root, "2025-06-15 00:00:00")
    assert _ids(spark, f"{root}/expired") == sorted([("late",), *[(f"r{i}",) for i in range(6)]])
    assert TO.totals(spark, root).where("table = 'readings'").agg(F.sum("rows")).first()[0] == 3


@pytest.mark.parametrize("at", ["note_dropped", "drop"])
def test_retention_that_ended_in_between(spark, monkeypatch, at):
    """After the copy, and after half of the folders were dropped."""
    root = scratch_dir(spark, "retention-crash")
    _stored_months(spark, root)
    where, calls = (TO, []) if at == "note_dropped" else (folders, [])
    real = getattr(where, at)

    def failing(*args):
        calls.append(args)
        if at == "note_dropped" or len(calls) > 3:
            raise OSError("stopped")
        return real(*args)

    monkeypatch.setattr(where, at, failing)
    with pytest.raises(OSError):
        jobs.run_retention(spark, root, "2025-06-15 00:00:00")
    monkeypatch.setattr(where, at, real)
    jobs.run_retention(spark, root, "2025-06-15 00:00:00")
    assert _ids(spark, f"{root}/readings") == [(f"r{i}",) for i in (6, 7, 8)]
    assert _ids(spark, f"{root}/expired") == [(f"r{i}",) for i in range(6)]
    assert TO.totals(spark, root).where("table = 'readings'").agg(F.sum("rows")).first()[0] == 3


def test_retention_opens_no_folder_that_stays(spark, tmp_path):
    root = str(tmp_path / "t")
    _stored_months(spark, root)
    kept = next((tmp_path / "t/readings/on_day=2025-06-15").rglob("part-*.parquet"))
    kept.write_bytes(b"not parquet")
    for crc in kept.parent.glob(".*.crc"):
        crc.write_bytes(b"")
    jobs.run_retention(spark, root, "2025-06-15 00:00:00")
    assert _ids(spark, f"{root}/expired") == [(f"r{i}",) for i in range(6)]
    assert kept.read_bytes() == b"not parquet"


def test_retention_refuses_a_copy_that_differs(spark, monkeypatch):
    root = scratch_dir(spark, "retention-differs")
    _stored_months(spark, root)
    write = retention.overwrite_partitions
    monkeypatch.setattr(retention, "overwrite_partitions", lambda df, *a: write(df.where("event_id <> 'r1'"), *a))
    with pytest.raises(retention.ArchiveIncomplete):
        jobs.run_retention(spark, root, "2025-06-15 00:00:00")
    assert len(_ids(spark, f"{root}/readings")) == 9


def test_kpi_job_from_streamed_tables(spark):
    root = scratch_dir(spark, "fleet")
    sent = events(spark, *[{"event_id": f"e{i}", "timestamp": T0 + timedelta(minutes=i)} for i in range(150)])
    D.encode(sent).write.parquet(f"{root}/in")
    stream = spark.readStream.schema("key string, value binary, topic string, timestamp timestamp")
    J.drain(J.live_query(stream.parquet(f"{root}/in"), root, f"{root}/c", J.DRAIN))
    to_schema(equipment(spark, *FLEET), C.EQUIPMENT).write.parquet(f"{root}/equipment")
    to_schema(sites(spark, "s1"), C.SITES).write.parquet(f"{root}/sites")
    t = jobs.fleet_tables(spark, root, date(2025, 1, 1))
    report = jobs.run_daily_kpi(t["readings"], t["equipment"], t["alerts"], f"{root}/kpi", "2025-01-01")
    assert report["row_count"] == 150
    # Without a standing table the newest readings come from the history, else from the table.
    assert t["newest"].count() == t["readings"].count()
    J.drain(J.latest_query(stream.parquet(f"{root}/in"), f"{root}/latest", f"{root}/c2", J.DRAIN))
    standing = jobs.fleet_tables(spark, root)
    assert standing["newest"].count() == standing["newest"].select("equipment_id").distinct().count()
    from_history, served = (
        maintenance.service_list(standing[n], t["equipment"], t["sites"]) for n in ("readings", "newest")
    )
    assert rows(served, "equipment_id", "service_status") == rows(from_history, "equipment_id", "service_status")


def test_partitions_grow_with_the_cluster():
    assert [initial_partitions(n) for n in (8, 4_000, 100_000)] == [2_000, 16_000, 400_000]
    assert initial_partitions(8, 100 << 40) == 819_200


def test_windows_with_the_large_state_store(spark):
    root = scratch_dir(spark, "rocksdb")
    D.encode(events(spark, {}, {"timestamp": T0 + timedelta(minutes=2)})).write.parquet(f"{root}/in")
    try:
        for key, value in J.STATE_STORE_CONF.items():
            spark.conf.set(key, value)
        stream = spark.readStream.schema("key string, value binary, topic string, timestamp timestamp")
        J.drain(J.window_query(stream.parquet(f"{root}/in"), f"{root}/w", f"{root}/c", J.DRAIN))
    finally:
        for key in J.STATE_STORE_CONF:
            spark.conf.unset(key)
    assert J.current_windows(spark, f"{root}/w").count() == 7


def test_hot_machine_join_is_split_before_grouping(spark):
    """A machine with most rows, joined to a dimension too large to broadcast, then grouped."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in {**small, **RUNTIME_CONF}.items():
            spark.conf.set(key, value)
        base = {k: v for k, v in BASE.items() if k not in ("equipment_id", "equipment_type", "site_id")}
        n = F.col("id")
        spread = F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), n % 500))
        facts = spark.range(0, 60_000, numPartitions=8).select(
            spread.alias("equipment_id"),
            *[F.lit(v).alias(k) for k, v in base.items() if k != "timestamp"],
            F.timestamp_seconds(n + 1_735_689_600).alias("timestamp"),
        )
        name = F.when(n == 500, F.lit("hot")).otherwise(F.concat(F.lit("m"), n))
        machines = spark.range(0, 501).select(
            name.alias("equipment_id"), F.lit("s1").alias("site_id"), F.lit("t").alias("equipment_type")
        )
        stats = sliding_stats_by_pane(enrich(facts.join(machines, "equipment_id")))
        total = stats.agg(F.sum("reading_count"))
        assert total.collect()[0][0] == 5 * 60_000
        assert "SortMergeJoin(skew=true)" in plan(total)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
