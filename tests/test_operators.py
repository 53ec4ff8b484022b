"""Latest, feed, windows, KPI, health, maintenance, quality, retention on small frames."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rigpulse.operators import alerts as A
from rigpulse.operators import health as H
from rigpulse.operators import kpi as K
from rigpulse.operators import latest as L
from rigpulse.operators import maintenance as M
from rigpulse.operators import quality as Q
from rigpulse.operators import retention as N
from rigpulse.operators import windows as W
from rigpulse.operators.enrich import enrich
from rigpulse.plans import reads as P
from rigpulse.session import scratch_dir
from tests.helpers import equipment, events, plan, readings, rows, sites

T0 = datetime(2025, 1, 1)
AS_OF = "2025-01-02 00:00:00"
FLEET = [
    ("m1", "s1", "haul_truck", 250, True),
    ("m2", "s1", "haul_truck", 250, True),
    ("m3", "s2", "excavator", 500, True),
    ("off", "s2", "excavator", 500, False),
]


def at(**shift):
    return T0 + timedelta(**shift)


# Latest and feed


def test_latest_settles_equal_times_by_id(spark):
    frame = readings(
        spark,
        {"event_id": "a", "timestamp": at(hours=2), "status": "idle"},
        {"event_id": "b", "timestamp": at(hours=2), "status": "fault"},
        {"event_id": "c", "timestamp": at(hours=1)},
        {"event_id": "d", "equipment_id": "m2", "engine_temp_c": None},
    )
    newest = L.latest_per_key(frame)
    assert rows(newest, "equipment_id", "event_id", "status") == [
        ("m1", "b", "fault"),
        ("m2", "d", "operating"),
    ]


def test_latest_drops_unknown_and_keeps_inactive_machines(spark):
    frame = readings(spark, {}, {"equipment_id": "ghost"}, {"equipment_id": "off"})
    newest = P.equipment_latest(frame, equipment(spark, *FLEET))
    assert rows(newest, "equipment_id", "site_id") == [("m1", "s1"), ("off", "s2")]


def test_status_filter_applies_to_the_newest_reading(spark):
    frame = readings(
        spark, {"status": "fault"}, {"timestamp": at(hours=1), "status": "operating"}
    )
    machines = equipment(spark, *FLEET)
    assert P.equipment_latest(frame, machines, status="fault").count() == 0
    assert P.equipment_latest(frame, machines, site_id="s1", status="operating").count() == 1
    assert P.equipment_latest(frame, machines, site_id="s2").count() == 0


def test_history_bounds(spark):
    frame = readings(
        spark,
        {"timestamp": at(hours=0)},
        {"timestamp": at(hours=23)},
        {"timestamp": at(hours=-1)},
        {"equipment_id": "m2", "timestamp": at(hours=23)},
    )
    found = [r.recorded_at for r in L.history(frame, "m1", AS_OF).collect()]
    assert found == [at(hours=0), at(hours=23)]
    assert L.history(frame, "nobody", AS_OF).count() == 0
    for hours in (0, 169):
        with pytest.raises(ValueError):
            L.history(frame, "m1", AS_OF, hours)


def _random_events(spark, n, seed, machines=("hot", "hot", "hot", "m1", "m2"), span=3 * 3600):
    rng = random.Random(seed)
    return events(
        spark,
        *[
            {
                "equipment_id": rng.choice(machines),
                "timestamp": T0 + timedelta(seconds=rng.randrange(-span, span)),
                "engine_temp_c": rng.choice([None, round(rng.uniform(80, 120), 2)]),
                "fuel_level_pct": round(rng.uniform(0, 100), 1),
                "status": rng.choice(["operating", "idle", None]),
            }
            for _ in range(n)
        ],
    )


@pytest.mark.parametrize("partitions", ["1", "13"])
def test_ordinals_equal_a_plain_count(spark, partitions):
    frame = _random_events(spark, 400, 1).withColumnRenamed("timestamp", "recorded_at")
    settings = {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {r.event_id: r.ordinal for r in L.numbered(frame).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected, seen = {}, {}
    for r in sorted(frame.collect(), key=lambda r: (r.equipment_id, r.recorded_at, r.event_id)):
        seen[r.equipment_id] = seen.get(r.equipment_id, 0) + 1
        expected[r.event_id] = seen[r.equipment_id]
    assert found == expected


def test_status_feed_takes_every_tenth_of_each_machine(spark):
    changes = [{"equipment_id": m, "timestamp": at(minutes=i)} for i in range(25) for m in ("m1", "m2")]
    feed = L.status_feed(readings(spark, *changes), equipment(spark, *FLEET))
    assert rows(feed, "equipment_id", "timestamp") == [
        (m, at(minutes=i)) for m in ("m1", "m2") for i in (9, 19)
    ]


# Windows


def test_minute_boundary_lies_in_five_windows(spark):
    stats = W.sliding_stats_by_pane(enrich(events(spark, {"timestamp": at(minutes=10)})))
    found = [r[0] for r in rows(stats, "window_start")]
    assert found == [at(minutes=m) for m in range(6, 11)]


@pytest.mark.parametrize("length,slide,chunk", [(5, 1, 240), (5, 1, 7), (5, 1, 5), (6, 2, 1), (5, 5, 3)])
def test_panes_equal_single_pass_and_brute_force(spark, length, slide, chunk):
    frame = enrich(_random_events(spark, 300, 2)).cache()
    one = W.sliding_stats(frame, length, slide)
    panes = W.sliding_stats_by_pane(frame, length, slide, chunk)

    def rounded(df):
        doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
        return rows(df.withColumns({c: F.round(c, 6) for c in doubles}))

    assert rounded(panes) == rounded(one)

    counts = {}
    for r in frame.collect():
        minute = int((r.timestamp - datetime(2000, 1, 1)).total_seconds() // 60)
        last = minute - minute % slide
        for start in range(last - length + slide, last + 1, slide):
            counts[(r.equipment_id, start)] = counts.get((r.equipment_id, start), 0) + 1
    found = {
        (r.equipment_id, int((r.window_start - datetime(2000, 1, 1)).total_seconds() // 60)): r.reading_count
        for r in panes.collect()
    }
    assert found == counts


def test_windows_of_missing_and_odd_values(spark):
    odd = [None, float("nan"), -0.0, 7.0, float("inf")]
    changes = [
        {"engine_temp_c": odd[i % 5], "fuel_level_pct": odd[i % 3], "site_id": ["s", None][i % 2], "timestamp": at(minutes=3 * i)}
        for i in range(15)
    ]
    frame = enrich(events(spark, *changes, {"fuel_level_pct": None, "timestamp": at(days=1)}))
    text = lambda df: rows(df.select([F.col(c).cast("string") for c in df.columns]))
    assert text(W.sliding_stats_by_pane(frame, chunk=4)) == text(W.sliding_stats(frame))


def test_no_task_holds_the_windows_of_its_panes(spark):
    """Only the panes are hashed; windows, five to a pane, leave one by one."""
    assert plan(W.sliding_stats_by_pane(enrich(events(spark, {})))).count("HashAggregate(") == 2


def test_pane_length_must_fit(spark):
    with pytest.raises(ValueError):
        W.sliding_stats_by_pane(enrich(events(spark, {})), 5, 2)


# KPI


def test_kpi_day_edges_nulls_and_missing_alerts(spark):
    frame = readings(
        spark,
        {"timestamp": at(), "status": "operating"},
        {"timestamp": at(hours=23, minutes=59, seconds=59, microseconds=999999), "status": "fault"},
        {"timestamp": at(days=1), "status": "idle"},
        {"timestamp": at(microseconds=-1), "status": "idle"},
        {"equipment_id": "m2", "status": None},
        {"equipment_id": "ghost", "status": "unheard-of"},
    )
    hot = events(spark, {"timestamp": at(hours=1), "engine_temp_c": 120.0, "fuel_level_pct": 10.0})
    kpis = K.daily_kpi(frame, equipment(spark, *FLEET), A.limit_alerts(hot), "2025-01-01")
    found = {r.equipment_id: r for r in kpis.collect()}
    assert set(found) == {"m1", "m2", "ghost"}
    m1 = found["m1"]
    assert (m1.operating_hours, m1.idle_hours, m1.fault_hours) == (1 / 360, 0.0, 1 / 360)
    assert (m1.alert_count, m1.critical_alert_count) == (2, 1)
    assert m1.total_payload_tonnes is None and m1.avg_drill_rpm is None
    assert m1.uptime_pct == 0.01 and m1.total_fuel_litres == 200.0
    assert (found["m2"].alert_count, found["m2"].critical_alert_count) == (0, 0)
    assert found["m2"].operating_hours == 0.0
    assert found["ghost"].site_id is None


def test_kpi_history_is_inclusive(spark):
    days = [(f"m{i}", "s1", date(2025, 1, 10) - timedelta(days=i)) for i in range(10)]
    kpis = spark.createDataFrame(days, "equipment_id string, site_id string, kpi_date date")
    assert P.daily_kpis(kpis, "2025-01-10", days=7).count() == 8
    assert P.daily_kpis(kpis, "2025-01-10", days=7, equipment_id="m3").count() == 1
    assert P.daily_kpis(kpis, "2025-01-10", days=7, site_id="s9").count() == 0
    with pytest.raises(ValueError):
        P.daily_kpis(kpis, "2025-01-10", days=91)


def test_default_target_date():
    assert K.default_target_date("2025-01-01 00:30:00") == date(2024, 12, 31)


# Alerts


def _alerts(spark, *changes):
    base = dict(alert_id="a", equipment_id="m1", site_id="s1", triggered_at=T0, alert_type="X",
                severity="WARNING", metric="m", value=1.0, threshold=2.0, message="x", resolved_at=None)
    fields = ("alert_id string, equipment_id string, site_id string, triggered_at timestamp, "
              "alert_type string, severity string, metric string, value double, threshold double, "
              "message string, resolved_at timestamp")
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], fields)


def test_open_alerts_priority_and_limit(spark):
    frame = _alerts(
        spark,
        {"alert_id": "old", "triggered_at": at(hours=1), "severity": "CRITICAL"},
        {"alert_id": "new", "triggered_at": at(hours=2), "severity": "CRITICAL"},
        {"alert_id": "warn", "triggered_at": at(hours=3)},
        {"alert_id": "odd", "triggered_at": at(hours=4), "severity": "?"},
        {"alert_id": "done", "resolved_at": at(hours=5)},
        {"alert_id": "nowhere", "site_id": "s9"},
    )
    found = P.open_alerts(frame, sites(spark, "s1"), AS_OF).collect()
    assert [r.alert_id for r in found] == ["new", "old", "warn", "odd"]
    assert found[0].hours_open == 22.0
    top = P.open_alerts(frame, sites(spark, "s1"), AS_OF, limit=2).collect()
    assert [r.alert_id for r in top] == ["new", "old"]
    only = P.open_alerts(frame, sites(spark, "s1"), AS_OF, severity="WARNING", site_id="s1")
    assert rows(only, "alert_id") == [("warn",)]


def test_resolve_twice_and_unknown_id(spark):
    frame = _alerts(spark, {"alert_id": "a"}, {"alert_id": "b", "resolved_at": at(hours=1)}, {"alert_id": "c"})
    ids = spark.createDataFrame([("a",), ("a",), ("b",), ("zz",)], "alert_id string")
    once = A.resolve(frame, ids, AS_OF)
    twice = A.resolve(once, ids, "2025-03-03 00:00:00")
    expected = [("a", datetime(2025, 1, 2)), ("b", at(hours=1)), ("c", None)]
    assert rows(once, "alert_id", "resolved_at") == expected
    assert rows(twice, "alert_id", "resolved_at") == expected
    assert once.columns == frame.columns


def test_alert_stats_boundary_and_order(spark):
    frame = _alerts(
        spark,
        {"triggered_at": at()},
        {"triggered_at": at(microseconds=-1)},
        {"triggered_at": at(hours=1), "severity": "CRITICAL"},
    )
    found = [tuple(r) for r in P.alert_stats(frame, AS_OF).collect()]
    assert found == [("s1", "WARNING", 1), ("s1", "CRITICAL", 1)]


# Health


def test_fleet_health_keeps_silent_machines(spark):
    frame = readings(spark, {"status": "fault", "fuel_level_pct": 50.25}, {"equipment_id": "off"})
    found = H.fleet_health(frame, equipment(spark, *FLEET), sites(spark, "s1", "s2"), with_idle=True)
    assert rows(found, "site_id", "total_machines", "operating", "in_fault", "idle", "avg_fuel_pct") == [
        ("s1", 2, 0, 1, 0, 50.3),
        ("s2", 1, 0, 0, 0, None),
    ]


@pytest.mark.parametrize("recent,healthy", [(9, False), (10, True)])
def test_ingest_recency(spark, recent, healthy):
    changes = [{"timestamp": at(hours=24, minutes=-5)}] * recent
    frame = readings(spark, *changes, {"timestamp": at(hours=24, minutes=-5, microseconds=-1)})
    assert rows(H.ingest_recency(frame, AS_OF)) == [(recent, healthy)]


def test_ingest_stats_of_empty_tables(spark):
    empty = readings(spark, {}).where(F.lit(False))
    frame = H.ingest_stats(empty, equipment(spark, *FLEET), _alerts(spark, {}).where("false"), AS_OF)
    assert rows(frame) == [(0, 0, 0, 0, 0, 0, None)]


def test_one_machine_in_fault_counted_once(spark):
    frame = readings(
        spark,
        {"status": "fault"},
        {"timestamp": at(hours=1), "status": "fault"},
        {"equipment_id": "ghost", "status": "fault"},
        {"equipment_id": "m2", "status": "fault"},
        {"equipment_id": "m2", "timestamp": at(hours=1), "status": "idle"},
    )
    assert rows(H.fault_count(frame, equipment(spark, *FLEET))) == [(1,)]


# Maintenance


def _services(spark):
    frame = readings(
        spark,
        {"hours_since_service": 230.5},
        {"equipment_id": "m3", "hours_since_service": 500.0},
        {"equipment_id": "off", "hours_since_service": 900.0},
    )
    return M.service_list(frame, equipment(spark, *FLEET), sites(spark, "s1", "s2"))


def test_service_list_order_and_counts(spark):
    services = _services(spark)
    found = [(r.equipment_id, r.service_status) for r in services.collect()]
    assert found == [("m3", "OVERDUE"), ("m1", "DUE_SOON"), ("m2", "OK")]
    assert rows(M.service_counts(services)) == [(3, 2, 1)]


def test_service_alert_text(spark):
    found = {r.equipment_id: r for r in M.service_alerts(_services(spark), AS_OF).collect()}
    assert found["m1"].message == (
        "WARNING: m1 (model-m1) at site s1 — 230h since last service (interval: 250h)"
    )
    assert (found["m3"].severity, found["m3"].value, found["m3"].threshold) == ("CRITICAL", 500.0, 500.0)
    again = M.service_alerts(_services(spark), "2025-01-02 09:00:00")
    assert rows(again, "alert_id") == sorted((r.alert_id,) for r in found.values())
    report = [r.line for r in M.service_report(_services(spark)).collect()]
    assert report == ["[OVERDUE] m3 — 500h / 500h — site s2", "[DUE_SOON] m1 — 230h / 250h — site s1"]


def test_second_maintenance_run_adds_no_log(spark):
    empty = spark.createDataFrame([], "equipment_id string, service_date date")
    first = M.service_logs(_services(spark), empty, AS_OF)
    assert rows(first, "equipment_id", "service_date", "hours_at_service", "next_service_due") == [
        ("m3", date(2025, 1, 2), 500.0, 1000.0)
    ]
    assert M.service_logs(_services(spark), first, AS_OF).count() == 0
    assert M.service_logs(_services(spark), first, "2025-01-03 00:00:00").count() == 1


# Quality


@pytest.mark.parametrize("n,passed", [(99, False), (100, True)])
def test_source_gate(spark, n, passed):
    frame = readings(spark, *[{"equipment_id": f"m{i % 7}"} for i in range(n)], {"timestamp": at(days=1)})
    report = Q.source_gate(frame, "2025-01-01")
    assert rows(report) == [(n, 7, passed)]
    if passed:
        assert Q.require(report)["row_count"] == n
    else:
        with pytest.raises(Q.GateFailed):
            Q.require(report)


def test_output_gate_of_no_rows(spark):
    kpis = spark.createDataFrame([], "kpi_date date, uptime_pct double, alert_count bigint")
    assert rows(Q.output_gate(kpis, "2025-01-01")) == [(0, 0.0, 0.0, False)]


def test_orphans_ignore_nulls(spark):
    frame = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(Q.orphans(frame, parent, "k")) == [("b", 2)]


def test_column_rules(spark):
    frame = spark.createDataFrame([("ok", "x"), (None, "toolong"), ("bad", None)], "s string, t string")
    rules = Q.column_rules(["s", "t"], {"t": 3}, {"s": ["ok"]})
    assert rows(Q.violations(frame, rules)) == [
        ("domain:s", 1),
        ("max_length:t", 1),
        ("not_null:s", 1),
        ("not_null:t", 1),
    ]


# Retention


def test_retention_looks_at_the_month_end(spark):
    frame = readings(spark, *[{"timestamp": datetime(2024, m, 15)} for m in (9, 10, 11)])
    # 91 days before 2024-12-31 is 2024-10-01; 90 days before it is 2024-10-02.
    strict = N.retention_plan(frame, "2024-12-31 00:00:00")
    legacy = N.retention_plan(frame, "2024-12-31 00:00:00", legacy=True)
    assert [r[1] for r in rows(strict, "partition_name", "expired")] == [True, False, False]
    assert [r[1] for r in rows(legacy, "partition_name", "expired")] == [True, True, False]


def test_expired_names_skip_what_they_cannot_read(spark):
    names = ["sensor_readings_2020_01", "sensor_readings_2099_01", "sensor_readings_default", "odd_2020_99"]
    frame = spark.createDataFrame([(n,) for n in names], "partition_name string")
    assert rows(N.expired_names(frame, AS_OF), "partition_name") == [("sensor_readings_2020_01",)]


def test_route_to_declared_months(spark):
    frame = readings(spark, {"timestamp": datetime(2024, 12, 31)}, {"timestamp": datetime(2024, 11, 30)})
    assert rows(N.route_months(frame), "partition_name") == [
        ("sensor_readings_2024_12",),
        ("sensor_readings_default",),
    ]


def test_retention_apply_keeps_every_row_once(spark):
    times = [datetime(2024, 9, 1), datetime(2024, 9, 30), datetime(2024, 12, 1), None]
    frame = readings(spark, *[{"timestamp": t} for t in times])
    root = scratch_dir(spark, "retention-test")
    for _ in range(2):
        kept = N.apply_retention(spark, frame, AS_OF, f"{root}/a", f"{root}/k")
        assert rows(kept, "event_id") == [("e0002",), ("e0003",)]
        assert kept.columns == frame.columns
        assert rows(spark.read.parquet(f"{root}/a"), "event_id") == [("e0000",), ("e0001",)]


def test_retention_keeps_earlier_archives(spark):
    root = scratch_dir(spark, "retention-twice")
    earlier = readings(spark, {"event_id": "old", "timestamp": datetime(2024, 8, 1)})
    later = readings(spark, {"event_id": "new", "timestamp": datetime(2024, 9, 1)})
    for frame in (earlier, later):
        N.apply_retention(spark, frame, AS_OF, f"{root}/a", f"{root}/k")
    assert rows(spark.read.parquet(f"{root}/a"), "event_id") == [("new",), ("old",)]


def test_late_rows_of_an_archived_month_join_it(spark):
    root = scratch_dir(spark, "retention-late")
    month = readings(spark, *[{"event_id": f"a{i}", "timestamp": datetime(2024, 8, 1)} for i in range(5)])
    late = readings(spark, {"event_id": "late", "timestamp": datetime(2024, 8, 2)})
    for frame in (month, late, late):
        N.apply_retention(spark, frame, AS_OF, f"{root}/a", f"{root}/k")
    assert len(rows(spark.read.parquet(f"{root}/a"), "event_id")) == 6


def test_retention_with_nothing_expired(spark):
    frame = readings(spark, {})
    root = scratch_dir(spark, "retention-empty")
    assert N.apply_retention(spark, frame, AS_OF, f"{root}/a", f"{root}/k").count() == 1


# Plans


def test_latest_combines_before_the_shuffle(spark):
    text = plan(L.latest_per_key(readings(spark, {})))
    assert text.count("SortAggregate") == 2 and "partial_max_by" in text


def test_kpi_combines_by_hash(spark):
    text = plan(K.measures(readings(spark, {})))
    assert text.count("HashAggregate") == 2 and "Sort" not in text


def test_day_filter_reaches_the_scan(spark):
    path = scratch_dir(spark, "scan")
    readings(spark, {}).write.parquet(path)
    found = K.daily_kpi(spark.read.parquet(path), equipment(spark, *FLEET), _alerts(spark, {}), "2025-01-01")
    scan = [line for line in plan(found).splitlines() if "FileScan" in line][0]
    assert "GreaterThanOrEqual(recorded_at,2025-01-01" in scan
    assert "LessThan(recorded_at,2025-01-02" in scan
    assert "oil_pressure_kpa" not in scan


def test_views_answer_sql(spark):
    P.register_views(
        readings(spark, {}), equipment(spark, *FLEET), sites(spark, "s1"), _alerts(spark, {}), AS_OF
    )
    found = spark.sql("SELECT status FROM vw_equipment_latest")
    assert rows(found) == [("operating",)]
    assert spark.sql("SELECT * FROM vw_open_alerts").count() == 1
    assert spark.sql("SELECT * FROM vw_site_fleet_health").count() == 1
