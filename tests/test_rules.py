"""Threshold rules at, below and above their limits."""

import pytest
from pyspark.sql import functions as F

from rigpulse.functions import rules as R
from rigpulse.functions.text import month_from_name, plain, whole
from rigpulse.operators.alerts import flag_alerts, limit_alerts
from rigpulse.operators.enrich import enrich
from tests.helpers import events, rows

NULLS = dict(
    engine_temp_c=None,
    vibration_mm_s=None,
    oil_pressure_kpa=None,
    fuel_level_pct=None,
    hours_since_service=None,
)


@pytest.mark.parametrize("rule", R.FLAG_RULES, ids=lambda r: r.flag)
def test_flag_limits_are_strict(spark, rule):
    sign = 1 if rule.op == ">" else -1
    values = [rule.limit - sign * 0.001, rule.limit, rule.limit + sign * 0.001]
    frame = enrich(events(spark, *[{**NULLS, rule.metric: v} for v in values]))
    fired = [rule.flag in (r.anomaly_flags) for r in frame.orderBy("event_id").collect()]
    assert fired == [False, False, True]


@pytest.mark.parametrize("rule", R.LIMIT_RULES, ids=lambda r: r.alert_type)
def test_limit_levels(spark, rule):
    sign = 1 if rule.op == ">" else -1
    step = sign * 0.5
    values = [rule.warning, rule.warning + step, rule.critical, rule.critical + step]
    frame = limit_alerts(events(spark, *[{**NULLS, rule.metric: float(v)} for v in values]))
    found = {r.event_id: (r.severity, r.threshold) for r in frame.collect()}
    assert found == {
        "e0001": ("WARNING", rule.warning),
        "e0002": ("WARNING", rule.warning),
        "e0003": ("CRITICAL", rule.critical),
    }


def test_no_metric_no_flag(spark):
    frame = enrich(events(spark, NULLS))
    assert rows(frame, "has_anomaly", "is_critical") == [(False, False)]
    assert frame.first().anomaly_flags == [None] * 9
    assert flag_alerts(events(spark, NULLS)).count() == 0
    assert limit_alerts(events(spark, NULLS)).count() == 0


def test_warning_alone_is_not_critical(spark):
    frame = enrich(events(spark, {"engine_temp_c": 101.0}, {"engine_temp_c": 106.0}))
    assert rows(frame, "event_id", "has_anomaly", "is_critical") == [
        ("e0000", True, False),
        ("e0001", True, True),
    ]


SAMPLE = dict(engine_temp_c=106.2, fuel_level_pct=4.9, hours_since_service=251.0)


def test_flag_alerts_of_one_reading(spark):
    found = flag_alerts(events(spark, SAMPLE))
    assert rows(found, "alert_type", "severity", "metric", "value", "threshold", "message") == [
        ("CRITICAL_LOW_FUEL", "CRITICAL", "fuel_level_pct", 4.9, 5.0, "m1: CRITICAL_LOW_FUEL"),
        ("HIGH_ENGINE_TEMP", "CRITICAL", "engine_temp_c", 106.2, 105.0, "m1: HIGH_ENGINE_TEMP"),
        ("SERVICE_DUE", "WARNING", "hours_since_service", 251.0, 250.0, "m1: SERVICE_DUE"),
        ("WARN_ENGINE_TEMP", "WARNING", "engine_temp_c", 106.2, 100.0, "m1: WARN_ENGINE_TEMP"),
        ("WARN_LOW_FUEL", "WARNING", "fuel_level_pct", 4.9, 15.0, "m1: WARN_LOW_FUEL"),
    ]


def test_limit_alerts_of_one_reading(spark):
    found = limit_alerts(events(spark, SAMPLE))
    assert rows(found, "alert_type", "severity", "message") == [
        ("HIGH_ENGINE_TEMP", "WARNING", "WARNING: m1 engine_temp_c=106.2 (threshold=100)"),
        ("LOW_FUEL", "CRITICAL", "CRITICAL: m1 fuel_level_pct=4.9 (threshold=5)"),
    ]


def test_alert_ids_repeat_on_a_second_run(spark):
    first, second = (rows(flag_alerts(events(spark, SAMPLE)), "alert_id") for _ in range(2))
    assert first == second and len(set(first)) == 5


def test_service_status_steps(spark):
    frame = spark.createDataFrame(
        [(None, 250.0), (229.9, 250.0), (230.0, 250.0), (250.0, 250.0), (459.0, 500.0), (460.0, 500.0)],
        "h double, i double",
    )
    found = [r[0] for r in frame.select(R.service_status(F.col("h"), F.col("i"))).collect()]
    assert found == ["OK", "OK", "DUE_SOON", "OVERDUE", "OK", "DUE_SOON"]


def test_bands(spark):
    frame = spark.createDataFrame([(v,) for v in (0, 1, 4, 5, None)], "n int")
    found = [r[0] for r in frame.select(R.band(F.col("n"), R.ALERT_COUNT_BANDS)).collect()]
    assert found == ["green", "orange", "orange", "red", None]


def test_severity_orders(spark):
    frame = spark.createDataFrame([("WARNING",), ("CRITICAL",), ("other",)], "s string")
    s = F.col("s")
    found = frame.select(R.severity_priority(s), R.severity_order(s)).collect()
    assert [tuple(r) for r in found] == [(2, 1), (1, 2), (None, 0)]


def test_whole_numbers_round_halves_to_even(spark):
    frame = spark.createDataFrame([(230.5,), (231.5,), (0.4,)], "h double")
    assert [r[0] for r in frame.select(whole(F.col("h"))).collect()] == ["230", "232", "0"]


def test_month_names(spark):
    names = ["sensor_readings_2024_01", "sensor_readings_2024_1", "sensor_readings_2024_13",
             "sensor_readings_default", "readings", "sensor_readings_abcd_01"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    found = [str(r[0]) for r in frame.select(month_from_name(F.col("n"))).collect()]
    assert found == ["2024-01-01", "2024-01-01", "None", "None", "None", "None"]


def test_limits_print_without_exponent_or_trailing_zeros(spark):
    frame = spark.createDataFrame([(10.0,), (10.5,), (1e7,), (0.25,), (0.0,), (-3.0,)], "x double")
    printed = [r[0] for r in frame.select(plain(F.col("x"))).collect()]
    assert printed == ["10", "10.5", "10000000", "0.25", "0", "-3"]
