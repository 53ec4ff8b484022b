"""Fleet health, ingest figures and dashboard panels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.functions.rules import ALERT_COUNT_BANDS, TEMPERATURE_BANDS, band
from rigpulse.functions.time import between_times, trailing
from rigpulse.operators.latest import latest_per_key

# Fixed value: fewest rows in five minutes of a healthy ingest.
MIN_RECENT_ROWS = 10


def fleet_health(
    readings: DataFrame, equipment: DataFrame, sites: DataFrame, *, with_idle: bool = False
) -> DataFrame:
    """Active machines per site and type: counts by status and averages of the newest readings."""
    columns = ["status", "fuel_level_pct", "engine_temp_c", "vibration_mm_s"]
    newest = latest_per_key(readings.select("equipment_id", "recorded_at", "event_id", *columns))
    machines = equipment.where(F.col("active")).select("equipment_id", "site_id", "equipment_type")
    counted = [
        F.count("*").alias("total_machines"),
        F.count_if(F.col("status") == "operating").alias("operating"),
        F.count_if(F.col("status") == "fault").alias("in_fault"),
        F.count_if(F.col("status") == "maintenance").alias("in_maintenance"),
    ]
    if with_idle:
        counted.append(F.count_if(F.col("status") == "idle").alias("idle"))
    grouped = (
        machines.join(newest.select("equipment_id", *columns), "equipment_id", "left")
        .groupBy("site_id", "equipment_type")
        .agg(
            *counted,
            F.round(F.avg("fuel_level_pct"), 1).alias("avg_fuel_pct"),
            F.round(F.avg("engine_temp_c"), 1).alias("avg_engine_temp"),
            F.round(F.avg("vibration_mm_s"), 2).alias("avg_vibration"),
        )
    )
    named = grouped.join(sites.select("site_id", "site_name"), "site_id")
    leading = ["site_id", "site_name", "equipment_type"]
    return named.select(*leading, *[c for c in named.columns if c not in leading])


def fault_count(readings: DataFrame, equipment: DataFrame) -> DataFrame:
    """Known machines whose newest reading is a fault, one row."""
    newest = latest_per_key(readings.select("equipment_id", "recorded_at", "event_id", "status"))
    in_fault = newest.where(F.col("status") == "fault")
    known = in_fault.join(equipment.select("equipment_id"), "equipment_id", "left_semi")
    return known.agg(F.count("*").alias("equipment_in_fault"))


def reading_counts(readings: DataFrame, as_of: str) -> DataFrame:
    """All, last-hour and last-five-minute rows and the newest time in one pass."""
    at = F.col("recorded_at")
    return readings.agg(
        F.count("*").alias("total_readings"),
        F.count_if(trailing(at, as_of, hours=1)).alias("readings_last_hour"),
        F.count_if(trailing(at, as_of, minutes=5)).alias("readings_last_5min"),
        F.max("recorded_at").alias("last_reading_at"),
    )


def alert_totals(alerts: DataFrame, as_of: str) -> DataFrame:
    """Open, open critical and last-hour alerts in one pass."""
    is_open = F.col("resolved_at").isNull()
    return alerts.agg(
        F.count_if(is_open).alias("open_alerts"),
        F.count_if(is_open & (F.col("severity") == "CRITICAL")).alias("critical_alerts"),
        F.count_if(trailing(F.col("triggered_at"), as_of, hours=1)).alias("alerts_last_hour"),
    )


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row. The frames are stacked and each column
    keeps its only value, so no join is involved."""
    stacked, *rest = single_rows
    for frame in rest:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def ingest_stats(
    readings: DataFrame, equipment: DataFrame, alerts: DataFrame, as_of: str
) -> DataFrame:
    """Header figures, one row."""
    return side_by_side(
        reading_counts(readings, as_of),
        alert_totals(alerts, as_of),
        fault_count(readings, equipment),
    ).select(
        "total_readings",
        "readings_last_hour",
        "readings_last_5min",
        "open_alerts",
        "critical_alerts",
        "equipment_in_fault",
        "last_reading_at",
    )


def ingest_recency(readings: DataFrame, as_of: str, minimum: int = MIN_RECENT_ROWS) -> DataFrame:
    """Rows of the last five minutes and whether they suffice."""
    recent = readings.where(trailing(F.col("recorded_at"), as_of, minutes=5))
    return recent.agg(F.count("*").alias("recent_rows")).withColumn(
        "healthy", F.col("recent_rows") >= minimum
    )


def ingest_health(
    readings: DataFrame, alerts: DataFrame, as_of: str, minimum: int = MIN_RECENT_ROWS
) -> DataFrame:
    """Totals and the recency verdict, one row."""
    recent = F.col("readings_last_5min")
    return side_by_side(reading_counts(readings, as_of), alert_totals(alerts, as_of)).select(
        "total_readings",
        "open_alerts",
        "alerts_last_hour",
        recent.alias("recent_rows"),
        (recent >= minimum).alias("healthy"),
    )


def dashboard_stats(
    readings: DataFrame, equipment: DataFrame, alerts: DataFrame, as_of: str
) -> DataFrame:
    """The three figure panels, one row, with the colour of the alert panel."""
    critical = F.col("critical_alerts")
    return ingest_stats(readings, equipment, alerts, as_of).select(
        "readings_last_hour",
        critical,
        band(critical, ALERT_COUNT_BANDS).alias("critical_alerts_colour"),
        "equipment_in_fault",
    )


def temperature_series(readings: DataFrame, start: str, end: str) -> DataFrame:
    """Temperature of every machine in a closed time range, oldest first, with colour."""
    return (
        readings.where(between_times(F.col("recorded_at"), start, end))
        .select(
            F.col("recorded_at").alias("time"),
            "equipment_id",
            F.col("engine_temp_c").alias("value"),
        )
        .withColumn("colour", band(F.col("value"), TEMPERATURE_BANDS))
        .orderBy("time")
    )
