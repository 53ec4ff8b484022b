"""Daily key figures per machine."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigpulse.functions.time import previous_day, trailing_days, within

# Fixed value: one reading every ten seconds.
READINGS_PER_HOUR = 360

# The columns of the stored KPI table.
KPI_COLUMNS = (
    "equipment_id",
    "site_id",
    "kpi_date",
    "avg_engine_temp_c",
    "max_engine_temp_c",
    "avg_vibration_mm_s",
    "max_vibration_mm_s",
    "total_fuel_litres",
    "operating_hours",
    "idle_hours",
    "fault_hours",
    "uptime_pct",
    "alert_count",
    "critical_alert_count",
    "total_payload_tonnes",
    "avg_drill_rpm",
)


def _hours_in(status: str, readings_per_hour: int) -> Column:
    return F.count_if(F.col("status") == status) / F.lit(readings_per_hour)


def measures(readings: DataFrame, readings_per_hour: int = READINGS_PER_HOUR) -> DataFrame:
    """Key figures by machine and day. All buffers are fixed-width, so rows are combined by hash
    before the shuffle and a hot machine adds one row per task and day."""
    return (
        readings.groupBy("equipment_id", F.to_date("recorded_at").alias("kpi_date"))
        .agg(
            F.avg("engine_temp_c").alias("avg_engine_temp_c"),
            F.max("engine_temp_c").alias("max_engine_temp_c"),
            F.avg("vibration_mm_s").alias("avg_vibration_mm_s"),
            F.max("vibration_mm_s").alias("max_vibration_mm_s"),
            F.sum("fuel_burn_rate").alias("total_fuel_litres"),
            _hours_in("operating", readings_per_hour).alias("operating_hours"),
            _hours_in("idle", readings_per_hour).alias("idle_hours"),
            _hours_in("fault", readings_per_hour).alias("fault_hours"),
            F.sum("payload_tonnes").alias("total_payload_tonnes"),
            F.avg("drill_rpm").alias("avg_drill_rpm"),
        )
        .withColumn("uptime_pct", F.round(F.col("operating_hours") / 24 * 100, 2))
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("equipment_id", F.to_date("triggered_at").alias("kpi_date")).agg(
        F.count("*").alias("alert_count"),
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_alert_count"),
    )


def daily_kpi_range(
    readings: DataFrame,
    equipment: DataFrame,
    alerts: DataFrame,
    first_day: date | str,
    last_day: date | str,
    readings_per_hour: int = READINGS_PER_HOUR,
) -> DataFrame:
    """KPI rows of the days first_day..last_day. Both fact tables are grouped before they meet,
    so the joins see one row per machine and day."""
    start = date.fromisoformat(str(first_day))
    end = date.fromisoformat(str(last_day)) + timedelta(days=1)
    day_measures = measures(
        readings.where(within(F.col("recorded_at"), start, end)), readings_per_hour
    )
    counts = alert_counts(alerts.where(within(F.col("triggered_at"), start, end)))
    return (
        day_measures.join(counts, ["equipment_id", "kpi_date"], "left")
        .join(equipment.select("equipment_id", "site_id"), "equipment_id", "left")
        .fillna(0, subset=["alert_count", "critical_alert_count"])
        .select(*KPI_COLUMNS)
    )


def daily_kpi(
    readings: DataFrame,
    equipment: DataFrame,
    alerts: DataFrame,
    target_date: date | str,
    readings_per_hour: int = READINGS_PER_HOUR,
) -> DataFrame:
    """KPI rows of one day."""
    return daily_kpi_range(
        readings, equipment, alerts, target_date, target_date, readings_per_hour
    )


def default_target_date(as_of: str) -> date:
    """The job of a day reports the day before."""
    return previous_day(as_of)


def fuel_integrated(
    readings: DataFrame, readings_per_hour: int = READINGS_PER_HOUR
) -> DataFrame:
    """Litres burnt by machine and day when fuel_burn_rate is taken as litres per hour."""
    return readings.groupBy("equipment_id", F.to_date("recorded_at").alias("kpi_date")).agg(
        (F.sum("fuel_burn_rate") / readings_per_hour).alias("fuel_litres_integrated")
    )


def kpi_history(kpis: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Rows of the trailing days."""
    return kpis.where(trailing_days(F.col("kpi_date"), as_of, days))


def kpi_summary(kpis: DataFrame) -> DataFrame:
    """Row count and averages over KPI rows; averages of no rows are zero."""
    return kpis.agg(
        F.count("*").alias("kpi_rows"),
        F.coalesce(F.avg("uptime_pct"), F.lit(0.0)).alias("avg_uptime"),
        F.coalesce(F.avg("alert_count"), F.lit(0.0)).alias("avg_alerts"),
    )
