"""Service status and what follows from it: alerts, log entries, report lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.functions.rules import service_severity, service_status
from rigpulse.functions.text import hash_id, report_line, service_message
from rigpulse.functions.time import ts
from rigpulse.operators.alerts import ALERT_COLUMNS
from rigpulse.operators.latest import service_hours

STATUS_COLUMNS = (
    "equipment_id",
    "site_id",
    "equipment_type",
    "model",
    "service_interval_hrs",
    "hours_since_service",
    "site_name",
    "service_status",
)

# Texts of generated rows.
SERVICE_ALERT_TYPE = "SERVICE_DUE"
SERVICE_METRIC = "hours_since_service"
LOG_SERVICE_TYPE = "preventive"
LOG_NOTE = "Auto-generated by Airflow maintenance_scheduler DAG"


def service_list(readings: DataFrame, equipment: DataFrame, sites: DataFrame) -> DataFrame:
    """Active machines with their service status, most hours first, unknown hours last."""
    hours = F.col("hours_since_service")
    return (
        equipment.where(F.col("active"))
        .join(service_hours(readings), "equipment_id", "left")
        .join(sites.select("site_id", "site_name"), "site_id")
        .withColumn("service_status", service_status(hours, F.col("service_interval_hrs")))
        .select(*STATUS_COLUMNS)
        .orderBy(hours.desc_nulls_last(), "equipment_id")
    )


def due(services: DataFrame) -> DataFrame:
    """Machines due soon or overdue; unknown hours read as zero."""
    flagged = services.where(F.col("service_status").isin("DUE_SOON", "OVERDUE"))
    return flagged.fillna(0, subset=["hours_since_service"])


def service_counts(services: DataFrame) -> DataFrame:
    """Machines, due ones (overdue included) and overdue ones, one row."""
    status = F.col("service_status")
    return services.agg(
        F.count("*").alias("total_equipment"),
        F.count_if(status.isin("DUE_SOON", "OVERDUE")).alias("due_count"),
        F.count_if(status == "OVERDUE").alias("overdue_count"),
    )


def service_alerts(services: DataFrame, as_of: str) -> DataFrame:
    """One alert per due machine and day: its id is made from machine, type and day."""
    day = F.to_date(ts(as_of))
    return (
        due(services)
        .withColumn("severity", service_severity(F.col("service_status")))
        .withColumn("triggered_at", ts(as_of))
        .withColumn("alert_type", F.lit(SERVICE_ALERT_TYPE))
        .withColumn("metric", F.lit(SERVICE_METRIC))
        .withColumn("value", F.col("hours_since_service"))
        .withColumn("threshold", F.col("service_interval_hrs"))
        .withColumn("message", service_message())
        .withColumn("alert_id", hash_id(F.lit("service"), "equipment_id", "alert_type", day))
        .select(*ALERT_COLUMNS)
    )


def service_logs(services: DataFrame, logs: DataFrame, as_of: str) -> DataFrame:
    """A log entry for each overdue machine that has none on that day yet."""
    day = F.to_date(ts(as_of))
    entries = (
        due(services)
        .where(F.col("service_status") == "OVERDUE")
        .select(
            hash_id(F.lit("log"), "equipment_id", day).alias("log_id"),
            "equipment_id",
            day.alias("service_date"),
            F.lit(LOG_SERVICE_TYPE).alias("service_type"),
            F.col("hours_since_service").alias("hours_at_service"),
            (F.col("hours_since_service") + F.col("service_interval_hrs")).alias(
                "next_service_due"
            ),
            F.lit(LOG_NOTE).alias("notes"),
        )
    )
    that_day = logs.where(F.col("service_date") == day).select("equipment_id")
    return entries.join(that_day, "equipment_id", "left_anti")


def service_report(services: DataFrame) -> DataFrame:
    """Report lines of due machines, most hours first; write as text or page through it."""
    return (
        due(services)
        .withColumn("line", report_line())
        .select("equipment_id", "service_status", "hours_since_service", "line")
        .orderBy(F.col("hours_since_service").desc(), "equipment_id")
    )


def parts_by_log(logs: DataFrame, parts: DataFrame, key: str = "log_id") -> DataFrame:
    """Logs with the sorted distinct names of the parts replaced, null for a log without parts;
    parts hold the key and ``part``.

    Repeated parts of a log are dropped inside each task before the one shuffle."""
    lists = parts.groupBy(key).agg(F.sort_array(F.collect_set("part")).alias("parts_replaced"))
    return logs.join(lists, key, "left")
