"""The read queries users call: filters, order and limit on top of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.functions.rules import severity_order
from rigpulse.functions.time import bounded
from rigpulse.operators import alerts as A
from rigpulse.operators import health as H
from rigpulse.operators import kpi as K
from rigpulse.operators import latest as L

# Rows the alert list and the alert panel show.
OPEN_ALERT_LIMIT = 100
PANEL_ALERT_LIMIT = 50

# Columns of the KPI response.
KPI_RESPONSE = (
    "equipment_id",
    "site_id",
    "kpi_date",
    "avg_engine_temp_c",
    "max_engine_temp_c",
    "avg_vibration_mm_s",
    "total_fuel_litres",
    "operating_hours",
    "uptime_pct",
    "alert_count",
    "critical_alert_count",
)


def where_equal(df: DataFrame, **filters: str | None) -> DataFrame:
    """Keep rows equal to every filter that is given."""
    for name, value in filters.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def equipment_latest(
    readings: DataFrame,
    equipment: DataFrame,
    *,
    site_id: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Newest reading per machine by site and machine. The status filter applies to the newest
    reading; the site filter already narrows the machines."""
    newest = L.equipment_latest(readings, where_equal(equipment, site_id=site_id))
    return where_equal(newest, status=status).orderBy("site_id", "equipment_id")


def equipment_history(
    readings: DataFrame, equipment_id: str, as_of: str, hours: int = 24
) -> DataFrame:
    return L.history(readings, equipment_id, as_of, hours)


def fleet_health(readings: DataFrame, equipment: DataFrame, sites: DataFrame) -> DataFrame:
    return H.fleet_health(readings, equipment, sites)


def open_alerts(
    alerts: DataFrame,
    sites: DataFrame,
    as_of: str,
    *,
    severity: str | None = None,
    site_id: str | None = None,
    limit: int = OPEN_ALERT_LIMIT,
) -> DataFrame:
    """The gravest and newest open alerts."""
    wanted = where_equal(alerts, severity=severity, site_id=site_id)
    return A.open_alerts(wanted, sites, as_of).orderBy(*A.priority()).limit(limit)


def alert_stats(alerts: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    return A.alert_stats(alerts, as_of, hours).orderBy("site_id", severity_order(F.col("severity")))


def daily_kpis(
    kpis: DataFrame,
    as_of: str,
    days: int = 7,
    *,
    equipment_id: str | None = None,
    site_id: str | None = None,
) -> DataFrame:
    """KPI rows of the trailing days, newest first."""
    bounded("days", days, 1, 90)
    wanted = where_equal(
        K.kpi_history(kpis, as_of, days), equipment_id=equipment_id, site_id=site_id
    )
    return wanted.orderBy(F.col("kpi_date").desc(), "equipment_id")


def daily_kpi_response(kpis: DataFrame, as_of: str, days: int = 7, **filters) -> DataFrame:
    """The same rows with the columns the KPI cards show."""
    return daily_kpis(kpis, as_of, days, **filters).select(*KPI_RESPONSE)


def ingest_stats(
    readings: DataFrame, equipment: DataFrame, alerts: DataFrame, as_of: str
) -> DataFrame:
    return H.ingest_stats(readings, equipment, alerts, as_of)


def alert_panel(
    alerts: DataFrame, sites: DataFrame, as_of: str, limit: int = PANEL_ALERT_LIMIT
) -> DataFrame:
    """The first open alerts in priority order, shown newest first."""
    top = open_alerts(alerts, sites, as_of, limit=limit).select(
        "equipment_id",
        "site_name",
        "alert_type",
        "severity",
        "metric",
        "value",
        "message",
        "triggered_at",
    )
    return top.orderBy(F.col("triggered_at").desc())


def fleet_panel(readings: DataFrame, equipment: DataFrame, sites: DataFrame) -> DataFrame:
    return (
        H.fleet_health(readings, equipment, sites)
        .select(
            "site_name",
            "equipment_type",
            "total_machines",
            "operating",
            "in_fault",
            "in_maintenance",
            "avg_fuel_pct",
            "avg_engine_temp",
        )
        .orderBy("site_name")
    )


def register_views(
    readings: DataFrame,
    equipment: DataFrame,
    sites: DataFrame,
    alerts: DataFrame,
    as_of: str,
) -> None:
    """The three standing views, for users who query in SQL."""
    L.equipment_latest(readings, equipment).createOrReplaceTempView("vw_equipment_latest")
    A.open_alerts(alerts, sites, as_of).createOrReplaceTempView("vw_open_alerts")
    H.fleet_health(readings, equipment, sites).createOrReplaceTempView("vw_site_fleet_health")
