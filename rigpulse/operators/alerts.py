"""Deriving, uniting, listing, counting and resolving alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigpulse.functions import rules as R
from rigpulse.functions.text import flag_message, hash_id, limit_message
from rigpulse.functions.time import hours_between, trailing, ts

ALERT_COLUMNS = (
    "alert_id",
    "equipment_id",
    "site_id",
    "triggered_at",
    "alert_type",
    "severity",
    "metric",
    "value",
    "threshold",
    "message",
)
OPEN_COLUMNS = (
    "alert_id",
    "equipment_id",
    "site_id",
    "site_name",
    "triggered_at",
    "alert_type",
    "severity",
    "metric",
    "value",
    "threshold",
    "message",
    "hours_open",
)


def _event_time(df: DataFrame) -> str:
    return "timestamp" if "timestamp" in df.columns else "recorded_at"


def _carried(df: DataFrame) -> list[str]:
    """Key columns an alert takes over; site_id is absent from stored readings."""
    return [c for c in ("event_id", "equipment_id", "site_id") if c in df.columns]


def flag_alerts(events: DataFrame, rules: Sequence[R.FlagRule] = R.FLAG_RULES) -> DataFrame:
    """One alert per raised flag, with the metric, value and limit of its rule."""
    rows = events.where(R.breaches_any(rules)).select(
        *_carried(events),
        F.col(_event_time(events)).alias("triggered_at"),
        F.inline(R.flag_details(rules)),
    )
    return (
        rows.withColumn("severity", R.flag_severity(F.col("alert_type")))
        .withColumn("message", flag_message())
        .withColumn("alert_id", hash_id(F.lit("flag"), "event_id", "alert_type"))
    )


def limit_alerts(events: DataFrame, rules: Sequence[R.LimitRule] = R.LIMIT_RULES) -> DataFrame:
    """At most one alert per metric and reading, at its worse level."""
    rows = events.where(R.breaches_any(rules)).select(
        *_carried(events),
        F.col(_event_time(events)).alias("triggered_at"),
        F.inline(R.limit_breaches(rules)),
    )
    return rows.withColumn("message", limit_message()).withColumn(
        "alert_id", hash_id(F.lit("limit"), "event_id", "alert_type")
    )


def from_alert_events(events: DataFrame) -> DataFrame:
    """Alert messages of a device in the stored shape."""
    return events.withColumnRenamed("timestamp", "triggered_at").select(*ALERT_COLUMNS)


def unite(*sources: DataFrame) -> DataFrame:
    """Alerts of several producers as one frame."""
    first, *rest = [s.select(*ALERT_COLUMNS) for s in sources]
    for source in rest:
        first = first.unionByName(source)
    return first


def priority() -> list[Column]:
    """Gravest first, unknown severities last, then newest; the id settles ties."""
    return [
        R.severity_priority(F.col("severity")).asc_nulls_last(),
        F.col("triggered_at").desc(),
        F.col("alert_id").asc(),
    ]


def open_alerts(alerts: DataFrame, sites: DataFrame, as_of: str) -> DataFrame:
    """Unresolved alerts with site name and age, unordered: sort with ``priority`` at the end."""
    still_open = alerts.where(F.col("resolved_at").isNull())
    return (
        still_open.join(sites.select("site_id", "site_name"), "site_id")
        .withColumn("hours_open", hours_between(F.col("triggered_at"), ts(as_of)))
        .select(*OPEN_COLUMNS)
    )


def alert_stats(alerts: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Alerts of the trailing hours by site and severity."""
    return (
        alerts.where(trailing(F.col("triggered_at"), as_of, hours=hours))
        .groupBy("site_id", "severity")
        .agg(F.count("*").alias("count"))
    )


def resolve(alerts: DataFrame, ids: DataFrame, as_of: str) -> DataFrame:
    """Snapshot with the named alerts closed at ``as_of``; closed ones keep their first time.
    ``rigpulse.sinks.alerts.resolve_stored`` does it in the stored table."""
    named = ids.select("alert_id").distinct().withColumn("_named", F.lit(True))
    closes = F.col("_named").isNotNull() & F.col("resolved_at").isNull()
    return (
        alerts.join(named, "alert_id", "left")
        .withColumn("resolved_at", F.when(closes, ts(as_of)).otherwise(F.col("resolved_at")))
        .drop("_named")
    )
