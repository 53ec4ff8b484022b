"""Threshold rules as data, and the columns built from them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from rigpulse.schemas import SEVERITIES


class FlagRule(NamedTuple):
    flag: str
    metric: str
    op: str
    limit: float


class LimitRule(NamedTuple):
    alert_type: str
    metric: str
    op: str
    warning: int
    critical: int


class Band(NamedTuple):
    start: float
    colour: str


# Flags raised on the stream, in array order. Rules are independent, so one
# metric may raise both its HIGH and its WARN flag.
FLAG_RULES = (
    FlagRule("HIGH_ENGINE_TEMP", "engine_temp_c", ">", 105.0),
    FlagRule("WARN_ENGINE_TEMP", "engine_temp_c", ">", 100.0),
    FlagRule("HIGH_VIBRATION", "vibration_mm_s", ">", 15.0),
    FlagRule("WARN_VIBRATION", "vibration_mm_s", ">", 10.0),
    FlagRule("CRITICAL_LOW_OIL", "oil_pressure_kpa", "<", 150.0),
    FlagRule("WARN_LOW_OIL", "oil_pressure_kpa", "<", 200.0),
    FlagRule("CRITICAL_LOW_FUEL", "fuel_level_pct", "<", 5.0),
    FlagRule("WARN_LOW_FUEL", "fuel_level_pct", "<", 15.0),
    FlagRule("SERVICE_DUE", "hours_since_service", ">", 250.0),
)
CRITICAL_PREFIXES = ("CRITICAL", "HIGH")

# Two-level limits, one alert at most per metric and reading.
LIMIT_RULES = (
    LimitRule("HIGH_ENGINE_TEMP", "engine_temp_c", ">", 100, 110),
    LimitRule("HIGH_VIBRATION", "vibration_mm_s", ">", 10, 15),
    LimitRule("LOW_FUEL", "fuel_level_pct", "<", 15, 5),
    LimitRule("LOW_OIL_PRESSURE", "oil_pressure_kpa", "<", 200, 150),
)

# Dashboard colour steps.
ALERT_COUNT_BANDS = (Band(0, "green"), Band(1, "orange"), Band(5, "red"))
TEMPERATURE_BANDS = (Band(0, "green"), Band(100, "orange"), Band(105, "red"))

# Fixed value: share of the service interval from which a machine counts as due soon.
DUE_SOON_SHARE = 0.92


def breached(metric: str, op: str, limit: float) -> Column:
    """Strict comparison; null when the metric is null."""
    value, bound = F.col(metric), F.lit(limit)
    return value > bound if op == ">" else value < bound


def anomaly_flags(rules: Sequence[FlagRule] = FLAG_RULES) -> Column:
    """One slot per rule in rule order, null where the rule does not fire."""
    return F.array(*[F.when(breached(r.metric, r.op, r.limit), F.lit(r.flag)) for r in rules])


def any_flag(flags: Column) -> Column:
    return F.exists(flags, lambda flag: flag.isNotNull())


def _is_critical_flag(flag: Column) -> Column:
    hit = F.lit(False)
    for prefix in CRITICAL_PREFIXES:
        hit = hit | flag.startswith(prefix)
    return hit


def any_critical(flags: Column) -> Column:
    """True or false, never null: slots of silent rules are removed first."""
    return F.exists(F.array_compact(flags), _is_critical_flag)


def flag_severity(flag: Column) -> Column:
    return F.when(_is_critical_flag(flag), F.lit("CRITICAL")).otherwise(F.lit("WARNING"))


def flag_details(rules: Sequence[FlagRule] = FLAG_RULES) -> Column:
    """Array of (alert_type, metric, value, threshold) for the rules that fire, in rule order."""
    slots = [
        F.when(
            breached(r.metric, r.op, r.limit),
            F.struct(
                F.lit(r.flag).alias("alert_type"),
                F.lit(r.metric).alias("metric"),
                F.col(r.metric).cast("double").alias("value"),
                F.lit(float(r.limit)).alias("threshold"),
            ),
        )
        for r in rules
    ]
    return F.array_compact(F.array(*slots))


def limit_breaches(rules: Sequence[LimitRule] = LIMIT_RULES) -> Column:
    """Array of (alert_type, severity, metric, value, threshold): the worse level per metric."""

    def level(rule: LimitRule, severity: str, limit: int) -> Column:
        return F.struct(
            F.lit(rule.alert_type).alias("alert_type"),
            F.lit(severity).alias("severity"),
            F.lit(rule.metric).alias("metric"),
            F.col(rule.metric).cast("double").alias("value"),
            F.lit(float(limit)).alias("threshold"),
        )

    slots = [
        F.when(breached(r.metric, r.op, r.critical), level(r, "CRITICAL", r.critical)).when(
            breached(r.metric, r.op, r.warning), level(r, "WARNING", r.warning)
        )
        for r in rules
    ]
    return F.array_compact(F.array(*slots))


def breaches_any(rules: Sequence[FlagRule] | Sequence[LimitRule]) -> Column:
    """Plain predicate "some rule fires", simple enough to be pushed to a Parquet scan: the
    loosest limit of each metric and direction."""
    loosest: dict[tuple[str, str], float] = {}
    for rule in rules:
        limit = rule.limit if isinstance(rule, FlagRule) else rule.warning
        wider = min if rule.op == ">" else max
        key = (rule.metric, rule.op)
        loosest[key] = wider(limit, loosest.get(key, limit))
    hit = F.lit(False)
    for (metric, op), limit in loosest.items():
        hit = hit | breached(metric, op, float(limit))
    return hit


def service_status(hours: Column, interval: Column) -> Column:
    """OVERDUE from the full interval, DUE_SOON from its share; unknown hours count as OK."""
    return (
        F.when(hours >= interval, F.lit("OVERDUE"))
        .when(hours >= interval * F.lit(DUE_SOON_SHARE), F.lit("DUE_SOON"))
        .otherwise(F.lit("OK"))
    )


def service_severity(status: Column) -> Column:
    return F.when(status == "OVERDUE", F.lit("CRITICAL")).otherwise(F.lit("WARNING"))


def severity_priority(severity: Column) -> Column:
    """1 for the gravest known severity, null for an unknown one."""
    ranked = F.lit(None).cast("int")
    for rank, name in enumerate(reversed(SEVERITIES), start=1):
        ranked = F.when(severity == name, F.lit(rank)).otherwise(ranked)
    return ranked


def severity_order(severity: Column) -> Column:
    """Position in the declared domain: WARNING before CRITICAL."""
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity)


def band(value: Column, steps: Sequence[Band]) -> Column:
    """Colour of the highest step not above the value; the lowest step also takes what is below."""
    first, *rest = steps
    colour = F.lit(first.colour)
    for step in rest:
        colour = F.when(value >= F.lit(step.start), F.lit(step.colour)).otherwise(colour)
    return F.when(value.isNotNull(), colour)
