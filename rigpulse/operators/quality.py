"""Gates and constraint checks, each a report frame; the caller decides whether to stop."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigpulse.functions.time import on_day
from rigpulse.operators.kpi import kpi_summary

# Fixed value: fewest readings of a day worth aggregating.
MIN_SOURCE_ROWS = 100


class GateFailed(Exception):
    """A gate's one-row report says no."""


def source_gate(
    readings: DataFrame, target_date: date | str, minimum: int = MIN_SOURCE_ROWS
) -> DataFrame:
    """Rows and machines of the day and whether the rows suffice."""
    return (
        readings.where(on_day(F.col("recorded_at"), target_date))
        .agg(
            F.count("*").alias("row_count"),
            F.countDistinct("equipment_id").alias("equipment_count"),
        )
        .withColumn("passed", F.col("row_count") >= minimum)
    )


def output_gate(kpis: DataFrame, target_date: date | str) -> DataFrame:
    """Row count and averages of the day's KPI rows; no rows fail."""
    day = kpis.where(F.col("kpi_date") == F.lit(str(target_date)).cast("date"))
    return kpi_summary(day).withColumn("passed", F.col("kpi_rows") > 0)


def require(report: DataFrame, verdict: str = "passed") -> dict:
    """Read a one-row report and raise unless its verdict holds."""
    row = report.first().asDict()
    if not row[verdict]:
        raise GateFailed(str(row))
    return row


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("occurrences")).where("occurrences > 1")


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values without a parent row, with their row count; null keys are no references.

    Rows are counted per key before the join, so a hot key meets the parent once.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(parent.select(key), key, "left_anti")


def column_rules(
    not_null: Sequence[str] = (),
    max_lengths: Mapping[str, int] | None = None,
    domains: Mapping[str, Sequence[str]] | None = None,
    columns: Sequence[str] | None = None,
) -> dict[str, Column]:
    """Rule name -> condition that is true for a violating row.

    With ``columns``, those the table has: a column it lacks counts as null in every row, which
    violates a not-null rule everywhere and other rules nowhere.
    """
    if columns is not None:
        lacking = lambda names: [n for n in names if n not in columns]
        held = lambda names: {n: v for n, v in (names or {}).items() if n in columns}
        rules = {f"not_null:{c}": F.lit(True) for c in lacking(not_null)}
        rules |= {f"max_length:{c}": F.lit(False) for c in lacking(max_lengths or {})}
        rules |= {f"domain:{c}": F.lit(False) for c in lacking(domains or {})}
        kept = [c for c in not_null if c in columns]
        return rules | column_rules(kept, held(max_lengths), held(domains))
    rules = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    for name, limit in (max_lengths or {}).items():
        rules[f"max_length:{name}"] = F.length(name) > limit
    for name, allowed in (domains or {}).items():
        rules[f"domain:{name}"] = ~F.col(name).isin(*allowed)
    return rules


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with its violation count, from a single pass."""
    counts = df.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("rule"), F.count_if(bad).alias("violations"))
                for name, bad in rules.items()
            ]
        ).alias("counts")
    )
    return counts.select(F.inline("counts"))
