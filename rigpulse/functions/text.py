"""Identifiers, messages and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_id(*keys: Column | str) -> Column:
    """Identifier that is the same for the same key on every run; nulls count as empty text."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("#", *parts), 256)


def plain(number: Column) -> Column:
    """Number without an exponent or trailing zeros; whole numbers without a point."""
    exact = number.cast("double").cast("decimal(38,6)").cast("string")
    return F.regexp_replace(exact, r"\.?0+$", "")


def limit_message() -> Column:
    """Message of a limit alert; a whole limit prints without decimals, another one in full."""
    return F.concat(
        F.col("severity"),
        F.lit(": "),
        F.col("equipment_id"),
        F.lit(" "),
        F.col("metric"),
        F.lit("="),
        F.col("value").cast("string"),
        F.lit(" (threshold="),
        plain(F.col("threshold")),
        F.lit(")"),
    )


def flag_message() -> Column:
    return F.concat(F.col("equipment_id"), F.lit(": "), F.col("alert_type"))


def whole(value: Column) -> Column:
    """Number without decimals, halves to even."""
    return F.bround(value.cast("double"), 0).cast("long").cast("string")


def service_message() -> Column:
    return F.concat(
        F.col("severity"),
        F.lit(": "),
        F.col("equipment_id"),
        F.lit(" ("),
        F.coalesce(F.col("model"), F.lit("None")),
        F.lit(") at "),
        F.col("site_name"),
        F.lit(" — "),
        whole(F.col("hours_since_service")),
        F.lit("h since last service (interval: "),
        whole(F.col("service_interval_hrs")),
        F.lit("h)"),
    )


def report_line() -> Column:
    return F.concat(
        F.lit("["),
        F.col("service_status"),
        F.lit("] "),
        F.col("equipment_id"),
        F.lit(" — "),
        whole(F.col("hours_since_service")),
        F.lit("h / "),
        whole(F.col("service_interval_hrs")),
        F.lit("h — "),
        F.col("site_name"),
    )


def month_name(prefix: str, month: Column) -> Column:
    """prefix_YYYY_MM"""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(month, "yyyy_MM"))


def month_from_name(name: Column) -> Column:
    """First day of the month a name ends in; null when it does not end in a valid month."""
    year = F.regexp_extract(name, r"_(\d{4})_(\d{1,2})$", 1)
    month = F.regexp_extract(name, r"_(\d{4})_(\d{1,2})$", 2)
    first = F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-01"))
    return F.try_to_date(first, "yyyy-MM-dd")
