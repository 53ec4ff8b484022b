"""Anomaly columns on sensor events, batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.functions.rules import FLAG_RULES, FlagRule, any_critical, any_flag, anomaly_flags


def enrich(events: DataFrame, rules: Sequence[FlagRule] = FLAG_RULES) -> DataFrame:
    """Add anomaly_flags, has_anomaly and is_critical."""
    flags = F.col("anomaly_flags")
    return (
        events.withColumn("anomaly_flags", anomaly_flags(rules))
        .withColumn("has_anomaly", any_flag(flags))
        .withColumn("is_critical", any_critical(flags))
    )


def with_site(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Site attributes on events, batch or stream; rows of unknown sites stay with null name."""
    return df.join(sites.select("site_id", "site_name", "state"), "site_id", "left")
