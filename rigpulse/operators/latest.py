"""Latest reading per machine, history of one machine, thinned status feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigpulse.functions.time import bounded, trailing
from rigpulse.schemas import HISTORY_COLUMNS, LATEST_COLUMNS

# Readings of one machine that are numbered together; a minute is at most some thousand of them.
STRETCH = "minute"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark limits each task to its first row per key before the shuffle, so a hot key sends
    one row per task however many rows it has.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    readings: DataFrame,
    key: str = "equipment_id",
    order: str = "recorded_at",
    tie: str = "event_id",
) -> DataFrame:
    """The newest row of every key, equal times settled by the larger ``tie``.

    An aggregate rather than a window: each task keeps one row per key before the shuffle, and
    sorts its input by the key alone.
    """
    rest = [c for c in readings.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(order, tie)).alias("_row")
    return readings.groupBy(key).agg(newest).select(key, "_row.*")


def equipment_latest(readings: DataFrame, equipment: DataFrame) -> DataFrame:
    """Newest reading of each known machine with its master data, active or not.

    The pick comes first: master data is unique per machine, so the join does not change the
    pick and only meets one row per machine.
    """
    machines = equipment.select("equipment_id", "equipment_type", "model", "site_id")
    measured = [c for c in LATEST_COLUMNS if c == "equipment_id" or c not in machines.columns]
    newest = latest_per_key(readings.select(*measured, "event_id"))
    return newest.join(machines, "equipment_id").select(*LATEST_COLUMNS)


def service_hours(readings: DataFrame) -> DataFrame:
    """Hours since service at each machine's newest reading."""
    narrow = readings.select("equipment_id", "recorded_at", "event_id", "hours_since_service")
    return latest_per_key(narrow).select("equipment_id", "hours_since_service")


def history(readings: DataFrame, equipment_id: str, as_of: str, hours: int = 24) -> DataFrame:
    """Readings of one machine over the trailing hours, oldest first."""
    bounded("hours", hours, 1, 168)
    return (
        readings.where(F.col("equipment_id") == equipment_id)
        .where(trailing(F.col("recorded_at"), as_of, hours=hours))
        .select(*HISTORY_COLUMNS)
        .orderBy("recorded_at")
    )


def numbered(
    readings: DataFrame,
    key: str = "equipment_id",
    order: str = "recorded_at",
    tie: str = "event_id",
) -> DataFrame:
    """Add ``ordinal``: 1, 2, 3 ... per key in (order, tie) order, also for a key with most rows.

    A window over the key would sort all rows of a key in one task. Here a key's rows are cut into
    stretches of ``STRETCH``: the rows of each are counted, combined in each task first; a running
    sum over a key's counts says how many rows lie before each stretch; and rows are numbered
    inside their stretch. Rows are shuffled once, by key and stretch, for the join with the running
    sums and for the numbering alike, so a hot key spans as many tasks as it has stretches. Rows
    without a time come first, rows without a key are left out.
    """
    first = F.lit("0001-01-01").cast("timestamp")
    stretch = F.coalesce(F.date_trunc(STRETCH, F.col(order)), first)
    rows = readings.where(F.col(key).isNotNull()).withColumn("_stretch", stretch)
    counts = rows.groupBy(key, "_stretch").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        key, "_stretch", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(key, "_stretch").orderBy(order, tie))
    return (
        rows.join(starts, [key, "_stretch"])
        .withColumn("ordinal", inside + F.col("_before"))
        .drop("_stretch", "_before")
    )


def status_feed(readings: DataFrame, equipment: DataFrame, every: int = 10) -> DataFrame:
    """Each machine's every n-th reading as a status heartbeat."""
    narrow = readings.select("equipment_id", "recorded_at", "event_id", "status")
    beats = numbered(narrow).where(F.col("ordinal") % every == 0)
    return beats.join(equipment.select("equipment_id", "site_id"), "equipment_id").select(
        "equipment_id", "site_id", "status", F.col("recorded_at").alias("timestamp")
    )
