"""Month routing and retention."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigpulse.functions.text import month_from_name, month_name
from rigpulse.functions.time import month_start, ts
from rigpulse.schemas import DAY_PARTITION
from rigpulse.sinks.compaction import settle
from rigpulse.sinks.tables import overwrite_partitions
from rigpulse.sources import folders
from rigpulse.sources.tables import read_or_empty

# Days kept, months with a partition of their own, name stem.
RETENTION_DAYS = 90
DECLARED_MONTHS = ("2024_01", "2024_12", "2025_01", "2025_06", "2025_07")
STEM = "sensor_readings"

_MONTH = "_month"


def route_months(
    df: DataFrame,
    column: str = "recorded_at",
    declared: Sequence[str] = DECLARED_MONTHS,
    stem: str = STEM,
) -> DataFrame:
    """Add the month partition a row belongs to; undeclared months go to the default one."""
    own = month_name(stem, F.col(column))
    names = [f"{stem}_{month}" for month in declared]
    return df.withColumn(
        "partition_name", F.when(own.isin(*names), own).otherwise(F.lit(f"{stem}_default"))
    )


def month_counts(df: DataFrame, column: str = "recorded_at") -> DataFrame:
    return df.groupBy(month_start(F.col(column)).alias("month")).agg(F.count("*").alias("rows"))


def _expired(month: Column, as_of: str, days: int, legacy: bool) -> Column:
    """Whole month out of the window; ``legacy`` looks at its first day only."""
    cutoff = ts(datetime.fromisoformat(str(as_of)) - timedelta(days=days))
    if legacy:
        return month.cast("timestamp") < cutoff
    return F.add_months(month, 1).cast("timestamp") <= cutoff


def retention_plan(
    df: DataFrame,
    as_of: str,
    column: str = "recorded_at",
    days: int = RETENTION_DAYS,
    *,
    legacy: bool = False,
    stem: str = STEM,
) -> DataFrame:
    """Months present, their rows, and whether they are out of the window."""
    plan = month_counts(df, column).where(F.col("month").isNotNull())
    return plan.select(
        month_name(stem, F.col("month")).alias("partition_name"),
        "month",
        "rows",
        _expired(F.col("month"), as_of, days, legacy).alias("expired"),
    )


def expired_names(
    names: DataFrame, as_of: str, days: int = RETENTION_DAYS, *, legacy: bool = False
) -> DataFrame:
    """Partition names out of the window; default and unreadable names are left out."""
    listed = names.where(~F.col("partition_name").like("%default%"))
    dated = listed.withColumn("month", month_from_name(F.col("partition_name")))
    return dated.where(_expired(F.col("month"), as_of, days, legacy))


class ArchiveIncomplete(Exception):
    """The archive lacks a row that is about to be dropped."""


def _missing(spark: SparkSession, expired: DataFrame, archive_path: str) -> DataFrame:
    """Expired rows that the archive does not hold; only the months concerned are read."""
    names = expired.columns
    archived = read_or_empty(
        lambda: spark.read.schema(expired.schema).parquet(archive_path), spark, expired.schema
    ).select(*names)
    months = expired.select(_MONTH).distinct()
    return expired.exceptAll(archived.join(months, _MONTH, "left_semi").select(*names))


def _checksum(df: DataFrame) -> list[Column]:
    """Rows, and a sum of row hashes that does not depend on their order."""
    hashed = F.xxhash64(*df.columns).cast("decimal(20,0)")
    return [F.count("*").alias("rows"), F.sum(hashed).alias("checksum")]


def folder_plan(
    spark: SparkSession,
    path: str,
    as_of: str,
    days: int = RETENTION_DAYS,
    *,
    legacy: bool = False,
    stem: str = STEM,
    counts: Mapping[date, int] | None = None,
) -> DataFrame:
    """``retention_plan`` of a table kept by day, from folder names and stored counts alone. Rows
    are null where nothing was counted. A folder belongs to the month of its date."""
    found = sorted(folders.days(spark, path))
    listed = spark.createDataFrame(
        [(d, (counts or {}).get(d)) for d in found], "day date, counted long"
    )
    months = listed.groupBy(month_start(F.col("day")).alias("month")).agg(
        F.sum("counted").alias("rows")
    )
    return months.select(
        month_name(stem, F.col("month")).alias("partition_name"),
        "month",
        "rows",
        _expired(F.col("month"), as_of, days, legacy).alias("expired"),
    )


def _copy_folders(
    spark: SparkSession, path: str, archive_path: str, names: Sequence[str], schema: T.StructType,
    cluster: Sequence[str],
) -> None:
    """Copy folders the archive does not have, in one scan, and compare what arrived."""
    if not names:
        return
    seen = Observation()
    rows = folders.read(spark, path, [f"{path}/{n}" for n in names], schema)
    watched = rows.observe(seen, *_checksum(rows))
    overwrite_partitions(watched, archive_path, [DAY_PARTITION, "batch_id"], cluster)
    copied = folders.read(spark, archive_path, folders.present(spark, archive_path, names), schema)
    there = copied.agg(*_checksum(copied)).first().asDict()
    if there != seen.get:
        raise ArchiveIncomplete(f"copied {seen.get}, found {there}")


def _merge_folders(
    spark: SparkSession, path: str, archive_path: str, names: Sequence[str], schema: T.StructType
) -> None:
    """Add what folders hold beyond those of the same name in the archive: an earlier run ended
    after it had copied them."""
    if not names:
        return
    mine = folders.read(spark, path, [f"{path}/{n}" for n in names], schema)

    def missing() -> DataFrame:
        there = folders.read(spark, archive_path, [f"{archive_path}/{n}" for n in names], schema)
        return mine.exceptAll(there)

    missing().write.mode("append").partitionBy(DAY_PARTITION, "batch_id").parquet(archive_path)
    wrong = missing().limit(1).collect()
    if wrong:
        raise ArchiveIncomplete(str(wrong[0].asDict()))


def expire_folders(
    spark: SparkSession,
    path: str,
    archive_path: str,
    schema: T.StructType,
    as_of: str,
    days: int = RETENTION_DAYS,
    *,
    legacy: bool = False,
    cluster: Sequence[str] = (),
    before_drop: Callable[[list[tuple[date, int]]], None] | None = None,
) -> list[tuple[date, int]]:
    """Move the folders of expired months of a table kept by day into an archive of the same
    layout; the (day, batch) folders moved.

    Folders that stay are neither opened nor written. Expired ones are read once, copied, compared
    by the hashes of all rows, and dropped one by one; a run that ended anywhere in between is
    completed by the next one, which copies nothing twice. Rows of an archived month that come late
    are in a batch folder of their own and join the archive with the next run. ``before_drop`` is
    told the folders before the first is dropped. Rows without a time never expire.
    """
    settle(spark, path)
    plan = folder_plan(spark, path, as_of, days, legacy=legacy).where("expired")
    months = {r.month for r in plan.collect()}
    gone = [
        (day, batch, folder)
        for day, at in folders.days(spark, path).items() if day.replace(day=1) in months
        for batch, folder in folders.batches(spark, at).items()
    ]
    names = [f"{DAY_PARTITION}={day}/batch_id={batch}" for day, batch, _ in gone]
    known = set(folders.present(spark, archive_path, names))
    again = [n for n in names if f"{archive_path}/{n}" in known]
    dated = folders.dated_schema(schema)
    fresh = [n for n in names if n not in set(again)]
    _copy_folders(spark, path, archive_path, fresh, dated, cluster)
    _merge_folders(spark, path, archive_path, again, dated)
    moved = [(day, batch) for day, batch, _ in gone]
    if moved and before_drop is not None:
        before_drop(moved)
    for day, _, folder in gone:
        folders.drop(spark, folder)
        folders.drop_if_empty(spark, f"{path}/{DAY_PARTITION}={day}")
    return moved


def apply_retention(
    spark: SparkSession,
    df: DataFrame,
    as_of: str,
    archive_path: str,
    keep_path: str,
    column: str = "recorded_at",
    days: int = RETENTION_DAYS,
    *,
    legacy: bool = False,
) -> DataFrame:
    """Add expired rows to the archive, compare rows, write the rest; returns the rows kept. For
    tables that are not kept by day; ``expire_folders`` moves folders and leaves the rest alone.

    Months without a partition of their own expire by their rows' time like all others; rows
    without a time are kept. The archive only grows: rows that it holds already (a run repeated
    after a failure) are not added again, late rows of a month archived before join it. The source
    is left as it is: the caller swaps in ``keep_path`` once this returns.
    """
    month = month_start(F.col(column))
    staged = df.withColumn(_MONTH, month)
    gone = F.coalesce(_expired(month, as_of, days, legacy), F.lit(False))
    expired = staged.where(gone)
    _missing(spark, expired, archive_path).hint("rebalance", _MONTH).write.mode(
        "append"
    ).partitionBy(_MONTH).parquet(archive_path)
    # Row by row, not by count: every expired row has to be there before anything is dropped.
    wrong = _missing(spark, expired, archive_path).limit(1).collect()
    if wrong:
        raise ArchiveIncomplete(str(wrong[0].asDict()))

    kept = staged.where(~gone).hint("rebalance", _MONTH)
    kept.write.mode("overwrite").partitionBy(_MONTH).parquet(keep_path)
    return spark.read.schema(staged.schema).parquet(keep_path).drop(_MONTH)
