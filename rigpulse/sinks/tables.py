"""Writes that can be run again without changing the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigpulse.functions.time import with_date_parts
from rigpulse.operators.latest import first_per_key
from rigpulse.schemas import ARCHIVE_PARTITIONS, DAY_PARTITION, SENSOR_READINGS

# Rows per JDBC round trip.
READINGS_PAGE = 500
KPI_PAGE = 100


# Digits kept beyond a decimal's scale before it is rounded to that scale.
GUARD_DIGITS = 6


def _stored(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """Cast to a stored type. Doubles drop their last digits first, so that a mean whose sum was
    added up in another order still rounds to the same decimal."""
    if isinstance(have, T.DoubleType) and isinstance(want, T.DecimalType):
        column = F.round(column, want.scale + GUARD_DIGITS)
    return column.cast(want)


def to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a stored table in their stored types; columns the frame lacks become null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (
                _stored(F.col(f.name), have[f.name], f.dataType)
                if f.name in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def stored_readings(events: DataFrame) -> DataFrame:
    """Sensor events as rows of the readings table."""
    return to_schema(events.withColumnRenamed("timestamp", "recorded_at"), SENSOR_READINGS)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], page: int = READINGS_PAGE
) -> None:
    options = {**properties, "batchsize": str(page)}
    df.write.jdbc(url, table, mode="append", properties=options)


def overwrite_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], cluster: Sequence[str] = ()
) -> None:
    """Replace exactly the partitions the frame has rows for.

    The rebalance hint gathers each partition's rows into few files and still lets adaptive
    execution split a partition that is too large for one task. Rows are sorted by ``cluster``
    inside each file, so that a filter on it skips row groups; the sort starts with the partition
    columns, which the writer needs sorted anyway.
    """
    spread = df.hint("rebalance", *partitions)
    if cluster:
        spread = spread.sortWithinPartitions(*partitions, *cluster)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_kpis(kpis: DataFrame, path: str) -> None:
    """Upsert by machine and day: a run replaces its whole day."""
    overwrite_partitions(kpis, path, ["kpi_date"])


def write_archive(events: DataFrame, root: str, batch_id: int) -> None:
    """Add events to the archive by site and day; the same batch written again replaces itself."""
    parts = with_date_parts(F.col("timestamp"))
    dated = events.withColumns({**parts, "batch_id": F.lit(batch_id).cast("bigint")})
    overwrite_partitions(dated, root, ARCHIVE_PARTITIONS, ["equipment_id"])


def write_dated(df: DataFrame, path: str, column: str, batch_id: int) -> None:
    """Add one micro-batch to a fact table kept by day; the same batch written again replaces
    itself. Read it with ``read_dated``."""
    dated = df.withColumns(
        {DAY_PARTITION: F.to_date(column), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    overwrite_partitions(dated, path, [DAY_PARTITION, "batch_id"], ["equipment_id", column])


def append_dated(df: DataFrame, path: str, column: str) -> None:
    """Add rows of a job, not of a stream, to a fact table kept by day; -1 stands for their batch."""
    dated = df.withColumns(
        {DAY_PARTITION: F.to_date(column), "batch_id": F.lit(-1).cast("bigint")}
    )
    dated.write.mode("append").partitionBy(DAY_PARTITION, "batch_id").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Add one micro-batch to a table without days; the same batch written again replaces itself,
    also when it has no rows."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def absent_rows(
    incoming: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Incoming rows whose key is not stored yet, one per key.

    Only the key columns of the stored table are read. The pick per key and the anti-join share
    one distribution of the incoming rows. Put a stored partition column among the keys to let
    Spark prune the stored side.
    """
    chosen = list(order) if order is not None else [F.col(c) for c in keys]
    once = first_per_key(incoming, keys, chosen)
    return once.join(existing.select(*keys), list(keys), "left_anti")


def insert_absent(
    incoming: DataFrame,
    existing: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
) -> None:
    """Append what ``absent_rows`` leaves."""
    absent_rows(incoming, existing, keys, order).write.mode("append").parquet(path)


def upsert(existing: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot in which changed keys have their new row; for tables without day partitions."""
    kept = existing.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes)
