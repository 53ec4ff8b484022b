"""Rewriting closed days of a table kept by day into few files, beside a stream that goes on writing.

A stream adds a folder per batch to every day it has rows of. For a day that is over, the batches
that cannot be replayed any more are first merged into a hidden folder beside the table; readers
(``read_dated``, ``dated_versions``, the lookup of stored ids) take that folder in place of what it
merges from the moment it is complete. A later run, when readers planned before have had ``grace``
seconds, drops the merged folders and puts the new one in their place. A run that ended anywhere is
finished by the next. Batches of the day that come later stand beside the merged one and are merged
with it another time.

Jobs that change stored rows call ``settle`` first; they and this job must not run at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigpulse.operators.latest import first_per_key
from rigpulse.schemas import DAY_PARTITION
from rigpulse.sources import folders

GRACE = 600.0
_MERGING = "_merging-"
# Rows of a day are dealt over files of about this many rows.
FILE_ROWS = 5_000_000

Pick = Callable[[DataFrame], DataFrame]


def mergeable(spark: SparkSession, path: str, before: date, least: int = 2) -> dict[date, list[int]]:
    """Closed days with at least ``least`` batches that may be merged: all of the stream but the
    newest of the whole table, which may be replayed. Folders of jobs (negative) are left out."""
    found = {d: sorted(folders.batches(spark, p)) for d, p in folders.days(spark, path).items()}
    newest = max((b for ids in found.values() for b in ids), default=0)
    closed = {d: [b for b in ids if 0 <= b < newest] for d, ids in found.items() if d < before}
    return {d: ids for d, ids in closed.items() if len(ids) >= least}


def _merge(
    spark: SparkSession, path: str, chosen: Mapping[date, Sequence[int]], newest: Pick | None,
    cluster: Sequence[str],
) -> None:
    """Merge the days in one job, then show each to readers with a mark of its own."""
    for left in folders.hidden(spark, path, done=False):
        if left.rsplit("/", 1)[1].startswith(_MERGING):
            folders.drop(spark, left)  # of a run that ended before it was done
    named = [f"{path}/{DAY_PARTITION}={d}/batch_id={b}" for d, ids in chosen.items() for b in ids]
    rows = spark.read.option("basePath", path).parquet(*named)
    rows = newest(rows) if newest else rows
    last = spark.createDataFrame(
        [(d, max(ids)) for d, ids in chosen.items()], f"{DAY_PARTITION} date, upto long"
    )
    parts = [DAY_PARTITION, "upto"]
    spread = rows.drop("batch_id").join(last, DAY_PARTITION).hint("rebalance", *parts)
    staged = f"{path}/{_MERGING}{uuid.uuid4().hex}"
    (
        spread.sortWithinPartitions(*parts, *cluster)
        .write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(*parts).parquet(staged)
    )
    for day, ids in chosen.items():
        at = f"{DAY_PARTITION}={day}/upto={max(ids)}"
        if folders.exists(spark, f"{staged}/{at}"):
            target = f"{path}/{folders.COMPACTING}/{at}"
            folders.drop(spark, target)  # shown to nobody without its mark
            folders.make(spark, target.rsplit("/", 1)[0])
            folders.rename(spark, f"{staged}/{at}", target)
            folders.touch(spark, f"{target}/{folders.DONE}")
    folders.drop(spark, staged)


def settle(spark: SparkSession, path: str, grace: float = -1.0) -> list[date]:
    """Put merged days that have stood for ``grace`` seconds in place of what they merge."""
    done = []
    for day, (upto, staged) in folders.merged_days(spark, path).items():
        if folders.age(spark, f"{staged}/{folders.DONE}") <= grace:
            continue
        at = f"{path}/{DAY_PARTITION}={day}"
        for batch, folder in folders.batches(spark, at).items():
            if 0 <= batch <= upto:
                folders.drop(spark, folder)
        folders.make(spark, at)
        folders.rename(spark, staged, f"{at}/batch_id={upto}")
        done.append(day)
    return done


def compact(
    spark: SparkSession,
    path: str,
    before: date,
    *,
    newest: Pick | None = None,
    cluster: Sequence[str] = (),
    grace: float = GRACE,
) -> list[date]:
    """Finish merges of earlier runs and merge the days before ``before``; the days merged now.

    ``newest`` picks the rows to keep where batches hold versions of the same rows; it is given
    batch_id.
    """
    settle(spark, path, grace)
    waiting = folders.merged_days(spark, path)
    chosen = {d: ids for d, ids in mergeable(spark, path, before).items() if d not in waiting}
    if chosen:
        _merge(spark, path, chosen, newest, cluster)
    return sorted(chosen)


def newest_versions(keys: Sequence[str]) -> Pick:
    return lambda rows: first_per_key(rows, keys, [F.col("batch_id").desc()])
