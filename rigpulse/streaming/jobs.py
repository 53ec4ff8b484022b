"""Streaming queries over raw messages: live tables, archive, window statistics."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rigpulse.operators.alerts import ALERT_COLUMNS, flag_alerts, from_alert_events, unite
from rigpulse.operators.enrich import enrich
from rigpulse.operators.latest import first_per_key, latest_per_key
from rigpulse.operators.windows import KEYS, sliding_stats
from rigpulse.schemas import (
    ALERT_DEFAULTS,
    ALERTS,
    ARCHIVE_PARTITIONS,
    ARCHIVED_EVENT,
    SENSOR_READINGS,
    TOPIC_SENSOR,
    WINDOW_STATS,
)
from rigpulse.sinks.alerts import write_alerts
from rigpulse.sinks.tables import (
    stored_readings,
    to_schema,
    write_archive,
    write_batch,
    write_dated,
)
from rigpulse.sources import folders
from rigpulse.sources.decode import DEVICE_ALERTS, SENSORS, decode, of_kind, parse_topics, quarantine
from rigpulse.sources.tables import read_dated, read_or_empty, with_defaults
from rigpulse.streaming.dedupe import (
    ARRIVED,
    archive_folder,
    day_folder,
    first_arrivals,
    remembered,
    unseen,
)
from rigpulse.streaming.late import on_time_stream, window_parts, write_split, write_window_parts
from rigpulse.streaming.progress import watched
from rigpulse.streaming.totals import write_batch_totals

# How late an event may be, and how often each query runs.
WATERMARK = "10 minutes"
LIVE_TRIGGER = "10 seconds"
ARCHIVE_TRIGGER = "60 seconds"
WINDOW_TRIGGER = "30 seconds"

# Seconds a reader may take over a folder of the standing table after a newer one is complete.
LATEST_GRACE = 600.0

READINGS_STORED = folders.dated_schema(SENSOR_READINGS)
ALERTS_STORED = folders.dated_schema(ALERTS)

# State kept on local disk per executor and backed up to the checkpoint, for large fleets.
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE_CONF = {
    PROVIDER_KEY: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of an executor share this much; else each takes memory of its own.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
}


# For a query whose state is small, as the windows of a feed in order of time: those of one
# micro-batch, without those of the batch before.
MEMORY_STORE_CONF = {
    PROVIDER_KEY: (
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    ),
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
}

# A query's state keeps the number of partitions it was first started with, so the job sets it
# before: about one for each core of a large cluster, not the default of 200.
STATE_PARTITIONS_KEY = "spark.sql.shuffle.partitions"
STATE_PARTITIONS = 1_000

# A query that drains what is there and stops needs no more than this many for a core.
DRAIN_PARTITIONS_PER_CORE = 4

ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def settings(spark: SparkSession, chosen: Mapping[str, str]) -> Iterator[None]:
    """Queries started inside have these settings; the session has its own again afterwards."""
    before = {key: spark.conf.get(key, None) for key in chosen}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def drain_conf(spark: SparkSession) -> dict[str, str]:
    """For queries that drain what is there: state as the job keeps it, on disk, and in few
    partitions, since a store costs time in every batch however little it holds."""
    most = DRAIN_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    few = min(int(spark.conf.get(STATE_PARTITIONS_KEY)), most)
    return {**STATE_STORE_CONF, STATE_PARTITIONS_KEY: str(few)}


@dataclass(frozen=True)
class Trigger:
    """Fixed interval, or all that is there and then stop when ``every`` is None."""

    every: str | None = None

    def options(self) -> dict:
        return {"availableNow": True} if self.every is None else {"processingTime": self.every}


DRAIN = Trigger()


def sensor_stream(messages: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """Decoded events under the watermark. ``dedupe`` drops repeated event ids that arrive
    within the watermark; rows later than that are dropped too, as their id is forgotten."""
    events = decode(messages).withWatermark("timestamp", WATERMARK)
    return events.dropDuplicatesWithinWatermark(["event_id"]) if dedupe else events


# Batch numbers of one checkpoint; the next checkpoint that writes the same table starts above.
GENERATION = 10**12


def _generation(spark: SparkSession, checkpoint: str, root: str) -> int:
    """How many other checkpoints wrote the table before this one; noted beside the table."""
    stored = spark.read.text(f"{checkpoint}/metadata").first()[0]
    query, registry = json.loads(stored)["id"], f"{root}/_streams"
    known = {}
    for path in folders.hidden(spark, registry, done=False):
        number, name = path.rsplit("/", 1)[1].split("_", 1)
        known[name] = int(number)
    if query not in known:
        known[query] = max(known.values(), default=-1) + 1
        folders.make(spark, f"{registry}/{known[query]}_{query}")
    return known[query]


def _recall(checkpoint: str) -> Callable[[SparkSession, int], list[int]]:
    """A look-up of the batches, as numbered in the table, whose ids the checkpoint's state holds."""
    known: dict[int, int] = {}

    def held(spark: SparkSession, batch_id: int) -> list[int]:
        own = batch_id % GENERATION
        return [batch_id - own + n for n in remembered(spark, checkpoint, own, known)]

    return held


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for what a batch writes. Spark turns it off in the session of a query with
    state, whose own shuffles must keep their partitions. Without it the rebalance hint does nothing
    and every task writes a file into every folder."""
    before = spark.conf.get(ADAPTIVE)
    spark.conf.set(ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(ADAPTIVE, before)


def _start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Trigger,
    mode: str = "append",
    name: str | None = None,
    root: str | None = None,
) -> StreamingQuery:
    """Start the query. With ``root``, the table it writes, batches get numbers that no other
    checkpoint used there, so a query begun anew adds to the table and replaces nothing."""
    first: list[int] = []

    def numbered(batch: DataFrame, batch_id: int) -> None:
        if root is not None and not first:
            first.append(GENERATION * _generation(batch.sparkSession, checkpoint, root))
        with adaptive(batch.sparkSession):
            write(batch, batch_id + (first[0] if first else 0))

    writer = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(numbered)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger.options())
    )
    return (writer.queryName(name) if name else writer).start()


def _unless_empty(batch: DataFrame, write: Callable[[], None]) -> None:
    """Persist the batch for the writes, skip them when it has no rows."""
    batch.persist()
    try:
        if not batch.isEmpty():
            write()
    finally:
        batch.unpersist()


def alert_rows(enriched: DataFrame, device: DataFrame | None = None) -> DataFrame:
    """Flag alerts, and those devices sent, as rows of the alerts table."""
    found = flag_alerts(enriched).select(*ALERT_COLUMNS)
    if device is not None:
        found = unite(found, from_alert_events(device))
    return to_schema(with_defaults(found, ALERT_DEFAULTS), ALERTS)


def live_query(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: Trigger = Trigger(LIVE_TRIGGER),
    *,
    split_late: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Readings, alerts and refused records of both topics, from one read and one parse.

    Alerts are those that the readings' flags give and those that devices send. An event or alert
    sent again is stored once: see ``rigpulse.streaming.dedupe``. The batch's totals are written
    last. ``split_late`` hands the events on to ``split_window_query`` and sets late ones aside.
    """
    held = _recall(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        def tables() -> None:
            sent = of_kind(batch, 0, SENSORS)
            events = unseen(
                sent, f"{root}/readings", READINGS_STORED, "event_id", "timestamp",
                day_folder("timestamp"), batch_id, held(batch.sparkSession, batch_id),
            ).persist()
            # Alerts of flags are in that table too, whose ids never were in the state.
            device = unseen(
                of_kind(batch, 1, DEVICE_ALERTS), f"{root}/alerts", ALERTS_STORED, "alert_id",
                "timestamp", day_folder("timestamp"), batch_id,
            )
            alerts = alert_rows(events, device).persist()
            readings = stored_readings(events)
            try:
                write_dated(readings, f"{root}/readings", "recorded_at", batch_id)
                write_alerts(alerts, f"{root}/alerts", batch_id)
                write_all_refused(batch, root, batch_id)
                if split_late:
                    write_split(events, root, batch_id, WATERMARK)
                write_batch_totals(readings, alerts, root, batch_id)
            finally:
                alerts.unpersist()
                events.unpersist()

        _unless_empty(batch, tables)

    parsed = watched(parse_topics(messages))
    # Refused records have no id to trust; each is its own.
    message = F.sha2(
        F.concat_ws("\u0001", "_topic", "_key", F.base64("_value"), F.col("kafka_timestamp")), 256
    )
    once = F.when(F.col("problem").isNull(), F.concat_ws("\u0001", "_topic", "_id")).otherwise(message)
    # Only refused records are stored as they came; texts of good ones are not shuffled or kept.
    slim = parsed.withColumn("_value", F.when(F.col("problem").isNotNull(), F.col("_value")))
    return _start(first_arrivals(slim, once), write, checkpoint, trigger, name=name, root=root)


def write_all_refused(batch: DataFrame, root: str, batch_id: int) -> None:
    """Refused records of every topic, after one look whether there are any."""
    if batch.where(F.col("problem").isNotNull()).isEmpty():
        return
    for kind, name in ((SENSORS, "quarantine"), (DEVICE_ALERTS, "quarantine_alerts")):
        refused = batch.where(F.coalesce(F.col("_topic"), F.lit("")) == kind.topic)
        write_refused(refused, f"{root}/{name}", batch_id)
    unknown = batch.where(F.col("problem") == "unknown_topic")
    write_refused(unknown, f"{root}/quarantine_topics", batch_id)


def write_refused(parsed: DataFrame, path: str, batch_id: int) -> None:
    """Refused records of a batch, none without any. A replay refuses the same records, so an empty
    batch has no earlier rows to replace."""
    refused = quarantine(parsed)
    if not refused.isEmpty():
        write_batch(refused, path, batch_id)


def _finished(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Complete batch folders of the standing table, oldest first."""
    found = [(int(n.removeprefix("batch_id=")), f"{root}/{n}") for n in folders.names(spark, root)]
    return sorted((b, p) for b, p in found if folders.exists(spark, f"{p}/{folders.DONE}"))


def latest_query(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: Trigger = Trigger(LIVE_TRIGGER),
    *,
    seed: Callable[[SparkSession], DataFrame] | None = None,
    grace: float = LATEST_GRACE,
    name: str | None = None,
) -> StreamingQuery:
    """A standing table of every machine's newest reading, so that the latest-state queries need
    not scan the history. Each batch writes a folder of its own from the one before it; readers
    take the newest complete one, and a folder is removed only when a newer one has been complete
    for ``grace`` seconds, so nobody's files vanish or change while they read.

    ``seed`` gives the readings stored before the first batch, so that machines silent since then
    are in the table too; the first batch alone reads them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, mine = batch.sparkSession, f"{root}/batch_id={batch_id}"
        if folders.exists(spark, f"{mine}/{folders.DONE}"):
            return  # A replay of a batch that was completed: readers may be in its folder.
        rows, before = stored_readings(batch), _finished(spark, root)
        if before:
            reader = spark.read.schema(SENSOR_READINGS)
            rows = rows.unionByName(reader.parquet(before[-1][1]))
        elif seed is not None:
            rows = rows.unionByName(seed(spark).select(*SENSOR_READINGS.fieldNames()))
        latest_per_key(rows).write.mode("overwrite").parquet(mine)
        for (_, old), (_, newer) in zip(before, before[1:]):
            if folders.age(spark, newer) > grace:
                folders.drop(spark, old)

    sensors = messages.where(F.col("topic") == TOPIC_SENSOR)
    return _start(decode(sensors), write, checkpoint, trigger, name=name, root=root)


def current_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest reading per machine, of the newest complete folder; readings columns.

    Every latest-state query takes this frame in place of the history, which gives the same rows
    from one row per machine. The frame stays readable for the grace time of ``latest_query``.
    """
    done = _finished(spark, root)
    path = done[-1][1] if done else root
    return spark.read.schema(SENSOR_READINGS).parquet(path)


def archive_query(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: Trigger = Trigger(ARCHIVE_TRIGGER),
    *,
    name: str | None = None,
) -> StreamingQuery:
    """Enriched events into the archive, each once, on its own slower clock to keep files large."""
    held = _recall(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        def archive() -> None:
            folder = archive_folder("timestamp", ARCHIVE_PARTITIONS[:-1])
            fresh = unseen(
                batch, root, ARCHIVED_EVENT, "event_id", "timestamp", folder, batch_id,
                held(batch.sparkSession, batch_id),
            )
            write_archive(fresh.drop(ARRIVED), root, batch_id)

        _unless_empty(batch, archive)

    events = enrich(decode(messages.where(F.col("topic") == TOPIC_SENSOR)))
    once = first_arrivals(events, F.col("event_id"))
    return _start(once, write, checkpoint, trigger, name=name, root=root)


def window_query(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Trigger = Trigger(WINDOW_TRIGGER),
    *,
    dedupe: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Changed windows of each trigger, added as a version to the window table, by day."""
    sensors = messages.where(F.col("topic") == TOPIC_SENSOR)
    stats = sliding_stats(enrich(sensor_stream(sensors, dedupe=dedupe)))

    def write(batch: DataFrame, batch_id: int) -> None:
        # One write, so nothing is kept for a second; without rows it writes none.
        write_dated(batch, path, "window_start", batch_id)

    return _start(stats, write, checkpoint, trigger, mode="update", name=name, root=path)


def split_window_query(
    spark: SparkSession, root: str, checkpoint: str, trigger: Trigger = Trigger(WINDOW_TRIGGER),
    *, name: str | None = None,
) -> StreamingQuery:
    """Window statistics of the events a live query with ``split_late`` hands on, stored so that
    late events can be added: read them with ``corrected_windows``."""
    parts = window_parts(on_time_stream(spark, root), WATERMARK)
    path = f"{root}/window_parts"
    write = write_window_parts(path)
    return _start(parts, write, checkpoint, trigger, mode="update", name=name, root=path)


def window_console(
    messages: DataFrame, checkpoint: str, trigger: Trigger = Trigger(WINDOW_TRIGGER),
    *, rows: int = 1_000,
) -> StreamingQuery:
    """The same statistics on the console, for a look while developing: ``rows`` of a trigger."""
    return (
        sliding_stats(enrich(sensor_stream(messages)))
        .writeStream.outputMode("update")
        .format("console")
        .option("truncate", False)
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger.options())
        .start()
    )


def current_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every window."""
    newest = [F.col("batch_id").desc()]
    versions = folders.read_days(spark, path, None, folders.dated_schema(WINDOW_STATS))
    current = first_per_key(versions, [*KEYS, "window_start"], newest)
    return current.select(*WINDOW_STATS.fieldNames())


def append_query(
    stream: DataFrame, path: str, checkpoint: str, trigger: Trigger = Trigger(LIVE_TRIGGER)
) -> StreamingQuery:
    """Any append stream into a table by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return _start(stream, write, checkpoint, trigger)


def routed_query(
    messages: DataFrame,
    writers: Mapping[str, Callable[[DataFrame, int], None]],
    checkpoint: str,
    trigger: Trigger = Trigger(LIVE_TRIGGER),
) -> StreamingQuery:
    """Several topics in one query: each topic's messages go to its writer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        def tables() -> None:
            for topic, writer in writers.items():
                writer(batch.where(F.col("topic") == topic), batch_id)

        _unless_empty(batch, tables)

    return _start(messages, write, checkpoint, trigger)


def stored_so_far(spark: SparkSession, root: str) -> DataFrame:
    """The readings the live tables hold, none before the first write."""
    return read_or_empty(
        lambda: read_dated(spark, f"{root}/readings", SENSOR_READINGS, "recorded_at"),
        spark, SENSOR_READINGS,
    )


def run_all(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    triggers: Sequence[Trigger] | None = None,
    *,
    split_late: bool = False,
    window_conf: Mapping[str, str] | None = None,
) -> list[StreamingQuery]:
    """The whole job over messages of both topics: live tables, the standing latest table, archive,
    windows; each with a checkpoint of its own. The triggers are those of the live tables, the
    archive, the windows. With ``split_late`` the windows follow the live tables and late events
    are kept to correct them; else the windows read the messages and drop late events.
    ``window_conf`` holds settings of the window query alone."""
    live, archive, windows = triggers or (
        Trigger(LIVE_TRIGGER),
        Trigger(ARCHIVE_TRIGGER),
        Trigger(WINDOW_TRIGGER),
    )
    spark = messages.sparkSession
    with settings(spark, window_conf or {}):
        if split_late:
            window = split_window_query(
                spark, root, f"{checkpoint}/split-windows", windows, name="windows"
            )
        else:
            window = window_query(
                messages, f"{root}/windows", f"{checkpoint}/windows", windows, dedupe=True,
                name="windows",
            )
    return [
        live_query(messages, root, f"{checkpoint}/live", live, split_late=split_late, name="live"),
        latest_query(
            messages, f"{root}/latest", f"{checkpoint}/latest", live,
            seed=lambda spark: stored_so_far(spark, root), name="latest",
        ),
        archive_query(
            messages, f"{root}/archive", f"{checkpoint}/archive", archive, name="archive"
        ),
        window,
    ]


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries that stop by themselves, and raise what failed."""
    for query in queries:
        query.awaitTermination()
