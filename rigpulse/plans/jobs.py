"""The scheduled jobs: gates, writes and checks in order. Each may be run again for the same day.

    spark-submit --py-files rigpulse.zip rigpulse/plans/jobs.py daily-kpi \\
        --root s3a://bucket/fleet --as-of "2025-01-02 00:00:00"
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigpulse import schemas as C
from rigpulse.operators import health, kpi, maintenance, quality, retention
from rigpulse.operators.windows import KEYS
from rigpulse.session import build_session, scratch_dir
from rigpulse.sinks import compaction
from rigpulse.sinks import tables as sinks
from rigpulse.sinks.alerts import resolve_stored
from rigpulse.sources import tables as sources
from rigpulse.sources.streams import kafka_stream
from rigpulse.streaming import jobs as streams
from rigpulse.streaming import totals
from rigpulse.streaming.progress import ProgressLog, read_progress, stream_health


def run_daily_kpi(
    readings: DataFrame,
    equipment: DataFrame,
    alerts: DataFrame,
    kpi_path: str,
    target_date: date | str,
    minimum: int = quality.MIN_SOURCE_ROWS,
) -> dict:
    """Check the day's readings, replace the day's KPI rows, check them; both reports' values."""
    spark = readings.sparkSession
    source = quality.require(quality.source_gate(readings, target_date, minimum))
    rows = kpi.daily_kpi(readings, equipment, alerts, target_date)
    sinks.write_kpis(sinks.to_schema(rows, C.DAILY_KPI), kpi_path)
    written = spark.read.schema(C.DAILY_KPI).parquet(kpi_path)
    output = quality.require(quality.output_gate(written, target_date))
    return {**source, **output}


def run_maintenance(
    readings: DataFrame,
    equipment: DataFrame,
    sites: DataFrame,
    alerts_path: str,
    logs_path: str,
    as_of: str,
) -> tuple[dict, DataFrame]:
    """Add the day's service alerts and log entries; the counts and the report lines.

    The status list, one row per machine, is written once and read by all three outputs.
    """
    spark = readings.sparkSession
    listed = scratch_dir(spark, "service-list")
    maintenance.service_list(readings, equipment, sites).write.parquet(listed)
    services = spark.read.parquet(listed)

    alerts = sources.with_defaults(maintenance.service_alerts(services, as_of), C.ALERT_DEFAULTS)
    # The ids of service alerts hold their day, so only the folder of that day can have them.
    day = datetime.combine(datetime.fromisoformat(as_of).date(), datetime.min.time())
    stored = sources.read_or_empty(
        lambda: sources.read_dated(
            spark, alerts_path, C.ALERTS, "triggered_at", day, day + timedelta(days=1)
        ),
        spark,
        C.ALERTS,
    )
    fresh = sinks.to_schema(alerts, C.ALERTS)
    # An alert already resolved stays resolved: its id is found and nothing is added. The table is
    # the one the stream writes, so open alerts and the KPI's counts see service alerts too.
    sinks.append_dated(
        sinks.absent_rows(fresh, stored, ["alert_id"]), alerts_path, "triggered_at"
    )
    totals.recount_job_alerts(spark, alerts_path, datetime.fromisoformat(as_of).date())

    logs = sources.read_or_empty(
        lambda: spark.read.schema(C.MAINTENANCE_LOGS).parquet(logs_path), spark, C.MAINTENANCE_LOGS
    )
    entries = maintenance.service_logs(services, logs, as_of)
    made = entries.withColumn("created_at", F.lit(as_of).cast("timestamp"))
    sinks.to_schema(made, C.MAINTENANCE_LOGS).write.mode("append").parquet(logs_path)

    counts = maintenance.service_counts(services).first().asDict()
    return counts, maintenance.service_report(services)


def run_health_check_standing(
    spark: SparkSession, root: str, as_of: str, minimum: int = health.MIN_RECENT_ROWS
) -> dict:
    """The same verdict from totals and the newest day folders."""
    return quality.require(totals.ingest_health_standing(spark, root, as_of, minimum), "healthy")


def run_stream_check(spark: SparkSession, root: str, as_of: str) -> dict:
    """Whether the stream's queries go on and keep up, from the progress they log."""
    day_before = str(datetime.fromisoformat(as_of).date() - timedelta(days=1))
    progress = read_progress(spark, f"{root}/progress", day_before)
    return quality.require(stream_health(progress, as_of), "flowing")


def run_health_check(
    readings: DataFrame, alerts: DataFrame, as_of: str, minimum: int = health.MIN_RECENT_ROWS
) -> dict:
    """Totals when ingest is recent enough, else an error."""
    return quality.require(health.ingest_health(readings, alerts, as_of, minimum), "healthy")


def run_resolve(
    spark: SparkSession, root: str, alert_ids: Sequence[str], as_of: str
) -> int:
    """Close alerts by id in the stored table; how many were open."""
    ids = spark.createDataFrame([(i,) for i in alert_ids], "alert_id string")
    return resolve_stored(spark, f"{root}/alerts", ids, as_of)


def run_retention(
    spark: SparkSession, root: str, as_of: str, days: int = retention.RETENTION_DAYS
) -> DataFrame:
    """Move expired months of the readings from ``readings`` to ``expired``; the plan that was
    carried out, with the counts from before. Totals leave the moved folders out."""
    path = f"{root}/readings"
    counts = totals.day_counts(spark, root)
    plan = retention.folder_plan(spark, path, as_of, days, counts=counts).collect()
    retention.expire_folders(
        spark, path, f"{root}/expired", C.SENSOR_READINGS, as_of, days,
        cluster=["equipment_id", "recorded_at"],
        before_drop=lambda moved: totals.note_dropped(spark, root, moved),
    )
    return spark.createDataFrame(
        plan, "partition_name string, month date, rows long, expired boolean"
    )


def run_compaction(
    spark: SparkSession, root: str, as_of: str, grace: float = compaction.GRACE
) -> dict:
    """Merge days that are over by more than the watermark, and fold the totals; days by table."""
    before = (datetime.fromisoformat(as_of) - timedelta(hours=1)).date()
    newest = compaction.newest_versions([*KEYS, "window_start"])
    chosen = {
        "readings": (["equipment_id", "recorded_at"], None),
        "alerts": (["equipment_id", "triggered_at"], None),
        "late": (["equipment_id", "timestamp"], None),
        "windows": (["equipment_id", "window_start"], newest),
    }
    done = {
        name: compaction.compact(
            spark, f"{root}/{name}", before, newest=pick, cluster=cluster, grace=grace
        )
        for name, (cluster, pick) in chosen.items()
    }
    totals.fold(spark, root)
    return {name: [str(d) for d in days] for name, days in done.items()}


def fleet_tables(
    spark: SparkSession, root: str, day: date | None = None
) -> Mapping[str, DataFrame]:
    """The stored tables under a folder, as the streaming job lays them out; with a day, the two
    fact tables are narrowed to it by folder. ``newest`` is the stream's standing table of newest
    readings, or the readings where no stream keeps one."""
    start = datetime.combine(day, datetime.min.time()) if day else None
    end = start + timedelta(days=1) if start else None
    dated = lambda name, schema, column: sources.read_or_empty(
        lambda: sources.read_dated(spark, f"{root}/{name}", schema, column, start, end),
        spark, schema,
    )
    readings = dated("readings", C.SENSOR_READINGS, "recorded_at")
    return {
        "readings": readings,
        "newest": sources.read_or(
            lambda: streams.current_latest(spark, f"{root}/latest"), lambda: readings
        ),
        "alerts": dated("alerts", C.ALERTS, "triggered_at"),
        "equipment": spark.read.schema(C.EQUIPMENT).parquet(f"{root}/equipment"),
        "sites": spark.read.schema(C.SITES).parquet(f"{root}/sites"),
    }


def _moment(text: str) -> str:
    return datetime.fromisoformat(text).strftime("%Y-%m-%d %H:%M:%S")


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Fleet telemetry jobs")
    names = ["daily-kpi", "maintenance", "health", "retention", "resolve", "compact", "stream"]
    parser.add_argument("job", choices=names)
    parser.add_argument("--root", required=True, help="folder of the stored tables")
    parser.add_argument(
        "--as-of", type=_moment, default=datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
        help="the moment taken for now, YYYY-MM-DD HH:MM:SS in UTC; else the clock",
    )
    parser.add_argument("--servers", help="Kafka bootstrap servers, for the stream")
    parser.add_argument("--checkpoint", help="checkpoint folder, for the stream")
    parser.add_argument("--starting-offsets", default="latest", help="for the stream's first start")
    parser.add_argument("--max-offsets", type=int, help="most offsets of a trigger; else no limit")
    parser.add_argument("--min-partitions", type=int, help="least tasks of a trigger's scan")
    parser.add_argument(
        "--allow-data-loss", action="store_true", help="go on when the broker deleted offsets"
    )
    parser.add_argument(
        "--keep-late", action="store_true", help="set late events aside to correct windows"
    )
    parser.add_argument("--alert-id", nargs="+", help="alerts to close, for resolve")
    parser.add_argument(
        "--state-partitions", type=int, default=streams.STATE_PARTITIONS,
        help="partitions of the stream's state, fixed by its first start",
    )
    args = parser.parse_args(arguments)
    if args.job == "resolve" and not args.alert_id:
        parser.error("resolve needs --alert-id")
    if args.job == "stream" and not (args.servers and args.checkpoint):
        parser.error("the stream needs --servers and --checkpoint")
    if args.job == "stream":
        conf = {streams.STATE_PARTITIONS_KEY: str(args.state_partitions)}
        spark = build_session("rigpulse-stream", **streams.STATE_STORE_CONF, **conf)
        messages = kafka_stream(
            spark, args.servers, topics=(C.TOPIC_SENSOR, C.TOPIC_ALERTS), starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions,
            fail_on_data_loss=not args.allow_data_loss,
        )
        spark.streams.addListener(ProgressLog(spark, f"{args.root}/progress"))
        streams.run_all(messages, args.root, args.checkpoint, split_late=args.keep_late)
        spark.streams.awaitAnyTermination()
        return

    spark, root, as_of = build_session(f"rigpulse-{args.job}"), args.root, args.as_of
    if args.job == "daily-kpi":
        day = kpi.default_target_date(as_of)
        t = fleet_tables(spark, root, day)
        print(run_daily_kpi(t["readings"], t["equipment"], t["alerts"], f"{root}/daily_kpi", day))
        return
    if args.job == "compact":
        print(run_compaction(spark, root, as_of))
        return
    if args.job == "resolve":
        print({"resolved": run_resolve(spark, root, args.alert_id, as_of)})
        return
    t = fleet_tables(spark, root)
    if args.job == "maintenance":
        counts, report = run_maintenance(
            t["newest"], t["equipment"], t["sites"],
            f"{root}/alerts", f"{root}/maintenance_logs", as_of,
        )
        print(counts)
        report.select("line").write.mode("overwrite").text(f"{root}/service_report")
    elif args.job == "health":
        if totals.kept(spark, root):
            print(run_health_check_standing(spark, root, as_of))
            print(run_stream_check(spark, root, as_of))
        else:
            print(run_health_check(t["readings"], t["alerts"], as_of))
    else:
        run_retention(spark, root, as_of).write.mode("overwrite").parquet(f"{root}/retention_plan")


if __name__ == "__main__":
    main()
