"""Named queries: every operator and read query over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rigpulse.functions.rules import severity_order
from rigpulse.functions.text import month_name
from rigpulse.functions.time import on_day, trailing, with_date_parts
from rigpulse.operators import alerts as A
from rigpulse.operators import enrich as E
from rigpulse.operators import health as H
from rigpulse.operators import kpi as K
from rigpulse.operators import latest as L
from rigpulse.operators import maintenance as M
from rigpulse.operators import quality as Q
from rigpulse.operators import retention as N
from rigpulse.operators import windows as W
from rigpulse.plans import reads as P
from rigpulse.plans.portable import portable
from rigpulse.schemas import (
    ALERT_DEFAULTS,
    ALERT_EVENT,
    ALERTS,
    DAILY_KPI,
    DAY_PARTITION,
    DOMAINS,
    MAX_LENGTHS,
    NOT_NULL,
    SENSOR_READINGS,
    TOPIC_ALERTS,
    TOPIC_SENSOR,
)
from rigpulse.plans.jobs import run_compaction, run_maintenance
from rigpulse.session import saved, scratch_dir
from rigpulse.sinks import tables as S
from rigpulse.sinks.alerts import resolve_stored
from rigpulse.sources import decode as D
from rigpulse.sources import folders
from rigpulse.sources import tables as T
from rigpulse.sources import warehouse as WH
from rigpulse.sources.streams import RAW_MESSAGE, file_stream
from rigpulse.streaming import jobs as J
from rigpulse.streaming import late as LA
from rigpulse.streaming import totals as TO
from rigpulse.streaming.progress import ProgressLog, totals_by_query

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}

# Parameters of the queries, repeated as literals in the SQL twins.
MACHINE = "7"
SITE = "3"
ORDERS_AS_OF = "1998-01-01 00:00:00"
ORDER_MONTHS = tuple(f"{year}_{month:02d}" for year in (1996, 1997) for month in range(1, 13))


def _query(fn: Callable[[WH.Warehouse], DataFrame]) -> Callable[[WH.Warehouse], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(WH.Warehouse(spark, sf_dir))

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _january(day: int) -> datetime:
    return datetime(2024, 1, day)


# Sources and sinks


@_query
def json_decode(w):
    return portable(D.decode(w.messages()))


def _damaged(w) -> DataFrame:
    """Messages damaged in a way that depends on the event type, keyed by event id."""
    text = F.col("value").cast("string")
    kind = F.get_json_object(text, "$.status")
    broken = (
        F.when(kind == "fault", F.lit("no json at all"))
        .when(kind == "idle", F.regexp_replace(text, '"site_id":"[^"]*"', '"site_id":null'))
        .when(
            kind == "maintenance",
            F.regexp_replace(text, '"engine_rpm":[^,]*', '"engine_rpm":"fast"'),
        )
        .otherwise(text)
    )
    keyed = D.encode(w.events(), key="event_id")
    return keyed.withColumn("value", F.encode(broken, "UTF-8"))


@_query
def malformed_split(w):
    parsed = D.parse(_damaged(w))
    outcome = F.coalesce("problem", F.lit("valid")).alias("outcome")
    return parsed.select(F.col("_key").alias("event_id"), outcome)


def _alert_messages(w) -> DataFrame:
    sent = w.alerts().withColumnRenamed("triggered_at", "timestamp")
    return D.encode(sent, topic=TOPIC_ALERTS, schema=ALERT_EVENT)


@_query
def topic_routing(w):
    sensors, alerts = D.route(w.messages().unionByName(_alert_messages(w)))
    sides = [
        side.groupBy("equipment_id", F.lit(topic).alias("topic")).agg(F.count("*").alias("rows"))
        for side, topic in ((sensors, TOPIC_SENSOR), (alerts, TOPIC_ALERTS))
    ]
    return sides[0].unionByName(sides[1])


@_query
def archive_round_trip(w):
    root = scratch_dir(w.spark, "archive")
    S.write_archive(w.enriched(), root, 0)
    start, end = _january(10), _january(13)
    kept = T.read_archive(w.spark, root, start, end)
    columns = ["event_id", "equipment_id", "timestamp", "has_anomaly", "year", "month", "day"]
    return portable(kept.select(*columns, "site_id"))


@_query
def stored_readings(w):
    return portable(S.stored_readings(w.events()))


@_query
def stored_readings_scaled(w):
    """The decimals of the readings table digit by digit."""
    return portable(S.stored_readings(w.events()), scaled=True)


@_query
def stored_kpi_scaled(w):
    """The decimals of the KPI table digit by digit."""
    return portable(S.to_schema(w.daily_kpi(), DAILY_KPI), scaled=True)


@_query
def stored_alerts_scaled(w):
    """Alerts in their stored types with the defaulted column."""
    return portable(J.alert_rows(w.enriched()).select(*A.ALERT_COLUMNS, "acknowledged"), scaled=True)


@_query
def kpi_upsert(w):
    """All days written, then one day written again."""
    path = scratch_dir(w.spark, "daily-kpi")
    S.write_kpis(w.daily_kpi(), path)
    again = K.daily_kpi(w.readings(), w.equipment(), w.unplaced_alerts(), WH.KPI_DAY)
    S.write_kpis(again, path)
    return portable(w.spark.read.parquet(path).select(*K.KPI_COLUMNS))


@_query
def stored_kpi(w):
    return portable(S.to_schema(w.daily_kpi(), DAILY_KPI))


@_query
def insert_if_absent(w):
    """The days before the KPI day are stored; all readings arrive, each of them twice."""
    rows = w.readings().select("event_id", "equipment_id", "recorded_at")
    stored = rows.where(F.col("recorded_at") < F.lit(WH.KPI_DAY).cast("timestamp"))
    fresh = S.absent_rows(rows.unionByName(rows), stored, ["event_id"])
    return portable(stored.unionByName(fresh))


@_query
def kpi_snapshot_upsert(w):
    """The same upsert on a table without day folders: one day's rows replaced."""
    kpis = w.daily_kpi()
    day = F.col("kpi_date") == F.lit(WH.KPI_DAY).cast("date")
    changed = kpis.where(day).withColumn("alert_count", F.col("alert_count") + 1)
    merged = S.upsert(kpis, changed, ["equipment_id", "kpi_date"])
    return merged.select("equipment_id", "kpi_date", "alert_count")


# Projections and filters


@_query
def reading_projection(w):
    columns = ["equipment_id", "engine_temp_c", "oil_pressure_kpa", "fuel_level_pct", "status"]
    return portable(w.events().select(F.col("timestamp").alias("recorded_at"), *columns))


@_query
def day_readings(w):
    rows = w.readings().where(on_day(F.col("recorded_at"), WH.KPI_DAY))
    return portable(rows.select("event_id", "equipment_id", "recorded_at", "engine_temp_c"))


@_query
def recent_readings(w):
    rows = w.readings().where(trailing(F.col("recorded_at"), WH.AS_OF, hours=48))
    return portable(rows.select("event_id", "equipment_id", "recorded_at", "status"))


@_query
def active_equipment(w):
    return portable(w.equipment().where(F.col("active")))


@_query
def archive_dates(w):
    parts = with_date_parts(F.col("recorded_at"))
    return (
        w.readings()
        .withColumns(parts)
        .groupBy("year", "month", "day")
        .agg(F.count("*").alias("rows"))
    )


# Aggregates


@_query
def alert_counts_by_day(w):
    return K.alert_counts(w.unplaced_alerts())


@_query
def reading_totals(w):
    return portable(H.reading_counts(w.readings(), WH.AS_OF))


@_query
def kpi_summary(w):
    return portable(K.kpi_summary(w.daily_kpi()))


@_query
def fuel_integrated(w):
    return portable(K.fuel_integrated(w.readings()))


# Latest, history, feed


@_query
def equipment_latest(w):
    return portable(P.equipment_latest(w.readings(), w.equipment()))


@_query
def equipment_latest_filtered(w):
    rows = P.equipment_latest(w.readings(), w.equipment(), site_id=SITE, status="operating")
    return portable(rows)


@_query
def latest_service_hours(w):
    return portable(L.service_hours(w.readings()))


@_query
def equipment_history(w):
    return portable(P.equipment_history(w.readings(), MACHINE, WH.AS_OF, hours=168))


@_query
def status_feed(w):
    return portable(L.status_feed(w.readings(), w.equipment()))


# Anomalies, alerts


@_query
def anomaly_enrichment(w):
    columns = ["event_id", "anomaly_flags", "has_anomaly", "is_critical"]
    return portable(w.enriched().select(*columns))


@_query
def site_lookup(w):
    rows = E.with_site(w.events(), w.sites())
    return portable(rows.select("event_id", "site_id", "site_name", "state"))


@_query
def flag_alerts(w):
    return portable(A.flag_alerts(w.events()).select(*A.ALERT_COLUMNS))


@_query
def limit_alerts(w):
    return portable(w.alerts().select(*A.ALERT_COLUMNS))


@_query
def alert_union(w):
    services = M.service_list(w.readings(), w.equipment(), w.sites())
    united = A.unite(
        A.flag_alerts(w.events()), w.alerts(), M.service_alerts(services, WH.AS_OF)
    )
    return portable(united)


@_query
def open_alerts(w):
    rows = A.open_alerts(w.alerts(), w.sites(), WH.AS_OF).orderBy(*A.priority())
    return portable(rows, exact=["hours_open"])


@_query
def open_alerts_top(w):
    return portable(P.open_alerts(w.alerts(), w.sites(), WH.AS_OF), exact=["hours_open"])


@_query
def open_alerts_filtered(w):
    rows = P.open_alerts(w.alerts(), w.sites(), WH.AS_OF, severity="WARNING", site_id=SITE)
    return portable(rows, exact=["hours_open"])


@_query
def alert_stats(w):
    rows = P.alert_stats(w.alerts(), WH.AS_OF, hours=72)
    return rows.withColumn("severity_rank", severity_order(F.col("severity")))


@_query
def resolve_alerts(w):
    alerts = w.alerts()
    ids = alerts.where(F.col("severity") == "CRITICAL").select("alert_id")
    return portable(A.resolve(alerts, ids, WH.AS_OF).select("alert_id", "severity", "resolved_at"))


# Key figures


@_query
def daily_kpi(w):
    rows = K.daily_kpi(w.readings(), w.equipment(), w.unplaced_alerts(), WH.KPI_DAY)
    return portable(rows)


@_query
def kpi_history(w):
    return portable(P.daily_kpis(w.daily_kpi(), WH.AS_OF, days=7))


@_query
def kpi_history_filtered(w):
    rows = P.daily_kpis(w.daily_kpi(), WH.AS_OF, days=30, equipment_id=MACHINE)
    return portable(rows)


@_query
def kpi_history_response(w):
    return portable(P.daily_kpi_response(w.daily_kpi(), WH.AS_OF, days=3))


@_query
def kpi_history_site(w):
    return portable(P.daily_kpis(w.daily_kpi(), WH.AS_OF, days=14, site_id=SITE))


# Windows


@_query
def sliding_stats(w):
    return portable(W.sliding_stats_by_pane(w.enriched()))


@_query
def sliding_stats_single_pass(w):
    return portable(W.sliding_stats(w.enriched()))


@_query
def tumbling_stats(w):
    return portable(W.sliding_stats_by_pane(w.enriched(), length=5, slide=5))


# Health and dashboard


@_query
def fleet_health(w):
    return P.fleet_health(w.readings(), w.equipment(), w.sites())


@_query
def fleet_health_with_idle(w):
    return H.fleet_health(w.readings(), w.equipment(), w.sites(), with_idle=True)


@_query
def ingest_stats(w):
    return portable(P.ingest_stats(w.readings(), w.equipment(), w.alerts(), WH.AS_OF))


@_query
def ingest_health(w):
    return portable(H.ingest_health(w.readings(), w.alerts(), WH.AS_OF))


@_query
def ingest_recency(w):
    return H.ingest_recency(w.readings(), "2024-01-15 12:00:00")


@_query
def dashboard_stats(w):
    return portable(H.dashboard_stats(w.readings(), w.equipment(), w.alerts(), WH.AS_OF))


@_query
def temperature_series(w):
    rows = H.temperature_series(w.readings(), "2024-01-20 00:00:00", "2024-01-22 12:00:00")
    return portable(rows)


@_query
def alert_panel(w):
    return portable(P.alert_panel(w.alerts(), w.sites(), WH.AS_OF))


@_query
def fleet_panel(w):
    return P.fleet_panel(w.readings(), w.equipment(), w.sites())


# Maintenance


def _services(w) -> DataFrame:
    return M.service_list(w.readings(), w.equipment(), w.sites())


@_query
def service_status_list(w):
    return portable(_services(w))


@_query
def service_counts(w):
    return M.service_counts(_services(w))


@_query
def service_alerts(w):
    return portable(M.service_alerts(_services(w), WH.AS_OF))


@_query
def service_logs(w):
    return portable(M.service_logs(_services(w), w.maintenance_logs(), WH.AS_OF))


@_query
def service_report(w):
    return portable(M.service_report(_services(w)))


@_query
def parts_replaced(w):
    parts = w.table("lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "CAST(l_partkey AS STRING) AS part"
    )
    listed = M.parts_by_log(w.maintenance_logs(keep=["o_orderkey"]), parts, "o_orderkey")
    return portable(listed.select("log_id", "equipment_id", "service_date", "parts_replaced"))


# Quality


@_query
def source_gate(w):
    return Q.source_gate(w.readings(), WH.KPI_DAY)


@_query
def output_gate(w):
    return portable(Q.output_gate(w.daily_kpi(), WH.KPI_DAY))


@_query
def duplicate_keys(w):
    return Q.duplicate_keys(w.maintenance_logs(), ["equipment_id", "service_date"])


@_query
def orphan_logs(w):
    return Q.orphans(w.maintenance_logs(), w.equipment().where(F.col("active")), "equipment_id")


def _column_report(df: DataFrame, table: str) -> DataFrame:
    rules: dict[str, Column] = Q.column_rules(
        NOT_NULL[table], MAX_LENGTHS.get(table, {}), DOMAINS.get(table, {}), df.columns
    )
    return Q.violations(df, rules).withColumn("checked", F.lit(table))


@_query
def column_checks(w):
    reports = [
        _column_report(w.readings(), "sensor_readings"),
        _column_report(w.sites(), "sites"),
        _column_report(w.maintenance_logs(), "maintenance_logs"),
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@_query
def column_checks_derived(w):
    """The other three tables with column rules."""
    reports = [
        _column_report(w.equipment(), "equipment"),
        _column_report(T.with_defaults(w.alerts(), ALERT_DEFAULTS), "alerts"),
        _column_report(S.to_schema(w.daily_kpi(), DAILY_KPI), "daily_kpi"),
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


# Retention


def _order_history(w) -> DataFrame:
    return w.table("orders").select("o_orderkey", F.col("o_orderdate").alias("recorded_at"))


@_query
def month_routing(w):
    routed = N.route_months(_order_history(w), declared=ORDER_MONTHS)
    return routed.groupBy("partition_name").agg(F.count("*").alias("rows"))


@_query
def expired_partitions(w):
    routed = N.route_months(_order_history(w), declared=ORDER_MONTHS)
    names = routed.select("partition_name").distinct()
    return N.expired_names(names, ORDERS_AS_OF, legacy=True)


@_query
def retention_plan(w):
    return N.retention_plan(w.readings(), "2024-06-30 00:00:00")


@_query
def retention_plan_long_history(w):
    return N.retention_plan(_order_history(w), ORDERS_AS_OF)


# The order history as a stored table; its folders hold a month each.
_ORDERS = StructType().add("o_orderkey", "long").add("recorded_at", "timestamp")


def _store_orders(rows: DataFrame, path: str, batch_id: int) -> None:
    month = F.trunc(F.to_date("recorded_at"), "month")
    dated = rows.withColumns(
        {DAY_PARTITION: month, "batch_id": F.lit(batch_id).cast("bigint")}
    )
    S.overwrite_partitions(dated, path, [DAY_PARTITION, "batch_id"])


def _both_sides(w, root: str) -> DataFrame:
    """Rows of the table and of the archive, each read as a table kept by day."""
    sides = [
        T.read_dated(w.spark, f"{root}/{side}", _ORDERS, "recorded_at")
        .withColumn("partition_name", month_name(N.STEM, F.col("recorded_at")))
        .withColumn("side", F.lit(side))
        for side in ("kept", "archived")
    ]
    return portable(sides[0].unionByName(sides[1]))


@_query
def retention_apply(w):
    """Expired months moved to the archive by folder; both sides."""
    root = scratch_dir(w.spark, "retention")
    _store_orders(_order_history(w), f"{root}/kept", 0)
    N.expire_folders(w.spark, f"{root}/kept", f"{root}/archived", _ORDERS, ORDERS_AS_OF)
    return _both_sides(w, root)


@_query
def retention_rerun(w):
    """A month of the archive gets late rows, some with a batch that is stored there already; the
    job runs after each and once more."""
    root = scratch_dir(w.spark, "retention-rerun")
    orders, part = _order_history(w), F.pmod("o_orderkey", F.lit(3))
    recent = F.col("recorded_at") >= "1997-10-01"
    for rows, number in (
        (orders.where(part == 0), 0),
        (orders.where(part == 1), 1),
        (orders.where((part == 2) & recent), 2),
        (orders.where((part == 2) & ~recent), 1),
        (None, 0),
    ):
        if rows is not None:
            _store_orders(rows, f"{root}/kept", number)
        N.expire_folders(w.spark, f"{root}/kept", f"{root}/archived", _ORDERS, ORDERS_AS_OF)
    return _both_sides(w, root)


# Streams


def _event_stream(w) -> DataFrame:
    """The events table as a stream of keyed JSON messages. A pattern, unlike a plain path,
    names a single file as well as a folder of files."""
    path = f"{w.root}/[e]vents.parquet"
    rows = w.spark.readStream.schema(w.table("events").schema).parquet(path)
    return D.encode(WH.events_from_readings(WH.readings_from_events(rows), w.equipment()))


def _event_batches(w, files: int = 3) -> DataFrame:
    """The events as ranges of time in a file each, one file to a micro-batch."""
    path = scratch_dir(w.spark, "event-files")
    w.table("events").repartitionByRange(files, "ts").write.parquet(path)
    reader = w.spark.readStream.schema(w.table("events").schema)
    rows = reader.option("maxFilesPerTrigger", 1).parquet(path)
    return D.encode(WH.events_from_readings(WH.readings_from_events(rows), w.equipment()))


def _files(w) -> int:
    return max(1, -(-w.table("events").count() // FILE_MESSAGES))


def _ordered_events(w, files: int) -> str:
    """The events as files of rising ranges of time; their folder."""
    path = scratch_dir(w.spark, "ordered-events")
    w.table("events").repartitionByRange(files, "ts").write.parquet(path)
    folders.order_files(w.spark, path)
    return path


def _ordered_feed(w) -> DataFrame:
    """The events as files of rising ranges of time, so that none is late, ``ORDERED_FILES`` to a
    micro-batch: the windows in state are those of a micro-batch, not of the whole table."""
    path = _ordered_events(w, _files(w))
    reader = w.spark.readStream.schema(w.table("events").schema)
    rows = reader.option("maxFilesPerTrigger", ORDERED_FILES).parquet(path)
    return D.encode(WH.events_from_readings(WH.readings_from_events(rows), w.equipment()))


def _run_whole_job(w, root: str, batches: int = 1) -> None:
    """All queries of the job over the events as message files of rising ranges of time, made once
    for the four of them; ``JOB_FILES`` to a micro-batch, and at least so many micro-batches."""
    path = scratch_dir(w.spark, "ordered-messages")
    files = max(batches, _files(w))
    D.encode(w.events().repartitionByRange(files, "timestamp")).write.parquet(path)
    folders.order_files(w.spark, path)
    stream = file_stream(w.spark, path, max_files_per_trigger=min(JOB_FILES, -(-files // batches)))
    with J.settings(w.spark, J.drain_conf(w.spark)):
        started = J.run_all(
            stream, root, f"{root}/checkpoint", [J.DRAIN] * 3, window_conf=J.MEMORY_STORE_CONF
        )
    J.drain(*started)


class _Fed(WH.Warehouse):
    """The tables with the events as a stream of files under a path, so many to a micro-batch."""

    def __init__(self, w: WH.Warehouse, path: str, files: int):
        super().__init__(w.spark, w.root)
        self.path, self.files = path, files

    def table(self, name: str) -> DataFrame:
        rows = super().table(name)
        if name != "events":
            return rows
        reader = self.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", self.files)
        return reader.parquet(self.path)


def _standing(w) -> DataFrame:
    root = scratch_dir(w.spark, "stream-latest")
    J.drain(J.latest_query(_event_batches(w), f"{root}/latest", f"{root}/checkpoint", J.DRAIN))
    return J.current_latest(w.spark, f"{root}/latest")


@_query
def stream_sliding_stats(w):
    root = scratch_dir(w.spark, "stream-windows")
    J.drain(J.window_query(_ordered_feed(w), f"{root}/windows", f"{root}/checkpoint", J.DRAIN))
    return portable(J.current_windows(w.spark, f"{root}/windows"))


@_query
def stream_live_alerts(w):
    root = scratch_dir(w.spark, "stream-live")
    J.drain(J.live_query(_event_stream(w), root, f"{root}/checkpoint", J.DRAIN))
    alerts = T.read_dated(w.spark, f"{root}/alerts", ALERTS, "triggered_at")
    return portable(alerts.select(*A.ALERT_COLUMNS))


@_query
def stream_latest(w):
    newest = _standing(w)
    return portable(newest.select("equipment_id", "event_id", "recorded_at", "status"))


@_query
def fleet_status_standing(w):
    """Machines by status from the standing table; the averages, of stored decimals, are left to
    ``fleet_health``."""
    counted = ["total_machines", "operating", "in_fault", "in_maintenance", "idle"]
    health = H.fleet_health(_standing(w), w.equipment(), w.sites(), with_idle=True)
    return health.select("site_id", "site_name", "equipment_type", *counted)


@_query
def latest_standing(w):
    """Newest reading of each machine with master data, served by the standing table."""
    rows = P.equipment_latest(_standing(w), w.equipment())
    return portable(rows.select("equipment_id", "equipment_type", "site_id", "recorded_at", "status"))


@_query
def stream_dedupe(w):
    """Every message sent twice; each event comes out once."""
    root = scratch_dir(w.spark, "stream-dedupe")
    stream = _event_stream(w)
    events = J.sensor_stream(stream.unionByName(_event_stream(w)), dedupe=True)
    narrow = events.select("event_id", "equipment_id", "timestamp")
    J.drain(J.append_query(narrow, f"{root}/events", f"{root}/checkpoint", J.DRAIN))
    return portable(w.spark.read.parquet(f"{root}/events").drop("batch_id"))


# Messages of a file that a query's feed sends, about 50 MB of text, and the micro-batches that a
# feed is dealt over: each looks up ids in what is stored by then, so their number is not to grow
# with the input.
FILE_MESSAGES = 100_000
FEED_BATCHES = 4
# Files to a micro-batch of the feed in order of time, two million messages.
ORDERED_FILES = 20
# The same where four queries run at once and windows are kept in memory, 350 bytes each and five
# to a message: about a gigabyte on all executors.
JOB_FILES = 5


def _spread_feed(w, path: str) -> DataFrame:
    """A stream of the message files under a path, four to a micro-batch or as many as leave
    ``FEED_BATCHES``."""
    files = -(-folders.file_count(w.spark, path) // FEED_BATCHES)
    return file_stream(w.spark, path, max_files_per_trigger=max(4, files))


def _split_feed(w, root: str, parts: int) -> Callable[..., DataFrame]:
    """The events as message files of ``parts`` slices by id; sending a slice adds its files, which
    are a micro-batch of their own unless those of ``sent`` slices go into one."""
    messages = D.encode(w.events(), key="event_id")
    slice_of = F.pmod(F.xxhash64("key"), F.lit(parts))
    messages.withColumn("slice", slice_of).write.partitionBy("slice").parquet(f"{root}/sent")
    rows_sent = w.spark.read.parquet(f"{root}/sent").count()
    files = max(1, -(-rows_sent // (parts * FILE_MESSAGES)))

    def send(*slices: int, sent: int = 1) -> DataFrame:
        for i in slices:
            rows = w.spark.read.schema(RAW_MESSAGE).parquet(f"{root}/sent/slice={i}")
            # By a hash: dealing rows in turn sorts them first.
            rows.repartition(files, "key", "timestamp").write.mode("append").parquet(f"{root}/in")
        return file_stream(w.spark, f"{root}/in", max_files_per_trigger=sent * files)

    return send


@_query
def stream_live_deduped(w):
    """Events sent again: in the same and in a later micro-batch, after a restart, and all once
    more to a query begun anew without the first one's state. Each is stored once."""
    root = scratch_dir(w.spark, "stream-deduped")
    send = _split_feed(w, root, 3)

    def run(stream, checkpoint):
        with J.settings(w.spark, J.drain_conf(w.spark)):
            started = (
                J.live_query(stream, root, f"{root}/{checkpoint}/live", J.DRAIN),
                J.archive_query(stream, f"{root}/archive", f"{root}/{checkpoint}/archive", J.DRAIN),
            )
        J.drain(*started)

    run(send(0, 1), "c")
    run(send(1, 2), "c")
    run(send(sent=4), "begun-anew")
    outputs = {
        "readings": T.read_dated(w.spark, f"{root}/readings", SENSOR_READINGS, "recorded_at"),
        "alerts": T.read_dated(w.spark, f"{root}/alerts", ALERTS, "triggered_at"),
        "archive": T.read_archive(w.spark, f"{root}/archive", _january(1), _january(31)),
    }
    found = None
    for name, rows in outputs.items():
        key = "alert_id" if name == "alerts" else "event_id"
        part = rows.select(F.lit(name).alias("output"), F.col(key).alias("id"), "equipment_id")
        found = part if found is None else found.unionByName(part)
    return found


def _store_all_alerts(w) -> str:
    """Flag alerts and device alerts through the stream, service alerts through the job."""
    root = scratch_dir(w.spark, "all-alerts")
    # In order of time a batch looks up ids in few days that others wrote.
    files = max(FEED_BATCHES, _files(w))
    fed = _Fed(w, _ordered_events(w, files), -(-files // FEED_BATCHES))
    stream = D.encode(fed.events()).unionByName(_alert_messages(fed))
    with J.settings(w.spark, J.drain_conf(w.spark)):
        live = J.live_query(stream, root, f"{root}/checkpoint", J.DRAIN)
    J.drain(live)
    run_maintenance(
        w.readings(), w.equipment(), w.sites(), f"{root}/alerts", f"{root}/logs", WH.AS_OF
    )
    return root


@_query
def alerts_all_producers(w):
    """Alerts of all three producers in one table, as the open list and as the KPI counts them."""
    root = _store_all_alerts(w)
    alerts = T.read_dated(w.spark, f"{root}/alerts", ALERTS, "triggered_at")
    listed = A.open_alerts(alerts, w.sites(), WH.AS_OF).select(
        F.lit("open").alias("part"), "equipment_id", F.col("alert_id").alias("item"), "severity",
        F.lit(1).cast("bigint").alias("alerts"),
    )
    counted = K.daily_kpi(w.readings(), w.equipment(), alerts, WH.KPI_DAY)
    kpi = counted.select(
        F.lit("kpi").alias("part"), "equipment_id", F.lit(WH.KPI_DAY).alias("item"),
        F.col("critical_alert_count").cast("string").alias("severity"),
        F.col("alert_count").cast("bigint").alias("alerts"),
    )
    return listed.unionByName(kpi)


@_query
def resolve_written(w):
    """Critical alerts of three days closed in the stored table, the same ones named twice."""
    root = scratch_dir(w.spark, "resolved")
    D.encode(w.events()).write.parquet(f"{root}/in")
    stream = _spread_feed(w, f"{root}/in")
    J.drain(J.live_query(stream, root, f"{root}/checkpoint", J.DRAIN))
    stored = T.read_dated(w.spark, f"{root}/alerts", ALERTS, "triggered_at")
    grave = stored.where((F.col("severity") == "CRITICAL") & (F.dayofmonth("triggered_at") <= 3))
    ids = saved(w.spark, grave.select("alert_id", "triggered_at"), "resolve-ids")
    for moment in ("2024-01-30 00:00:00", WH.AS_OF):
        resolve_stored(w.spark, f"{root}/alerts", ids, moment)
    now = T.read_dated(w.spark, f"{root}/alerts", ALERTS, "triggered_at")
    return portable(now.select("alert_id", "severity", "triggered_at", "resolved_at"))


@_query
def ingest_stats_standing(w):
    """The header figures from totals, last day folders and the standing table, after a batch was
    written again and alerts were closed; as ``ingest_stats`` would count them."""
    root = scratch_dir(w.spark, "standing-totals")
    send = _split_feed(w, root, 3)
    for slices in ((0, 1), (2, 1)):
        stream = send(*slices)
        with J.settings(w.spark, J.drain_conf(w.spark)):
            started = (
                J.live_query(stream, root, f"{root}/live", J.DRAIN),
                J.latest_query(stream, f"{root}/latest", f"{root}/newest", J.DRAIN),
            )
        J.drain(*started)
        TO.fold(w.spark, root)
    stored = T.read_dated(w.spark, f"{root}/alerts", ALERTS, "triggered_at")
    first = stored.where(F.dayofmonth("triggered_at") <= 3).select("alert_id", "triggered_at")
    resolve_stored(w.spark, f"{root}/alerts", saved(w.spark, first, "resolve-ids"), WH.AS_OF)
    newest = J.current_latest(w.spark, f"{root}/latest")
    return portable(TO.ingest_stats_standing(w.spark, root, newest, w.equipment(), WH.AS_OF))


def _run_with_late_rows(w) -> str:
    """The events in three parts by time, every seventh one a part later than its time; stored by
    the live query, a part to a batch, and counted by the window query behind it."""
    root = scratch_dir(w.spark, "late-rows")
    third = F.least(F.floor((F.dayofmonth("timestamp") - 1) / 10), F.lit(2))
    sent_in = F.when(F.col("event_id").cast("long") % 7 == 0, F.least(third + 1, F.lit(2)))
    placed = w.events().withColumn("part", F.coalesce(sent_in, third))
    held = saved(w.spark, placed, "late-events")
    for n in range(3):
        # A run without a limit takes all files of the part in one batch, however many they are.
        D.encode(held.where(F.col("part") == n)).write.mode("append").parquet(f"{root}/in")
        stream = file_stream(w.spark, f"{root}/in")
        with J.settings(w.spark, J.drain_conf(w.spark)):
            live = J.live_query(stream, root, f"{root}/live", J.DRAIN, split_late=True)
        J.drain(live)
    with J.settings(w.spark, J.drain_conf(w.spark)):
        windows = J.split_window_query(w.spark, root, f"{root}/split", J.DRAIN)
    J.drain(windows)
    return root


@_query
def stream_late_rows(w):
    """What came behind the watermark, from the side table."""
    late = LA.late_events(w.spark, _run_with_late_rows(w))
    return portable(late.select("event_id", "equipment_id", "timestamp", "has_anomaly"))


@_query
def stream_corrected_stats(w):
    """Windows of the stream with the late rows added; the same as of the whole table at once."""
    return portable(LA.corrected_windows(w.spark, _run_with_late_rows(w)))


@_query
def stream_progress(w):
    """Batches and rows of the whole job's queries from their progress log."""
    root = scratch_dir(w.spark, "stream-progress")
    log = ProgressLog(w.spark, f"{root}/progress")
    w.spark.streams.addListener(log)
    try:
        _run_whole_job(w, root, 2)
        log.settle()
    finally:
        w.spark.streams.removeListener(log)
    counted = totals_by_query(log.read())
    return counted.select("query", "input_rows", "accepted", "refused")


@_query
def compacted_round_trip(w):
    """Readings and alerts of all days, written in several batches and merged in between; a third
    of them is sent again after it was merged. Some days wait to be put in place, others are."""
    root = scratch_dir(w.spark, "compacted")
    send = _split_feed(w, root, 3)
    for slices in ((0, 1), (2, 0)):
        stream = send(*slices)
        with J.settings(w.spark, J.drain_conf(w.spark)):
            live = J.live_query(stream, root, f"{root}/live", J.DRAIN)
        J.drain(live)
        run_compaction(w.spark, root, "2024-01-31 12:00:00", grace=-1.0)
    readings = T.read_dated(w.spark, f"{root}/readings", SENSOR_READINGS, "recorded_at")
    alerts = T.read_dated(w.spark, f"{root}/alerts", ALERTS, "triggered_at")
    return readings.select(
        F.lit("readings").alias("output"), F.col("event_id").alias("id"), "equipment_id"
    ).unionByName(alerts.select(F.lit("alerts").alias("output"), F.col("alert_id").alias("id"), "equipment_id"))


@_query
def stream_site_lookup(w):
    root = scratch_dir(w.spark, "stream-sites")
    placed = E.with_site(J.sensor_stream(_event_stream(w)), w.sites())
    narrow = placed.select("event_id", "site_id", "site_name", "state")
    J.drain(J.append_query(narrow, f"{root}/events", f"{root}/checkpoint", J.DRAIN))
    return w.spark.read.parquet(f"{root}/events").drop("batch_id")


@_query
def stream_all_tables(w):
    """The whole job on the event stream; rows per output table and machine."""
    root = scratch_dir(w.spark, "stream-all")
    _run_whole_job(w, root)
    spark = w.spark
    outputs = {
        "readings": T.read_dated(spark, f"{root}/readings", SENSOR_READINGS, "recorded_at"),
        "alerts": T.read_dated(spark, f"{root}/alerts", ALERTS, "triggered_at"),
        "archive": T.read_archive(spark, f"{root}/archive", _january(1), _january(31)),
        "windows": J.current_windows(spark, f"{root}/windows"),
    }
    counts = None
    for name, rows in outputs.items():
        part = rows.groupBy("equipment_id").agg(F.count("*").alias("rows"))
        part = part.withColumn("output", F.lit(name))
        counts = part if counts is None else counts.unionByName(part)
    return counts
