"""Fleet tables laid over the star-schema test tables (mapping in FIXTURES.md, section 4).

Each method returns a lazy frame, so a query scans only the tables and columns it uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigpulse.functions.text import hash_id
from rigpulse.operators.alerts import limit_alerts
from rigpulse.operators.enrich import enrich
from rigpulse.operators.kpi import daily_kpi_range
from rigpulse.session import configure
from rigpulse.sources.decode import encode

# The moment the queries take for "now", the first and last day of readings, the KPI day.
AS_OF = "2024-01-31 00:00:00"
FIRST_DAY = "2024-01-01"
LAST_DAY = "2024-01-30"
KPI_DAY = "2024-01-10"


# Schemas already read from the files of these read-only tables, by path.
_SCHEMAS: dict[str, T.StructType] = {}


def _zoned(schema: T.StructType) -> T.StructType:
    """Times without zone read as instants of the session zone, UTC. A cast of the column would
    do the same but keep time filters away from the scan."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType())
            if isinstance(f.dataType, T.TimestampNTZType)
            else f
            for f in schema.fields
        ]
    )


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = _zoned(self.spark.read.parquet(path).schema)
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def readings(self) -> DataFrame:
        """Sensor readings as doubles, one row per event."""
        return readings_from_events(self.table("events"))

    def equipment(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "CAST(c_custkey AS STRING) AS equipment_id",
            "CAST(c_nationkey AS STRING) AS site_id",
            """CASE c_custkey % 3 WHEN 0 THEN 'haul_truck' WHEN 1 THEN 'drill_rig'
               ELSE 'excavator' END AS equipment_type""",
            "c_mktsegment AS model",
            "IF(c_custkey % 3 = 0, 250.0D, 500.0D) AS service_interval_hrs",
            "c_custkey % 10 <> 9 AS active",
        )

    def sites(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("string").alias("site_id"),
            F.col("n_name").alias("site_name"),
            F.col("r_name").alias("state"),
        )

    def events(self) -> DataFrame:
        """Sensor events in message form: readings with machine type and site."""
        return events_from_readings(self.readings(), self.equipment())

    def enriched(self) -> DataFrame:
        return enrich(self.events())

    def messages(self) -> DataFrame:
        """The same events as keyed JSON."""
        return encode(self.events())

    def unplaced_alerts(self) -> DataFrame:
        """Limit alerts of all readings without the site, for counts that need no site."""
        return limit_alerts(self.readings())

    def alerts(self) -> DataFrame:
        """The same alerts with site; every fourth event's alerts were resolved after two hours."""
        placed = self.unplaced_alerts().join(
            self.equipment().select("equipment_id", "site_id"), "equipment_id"
        )
        closed = F.col("event_id").cast("long") % 4 == 0
        return placed.withColumn(
            "resolved_at", F.when(closed, F.col("triggered_at") + F.expr("INTERVAL 2 HOURS"))
        )

    def daily_kpi(self) -> DataFrame:
        """KPI rows of every day with readings."""
        return daily_kpi_range(
            self.readings(), self.equipment(), self.unplaced_alerts(), FIRST_DAY, LAST_DAY
        )

    def maintenance_logs(self, keep: Sequence[str] = ()) -> DataFrame:
        """Service log: orders spread over the thirty days that end on the day of AS_OF."""
        return self.table("orders").select(
            *keep,
            hash_id(F.lit("log"), "o_orderkey").alias("log_id"),
            F.col("o_custkey").cast("string").alias("equipment_id"),
            F.date_sub(F.to_date(F.lit(AS_OF)), (F.col("o_orderkey") % 30).cast("int")).alias(
                "service_date"
            ),
            F.col("o_orderpriority").alias("service_type"),
            F.col("o_totalprice").alias("cost_aud"),
        )


def readings_from_events(events: DataFrame) -> DataFrame:
    parsed = events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "ts AS recorded_at",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS k",
    )
    return parsed.selectExpr(
        "CAST(event_id AS STRING) AS event_id",
        "CAST(user_id AS STRING) AS equipment_id",
        "recorded_at",
        "80 + 0.2D * value AS engine_temp_c",
        "1200 + value AS engine_rpm",
        "420 - 1.5D * value AS oil_pressure_kpa",
        "3.5D + 0.06D * value AS vibration_mm_s",
        "k AS fuel_level_pct",
        "40 + 0.9D * k AS fuel_burn_rate",
        "IF(user_id % 3 = 0, 180 + 0.2D * value, NULL) AS payload_tonnes",
        "IF(user_id % 3 = 1, 90 + 0.5D * value, NULL) AS drill_rpm",
        "IF(user_id % 3 = 2, 300 + value, NULL) AS dig_force_kn",
        "0.5D * k AS speed_kmh",
        "-22.3D + 0.001D * k AS latitude",
        "118.5D + 0.001D * k AS longitude",
        """CASE event_type WHEN 'view' THEN 'operating' WHEN 'click' THEN 'operating'
           WHEN 'signup' THEN 'idle' WHEN 'purchase' THEN 'maintenance'
           WHEN 'error' THEN 'fault' END AS status""",
        "CAST((event_id * 7 + user_id) % 600 AS DOUBLE) AS hours_since_service",
        "IF(event_type = 'error', CONCAT('F', 100 + user_id % 900), NULL) AS fault_code",
    )


def events_from_readings(readings: DataFrame, equipment: DataFrame) -> DataFrame:
    """Message columns from readings and their machines; works on a stream of readings too."""
    machines = equipment.select("equipment_id", "equipment_type", "site_id")
    return (
        readings.withColumnRenamed("recorded_at", "timestamp")
        .join(machines, "equipment_id")
        .withColumn("kafka_timestamp", F.col("timestamp"))
    )
