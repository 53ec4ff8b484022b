"""Row shapes of the stream and of the stored tables, and the allowed values of their columns."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, REAL, FLAG = T.StringType(), T.DoubleType(), T.BooleanType()
TIME, DAY = T.TimestampType(), T.DateType()
COUNT, LONG = T.IntegerType(), T.LongType()
TEXTS = T.ArrayType(TEXT)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Decoded sensor message. Nullability is not enforced by from_json, so the required
# columns are listed separately and checked by the decoder.
SENSOR_EVENT = _struct(
    ("event_id", TEXT),
    ("equipment_id", TEXT),
    ("equipment_type", TEXT),
    ("site_id", TEXT),
    ("timestamp", TIME),
    ("engine_temp_c", REAL),
    ("engine_rpm", REAL),
    ("oil_pressure_kpa", REAL),
    ("vibration_mm_s", REAL),
    ("fuel_level_pct", REAL),
    ("fuel_burn_rate", REAL),
    ("payload_tonnes", REAL),
    ("drill_rpm", REAL),
    ("dig_force_kn", REAL),
    ("latitude", REAL),
    ("longitude", REAL),
    ("speed_kmh", REAL),
    ("status", TEXT),
    ("hours_since_service", REAL),
    ("fault_code", TEXT),
)
SENSOR_REQUIRED = ("event_id", "equipment_id", "equipment_type", "site_id", "timestamp")

# Decoded, flagged event, and the same with the partition columns of the archive.
ENRICHED_EVENT = _struct(
    *[(f.name, f.dataType) for f in SENSOR_EVENT.fields],
    ("kafka_timestamp", TIME),
    ("anomaly_flags", TEXTS),
    ("has_anomaly", FLAG),
    ("is_critical", FLAG),
)
DAY_PARTITION = "on_day"
ARCHIVE_PARTITIONS = ("site_id", "year", "month", "day", "batch_id")
ARCHIVED_EVENT = _struct(
    *[(f.name, f.dataType) for f in ENRICHED_EVENT.fields],
    ("year", COUNT),
    ("month", COUNT),
    ("day", COUNT),
    ("batch_id", LONG),
)

ALERT_EVENT = _struct(
    ("alert_id", TEXT),
    ("equipment_id", TEXT),
    ("site_id", TEXT),
    ("timestamp", TIME),
    ("alert_type", TEXT),
    ("severity", TEXT),
    ("metric", TEXT),
    ("value", REAL),
    ("threshold", REAL),
    ("message", TEXT),
)
ALERT_REQUIRED = tuple(ALERT_EVENT.fieldNames())

STATUS_EVENT = _struct(
    ("equipment_id", TEXT),
    ("site_id", TEXT),
    ("status", TEXT),
    ("timestamp", TIME),
)

# Stored tables. Identifiers are strings, measures decimals of fixed scale.
SITES = _struct(
    ("site_id", TEXT),
    ("site_name", TEXT),
    ("state", TEXT),
    ("latitude", T.DecimalType(9, 6)),
    ("longitude", T.DecimalType(9, 6)),
    ("timezone", TEXT),
    ("active", FLAG),
    ("created_at", TIME),
)

EQUIPMENT = _struct(
    ("equipment_id", TEXT),
    ("site_id", TEXT),
    ("equipment_type", TEXT),
    ("model", TEXT),
    ("manufacturer", TEXT),
    ("serial_number", TEXT),
    ("commissioned_date", DAY),
    ("service_interval_hrs", T.DecimalType(8, 2)),
    ("active", FLAG),
    ("created_at", TIME),
    ("updated_at", TIME),
)

SENSOR_READINGS = _struct(
    ("event_id", TEXT),
    ("equipment_id", TEXT),
    ("recorded_at", TIME),
    ("engine_temp_c", T.DecimalType(6, 2)),
    ("engine_rpm", T.DecimalType(8, 1)),
    ("oil_pressure_kpa", T.DecimalType(8, 1)),
    ("vibration_mm_s", T.DecimalType(8, 3)),
    ("fuel_level_pct", T.DecimalType(5, 2)),
    ("fuel_burn_rate", T.DecimalType(8, 2)),
    ("payload_tonnes", T.DecimalType(8, 1)),
    ("drill_rpm", T.DecimalType(8, 1)),
    ("dig_force_kn", T.DecimalType(8, 1)),
    ("speed_kmh", T.DecimalType(6, 1)),
    ("latitude", T.DecimalType(9, 6)),
    ("longitude", T.DecimalType(9, 6)),
    ("status", TEXT),
    ("hours_since_service", T.DecimalType(10, 2)),
    ("fault_code", TEXT),
)

ALERTS = _struct(
    ("alert_id", TEXT),
    ("equipment_id", TEXT),
    ("site_id", TEXT),
    ("triggered_at", TIME),
    ("alert_type", TEXT),
    ("severity", TEXT),
    ("metric", TEXT),
    ("value", T.DecimalType(12, 3)),
    ("threshold", T.DecimalType(12, 3)),
    ("message", TEXT),
    ("resolved_at", TIME),
    ("acknowledged", FLAG),
    ("acknowledged_by", TEXT),
    ("notes", TEXT),
)

MAINTENANCE_LOGS = _struct(
    ("log_id", TEXT),
    ("equipment_id", TEXT),
    ("service_date", DAY),
    ("service_type", TEXT),
    ("technician", TEXT),
    ("cost_aud", T.DecimalType(10, 2)),
    ("hours_at_service", T.DecimalType(10, 2)),
    ("next_service_due", T.DecimalType(10, 2)),
    ("parts_replaced", TEXTS),
    ("notes", TEXT),
    ("created_at", TIME),
)

DAILY_KPI = _struct(
    ("equipment_id", TEXT),
    ("site_id", TEXT),
    ("kpi_date", DAY),
    ("avg_engine_temp_c", T.DecimalType(6, 2)),
    ("max_engine_temp_c", T.DecimalType(6, 2)),
    ("avg_vibration_mm_s", T.DecimalType(8, 3)),
    ("max_vibration_mm_s", T.DecimalType(8, 3)),
    ("total_fuel_litres", T.DecimalType(10, 2)),
    ("operating_hours", T.DecimalType(6, 2)),
    ("idle_hours", T.DecimalType(6, 2)),
    ("fault_hours", T.DecimalType(6, 2)),
    ("uptime_pct", T.DecimalType(5, 2)),
    ("alert_count", COUNT),
    ("critical_alert_count", COUNT),
    ("total_payload_tonnes", T.DecimalType(12, 2)),
    ("avg_drill_rpm", T.DecimalType(8, 1)),
)

WINDOW_STATS = _struct(
    ("equipment_id", TEXT),
    ("site_id", TEXT),
    ("equipment_type", TEXT),
    ("avg_engine_temp", REAL),
    ("max_engine_temp", REAL),
    ("avg_vibration", REAL),
    ("max_vibration", REAL),
    ("avg_fuel_level", REAL),
    ("min_fuel_level", REAL),
    ("avg_oil_pressure", REAL),
    ("avg_rpm", REAL),
    ("avg_speed", REAL),
    ("total_fuel_burn", REAL),
    ("reading_count", LONG),
    ("anomaly_count", LONG),
    ("window_start", TIME),
    ("window_end", TIME),
)

# The domains of the enumerated columns, in their sort order.
EQUIPMENT_TYPES = ("haul_truck", "drill_rig", "excavator")
STATUSES = ("operating", "idle", "maintenance", "fault")
SEVERITIES = ("WARNING", "CRITICAL")
SERVICE_TYPES = ("routine", "corrective", "preventive", "emergency")

# Topic names and column defaults.
TOPIC_SENSOR = "sensor-events"
TOPIC_ALERTS = "equipment-alerts"
TOPIC_STATUS = "equipment-status"

SITE_DEFAULTS = {"timezone": "Australia/Perth", "active": True}
EQUIPMENT_DEFAULTS = {"service_interval_hrs": 250, "active": True}
LOG_DEFAULTS = {"service_type": "routine"}
ALERT_DEFAULTS = {"acknowledged": False}

# Longest text each stored column accepts.
MAX_LENGTHS = {
    "sites": {"site_id": 30, "site_name": 100, "state": 3, "timezone": 50},
    "equipment": {
        "equipment_id": 20,
        "site_id": 30,
        "model": 100,
        "manufacturer": 100,
        "serial_number": 50,
    },
    "sensor_readings": {"equipment_id": 20, "fault_code": 20},
    "alerts": {
        "equipment_id": 20,
        "site_id": 30,
        "alert_type": 50,
        "metric": 50,
        "acknowledged_by": 100,
    },
    "maintenance_logs": {"equipment_id": 20, "technician": 100},
    "daily_kpi": {"equipment_id": 20, "site_id": 30},
}

NOT_NULL = {
    "sites": (
        "site_id",
        "site_name",
        "state",
        "latitude",
        "longitude",
        "timezone",
        "active",
        "created_at",
    ),
    "equipment": (
        "equipment_id",
        "site_id",
        "equipment_type",
        "service_interval_hrs",
        "active",
        "created_at",
        "updated_at",
    ),
    "sensor_readings": ("equipment_id", "recorded_at"),
    "alerts": (
        "alert_id",
        "equipment_id",
        "site_id",
        "triggered_at",
        "alert_type",
        "severity",
        "metric",
        "value",
        "threshold",
        "message",
        "acknowledged",
    ),
    "maintenance_logs": ("equipment_id", "service_date", "service_type", "created_at"),
    "daily_kpi": ("equipment_id", "site_id", "kpi_date"),
}

DOMAINS = {
    "equipment": {"equipment_type": EQUIPMENT_TYPES},
    "sensor_readings": {"status": STATUSES},
    "alerts": {"severity": SEVERITIES},
    "maintenance_logs": {"service_type": SERVICE_TYPES},
}

# Shapes the read queries return.
LATEST_COLUMNS = (
    "equipment_id",
    "equipment_type",
    "model",
    "site_id",
    "recorded_at",
    "engine_temp_c",
    "engine_rpm",
    "oil_pressure_kpa",
    "vibration_mm_s",
    "fuel_level_pct",
    "speed_kmh",
    "status",
    "fault_code",
    "hours_since_service",
)
HISTORY_COLUMNS = (
    "recorded_at",
    "engine_temp_c",
    "vibration_mm_s",
    "fuel_level_pct",
    "oil_pressure_kpa",
    "engine_rpm",
    "status",
)
