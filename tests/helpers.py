"""Small frames for edge-case tests."""

from datetime import datetime

from pyspark.sql import functions as F

from rigpulse.schemas import SENSOR_EVENT

BASE = dict(
    event_id="e1",
    equipment_id="m1",
    equipment_type="haul_truck",
    site_id="s1",
    timestamp=datetime(2025, 1, 1, 0, 0, 0),
    engine_temp_c=90.0,
    engine_rpm=1500.0,
    oil_pressure_kpa=300.0,
    vibration_mm_s=3.0,
    fuel_level_pct=60.0,
    fuel_burn_rate=100.0,
    payload_tonnes=None,
    drill_rpm=None,
    dig_force_kn=None,
    latitude=-22.3,
    longitude=118.5,
    speed_kmh=20.0,
    status="operating",
    hours_since_service=10.0,
    fault_code=None,
)


def events(spark, *changes):
    """One event per dict of changes; ids are numbered unless given."""
    rows = []
    for i, change in enumerate(changes):
        row = {**BASE, "event_id": f"e{i:04d}", **change}
        rows.append(tuple(row[name] for name in SENSOR_EVENT.fieldNames()))
    return spark.createDataFrame(rows, SENSOR_EVENT).withColumn(
        "kafka_timestamp", F.col("timestamp")
    )


def readings(spark, *changes):
    return events(spark, *changes).drop("kafka_timestamp").withColumnRenamed(
        "timestamp", "recorded_at"
    )


def equipment(spark, *rows):
    """(id, site, type, interval, active)"""
    return spark.createDataFrame(
        [(i, s, t, f"model-{i}", float(h), a) for i, s, t, h, a in rows],
        "equipment_id string, site_id string, equipment_type string, model string, "
        "service_interval_hrs double, active boolean",
    )


def sites(spark, *ids):
    return spark.createDataFrame(
        [(i, f"site {i}", "WA") for i in ids], "site_id string, site_name string, state string"
    )


def rows(df, *columns):
    """Rows as a list of tuples sorted as text, nulls first."""
    chosen = df.select(*columns) if columns else df
    found = [tuple(r) for r in chosen.collect()]
    return sorted(found, key=lambda row: [(v is not None, str(v)) for v in row])


def plan(df):
    """Physical plan with its scan details unabridged."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    return df._jdf.queryExecution().executedPlan().toString()
