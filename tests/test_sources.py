"""Decoding, routing, archive reads, seeds."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from rigpulse.operators.enrich import enrich
from rigpulse.schemas import EQUIPMENT, SENSOR_EVENT, SITES
from rigpulse.session import scratch_dir
from rigpulse.sinks.tables import write_archive
from rigpulse.sources import decode as D
from rigpulse.sources import tables as T
from rigpulse.sources.streams import kafka_options
from tests.helpers import events, plan, rows

GOOD = (
    '{"event_id":"e1","equipment_id":"m1","equipment_type":"haul_truck","site_id":"s1",'
    '"timestamp":"2025-01-01T00:00:00.123456+00:00","engine_temp_c":106.2,"drill_rpm":null}'
)


def messages(spark, *texts, topic="sensor-events"):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    return frame.select(
        F.lit("m1").alias("key"),
        F.encode("text", "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit("2025-01-01 00:00:01").cast("timestamp").alias("timestamp"),
    )


def test_good_message(spark):
    row = D.decode(messages(spark, GOOD)).first()
    assert row.timestamp == datetime(2025, 1, 1, 0, 0, 0, 123456)
    assert row.engine_temp_c == 106.2 and row.drill_rpm is None and row.status is None
    assert row.kafka_timestamp == datetime(2025, 1, 1, 0, 0, 1)


BAD = {
    "not json": "malformed",
    GOOD[:-1]: "malformed",
    GOOD.replace("106.2", '"hot"'): "malformed",
    GOOD.replace("2025-01-01T00", "yesterday"): "malformed",
    GOOD.replace('"m1"', "null"): "missing_field",
    GOOD.replace('"event_id":"e1",', ""): "missing_field",
    "{}": "missing_field",
    "  ": "malformed",
    "": "malformed",
}


def test_bad_messages_are_set_aside_whole(spark):
    parsed = D.parse(messages(spark, GOOD, *BAD))
    assert D.valid(parsed).count() == 1
    found = {r.value: r.problem for r in D.quarantine(parsed).collect()}
    assert found == BAD


def test_empty_value(spark):
    parsed = D.parse(messages(spark, GOOD).withColumn("value", F.lit(None).cast("binary")))
    assert D.valid(parsed).count() == 0 and D.quarantine(parsed).count() == 1


def test_text_is_parsed_once(spark):
    assert plan(D.decode(messages(spark, GOOD))).count("from_json") == 1


def test_encode_round_trip(spark):
    sent = events(spark, {"timestamp": datetime(2025, 1, 1, 23, 59, 59, 999999)}, {"status": None})
    back = D.decode(D.encode(sent))
    names = SENSOR_EVENT.fieldNames()
    assert rows(back, *names) == rows(sent, *names)


def test_routing_by_topic(spark):
    alert = (
        '{"alert_id":"a","equipment_id":"m1","site_id":"s1","timestamp":"2025-01-01T00:00:00Z",'
        '"alert_type":"LOW_FUEL","severity":"WARNING","metric":"fuel_level_pct","value":9.0,'
        '"threshold":15.0,"message":"x"}'
    )
    mixed = messages(spark, GOOD).unionByName(
        messages(spark, alert, GOOD, topic="equipment-alerts")
    )
    sensors, alerts = D.route(mixed.unionByName(messages(spark, GOOD, topic="other")))
    assert (sensors.count(), rows(alerts, "alert_id")) == (1, [("a",)])


def test_time_predicates_cover_the_range_once(spark):
    start, end = datetime(2024, 1, 1), datetime(2024, 1, 4)
    predicates = T.time_predicates("at", start, end, 5)
    moments = [start + timedelta(hours=h, microseconds=m) for h in range(-2, 75) for m in (-1, 0, 1)]
    frame = spark.createDataFrame([(m,) for m in moments], "at timestamp")
    hits = frame.select(
        "at", sum((F.expr(p).cast("int") for p in predicates), F.lit(0)).alias("n")
    ).collect()
    assert all(r.n == (1 if start <= r["at"] < end else 0) for r in hits)


def test_time_predicates_refuse_empty_ranges():
    with pytest.raises(ValueError):
        T.time_predicates("at", datetime(2024, 1, 1), datetime(2024, 1, 1), 3)


def test_archive_read_prunes_and_bounds(spark):
    times = [
        datetime(2024, 1, 31, 23, 59, 59, 999999),
        datetime(2024, 2, 1),
        datetime(2024, 2, 1, 12),
        datetime(2024, 2, 2),
        datetime(2025, 2, 1),
    ]
    changes = [{"timestamp": t, "site_id": s} for t in times for s in ("1", "02")]
    root = scratch_dir(spark, "archive-test")
    for batch in (0, 0, 1):
        write_archive(enrich(events(spark, *changes)), root, batch)
    found = T.read_archive(spark, root, datetime(2024, 2, 1), datetime(2024, 2, 2), site_id="02")
    assert rows(found, "timestamp", "site_id", "batch_id") == [
        (t, "02", batch) for t in times[1:3] for batch in (0, 1)
    ]
    pruning = plan(found).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "site_id" in pruning and "year" in pruning


def test_seeds(spark):
    made = datetime(2025, 1, 1)
    sites, machines = T.seed_sites(spark, made), T.seed_equipment(spark, made)
    assert sites.schema.fieldNames() == SITES.fieldNames() and sites.count() == 3
    assert machines.schema.fieldNames() == EQUIPMENT.fieldNames() and machines.count() == 12
    assert machines.where(~F.col("active")).count() == 0
    assert machines.join(sites, "site_id", "left_anti").count() == 0
    hours = machines.groupBy("equipment_type").agg(F.max("service_interval_hrs").cast("int"))
    assert dict(map(tuple, hours.collect())) == {
        "haul_truck": 250, "drill_rig": 500, "excavator": 500
    }


def test_defaults_fill_nulls_and_missing_columns(spark):
    frame = spark.createDataFrame([("a", None), ("b", "Perth")], "id string, zone string")
    filled = T.with_defaults(frame, {"zone": "Sydney", "active": True})
    assert rows(filled) == [("a", "Sydney", True), ("b", "Perth", True)]


def test_jdbc_reads_are_split(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, *args, **kwargs: seen.append((args, kwargs))
    )
    T.jdbc_by_time(spark, "u", "r", "at", datetime(2024, 1, 1), datetime(2024, 1, 2), 2, {"user": "x"})
    split = dict(column="id", lowerBound=0, upperBound=9, numPartitions=3)
    T.jdbc_whole(spark, "u", "e", {"user": "x"}, **split)
    assert seen == [
        (
            ("u", "r"),
            {
                "predicates": [
                    "at >= '2024-01-01 00:00:00' AND at < '2024-01-01 12:00:00'",
                    "at >= '2024-01-01 12:00:00' AND at < '2024-01-02 00:00:00'",
                ],
                "properties": {"user": "x"},
            },
        ),
        (("u", "e"), {"properties": {"user": "x"}, **split}),
    ]


def test_kafka_options():
    options = kafka_options("broker:9092", ["a", "b"], min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "minPartitions": "64",
    }
    limited = kafka_options("b", max_offsets_per_trigger=5, fail_on_data_loss=False)
    assert (limited["maxOffsetsPerTrigger"], limited["failOnDataLoss"]) == ("5", "false")
