"""JSON messages to typed rows and back, with bad records set aside."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigpulse.schemas import (
    ALERT_EVENT,
    ALERT_REQUIRED,
    ALERTS,
    DOMAINS,
    MAX_LENGTHS,
    SENSOR_EVENT,
    SENSOR_READINGS,
    SENSOR_REQUIRED,
    TOPIC_ALERTS,
    TOPIC_SENSOR,
)

_CORRUPT = "_corrupt"
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _parsed(schema: T.StructType) -> Column:
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json(F.col("value").cast("string"), wide, options)


@dataclass(frozen=True)
class Kind:
    """The messages of one topic and the table their rows go to."""

    topic: str
    schema: T.StructType
    required: tuple[str, ...]
    stored: T.StructType
    table: str
    key: str


SENSORS = Kind(
    TOPIC_SENSOR, SENSOR_EVENT, SENSOR_REQUIRED, SENSOR_READINGS, "sensor_readings", "event_id"
)
DEVICE_ALERTS = Kind(TOPIC_ALERTS, ALERT_EVENT, ALERT_REQUIRED, ALERTS, "alerts", "alert_id")

At = Callable[[str], Column]


def out_of_range(schema: T.StructType, stored: T.StructType, at: At = F.col) -> Column:
    """Whether a number is not finite or does not fit the decimal it is to be stored in."""
    bad = F.lit(False)
    numbers = {f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)}
    for f in stored.fields:
        if f.name in numbers and isinstance(f.dataType, T.DecimalType):
            digits, scale = f.dataType.precision - f.dataType.scale, f.dataType.scale
            # Half a unit of the last place below the bound, where rounding would reach it. NaN
            # counts as larger than every number.
            limit = float(10**digits) - 0.5 * 10.0**-scale
            bad = bad | F.coalesce(F.abs(at(f.name)) >= limit, F.lit(False))
    return bad


def too_long(table: str, schema: T.StructType, at: At = F.col) -> Column:
    """Whether a text is longer than its stored column."""
    bad = F.lit(False)
    for name, longest in MAX_LENGTHS.get(table, {}).items():
        if name in schema.fieldNames():
            bad = bad | F.coalesce(F.char_length(at(name)) > longest, F.lit(False))
    return bad


def unknown_value(table: str, schema: T.StructType, at: At = F.col) -> Column:
    """Whether an enumerated column has a value outside its domain; null is none."""
    bad = F.lit(False)
    for name, values in DOMAINS.get(table, {}).items():
        if name in schema.fieldNames():
            bad = bad | F.coalesce(~at(name).isin(*values), F.lit(False))
    return bad


def _problem(
    required: Sequence[str], schema: T.StructType, stored: T.StructType, table: str | None,
    at: At = F.col,
) -> Column:
    """Why a record is refused, null for a good one."""
    missing = F.lit(False)
    for name in required:
        missing = missing | at(name).isNull()
    empty = F.coalesce(F.trim(F.col("_value").cast("string")), F.lit("")) == ""
    unreadable = at(_CORRUPT).isNotNull() | empty
    reason = (
        F.when(unreadable, F.lit("malformed"))
        .when(missing, F.lit("missing_field"))
        .when(out_of_range(schema, stored, at), F.lit("out_of_range"))
    )
    if table is None:
        return reason
    return reason.when(too_long(table, schema, at), F.lit("too_long")).when(
        unknown_value(table, schema, at), F.lit("unknown_value")
    )


def parse(
    messages: DataFrame,
    schema: T.StructType = SENSOR_EVENT,
    required: Sequence[str] = SENSOR_REQUIRED,
    stored: T.StructType = SENSOR_READINGS,
    table: str | None = "sensor_readings",
) -> DataFrame:
    """Typed columns, the raw message (underscored) and the problem, if any.

    The parsed record leaves a generator, not a projection: Spark would copy a projected
    from_json into each later use of a field, filters included, and parse the text many times.
    """
    rows = messages.select(
        F.col("key").alias("_key"),
        F.col("value").alias("_value"),
        F.col("topic").alias("_topic"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(_parsed(schema))),
    )
    problem = _problem(required, schema, stored, table)
    return rows.withColumn("problem", problem).drop(_CORRUPT)


def parse_topics(messages: DataFrame, kinds: Sequence[Kind] = (SENSORS, DEVICE_ALERTS)) -> DataFrame:
    """Messages of several topics in one pass: a typed struct per kind (``as_0``, ``as_1``, ...),
    null for messages of another topic, the problem, if any, and the key of good records.

    Each text is parsed once, by the schema of its topic. Messages of no known topic are refused.
    """
    records = [
        F.when(F.col("topic") == k.topic, _parsed(k.schema)).alias(f"as_{i}")
        for i, k in enumerate(kinds)
    ]
    rows = messages.select(
        F.col("key").alias("_key"),
        F.col("value").alias("_value"),
        F.col("topic").alias("_topic"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(F.struct(*records))),
    )
    problem, key = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
    known = F.lit(False)
    for i, k in enumerate(kinds):
        at = lambda name, i=i: F.col(f"as_{i}")[name]
        mine = F.col("_topic") == k.topic
        problem = problem.when(mine, _problem(k.required, k.schema, k.stored, k.table, at))
        key = key.when(mine, at(k.key))
        known = known | mine
    problem = F.when(F.coalesce(known, F.lit(False)), problem).otherwise(F.lit("unknown_topic"))
    return rows.withColumn("problem", problem).withColumn("_id", key)


def of_kind(parsed: DataFrame, number: int, kind: Kind) -> DataFrame:
    """Good records of one kind, typed; broker and arrival time are kept."""
    extra = [c for c in ("kafka_timestamp", "_arrived") if c in parsed.columns]
    good = parsed.where((F.col("_topic") == kind.topic) & F.col("problem").isNull())
    typed = [F.col(f"as_{number}")[n].alias(n) for n in kind.schema.fieldNames()]
    return good.select(*typed, *extra)

def valid(parsed: DataFrame, schema: T.StructType = SENSOR_EVENT) -> DataFrame:
    """Typed columns of the good records, broker time kept as kafka_timestamp."""
    good = parsed.where(F.col("problem").isNull())
    return good.select(*schema.fieldNames(), "kafka_timestamp")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Refused records with their whole text and the reason."""
    return parsed.where(F.col("problem").isNotNull()).select(
        F.col("_key").alias("key"),
        F.col("_value").cast("string").alias("value"),
        F.col("_topic").alias("topic"),
        F.col("kafka_timestamp").alias("timestamp"),
        "problem",
    )


def decode(messages: DataFrame) -> DataFrame:
    """Good sensor events of a message frame, batch or stream."""
    return valid(parse(messages))


def route(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sensor events and alert events of a frame that mixes both topics."""
    sensors = decode(messages.where(F.col("topic") == TOPIC_SENSOR))
    alerts = messages.where(F.col("topic") == TOPIC_ALERTS)
    return sensors, valid(
        parse(alerts, ALERT_EVENT, ALERT_REQUIRED, ALERTS, "alerts"), ALERT_EVENT
    )


def encode(
    events: DataFrame,
    *,
    topic: str = TOPIC_SENSOR,
    key: str = "equipment_id",
    schema: T.StructType = SENSOR_EVENT,
) -> DataFrame:
    """Typed rows to keyed JSON messages with ISO-8601 times; null fields are written out."""
    options = {"timestampFormat": TIME_FORMAT, "ignoreNullFields": "false"}
    body = F.to_json(F.struct(*schema.fieldNames()), options)
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.encode(body, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("timestamp"),
    )
