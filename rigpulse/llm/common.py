"""Helpers that several operators share: tables, scratch tables, spans, batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rigpulse.session import scratch_dir

# Python work is done on slices of at most this many bytes of text, so that a worker's memory
# does not follow the batch. A longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

SPAN = "array<struct<start:int,end:int,hit:string>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends at files every executor can reach."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps, which Spark keeps until the driver's garbage
    is collected; without it a query of many steps holds those of all on disk."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about SLICE_BYTES of text each."""
    at = size = 0
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for i, n in enumerate(sizes):
        if i > at and size + n > SLICE_BYTES:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if at < batch.num_rows:
        yield batch.slice(at)


def sliced(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text"):
    """A mapInArrow function that applies ``work`` to each slice. What Arrow holds in reserve goes
    back after every batch, since a worker serves many stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column):
                if (out := work(part)) is not None and out.num_rows:
                    yield out
            pa.default_memory_pool().release_unused()

    return run


def spans(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost, non-overlapping matches as array<struct<start, end, hit>>, in code points.

    Native: the pieces between matches give the positions. ``keep`` drops failing matches, which
    are not tried again. Java's engine recurses for groups under a greedy quantifier, so patterns
    for long texts use possessive ones. Null text: null.
    """
    keep = keep or (lambda hit: F.lit(True))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    pairs = F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    pairs = F.filter(pairs, lambda p: p["h"].isNotNull())

    def step(state: Column, p: Column) -> Column:
        start = state["pos"] + p["g"]
        end = start + F.char_length(p["h"])
        one = F.struct(start.alias("start"), end.alias("end"), p["h"].alias("hit"))
        return F.struct(
            end.alias("pos"),
            F.when(keep(p["h"]), F.concat(state["found"], F.array(one))).otherwise(
                state["found"]
            ).cast(SPAN).alias("found"),
        )

    first = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("found"))
    found = F.aggregate(pairs, first, step, lambda s: s["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def joined_spans(found: Column) -> Column:
    """'kind:start:end' of an array of structs with these fields, comma-joined."""
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def of_kind(found: Column, kind: str, order: int) -> Column:
    """The spans with their kind and its place in the list of kinds."""
    return F.transform(
        found,
        lambda s: F.struct(
            F.lit(order).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a non-empty string of digits passes the Luhn check."""
    summed = F.aggregate(
        F.sequence(F.lit(1), F.char_length(number)),
        F.lit(0),
        lambda acc, i: acc + _luhn_digit(number, i),
    )
    return summed % 10 == 0


def _luhn_digit(number: Column, i: Column) -> Column:
    """What the i-th digit from the right adds."""
    d = F.substring(number, F.char_length(number) - i + 1, F.lit(1)).cast("int")
    twice = d * 2
    return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)
