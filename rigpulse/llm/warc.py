"""WARC archives whose records are compressed one by one against a dictionary in the file.

Each partition becomes one archive. A Zstandard dictionary is built from a bounded sample of the
partition's own records and leads the file in a skippable frame; every record follows as a frame
of its own. Spark's text writer stores the frames: each row is a frame, and the line separator is
an empty skippable frame, so that the file is a valid Zstandard stream on any store Spark writes
to, committed like every other output. Records of equal payloads of at least MIN_PAYLOAD bytes:
the smallest page_id is the response, the others are revisits that refer to it.

Null html: an empty payload. Null or repeated page ids: a record each; a null id is never the
response of others while an id exists. Null url: an empty target.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.session import scratch_dir

MIN_PAYLOAD = 100
# An archive holds about this many bytes of payload: the unit that a reading task takes whole.
ARCHIVE_BYTES = 8 << 20
# Bound of the records a file's dictionary is built from, in bytes, and its size.
SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 1 << 20, 64 << 10, 3

# Frame magics of Zstandard files (fixed values): the dictionary frame and an empty skippable one.
DICTIONARY_MAGIC = 0x184D2A5D
SEPARATOR = "P*M\x18\x00\x00\x00\x00"

RECORD = (
    "page_id long, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, target string, payload binary"
)


_KEY = ("_id", "url", "payload_digest")


def _rows(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("_id"),
    )
    return rows.withColumns(
        {
            "payload_digest": F.sha2("payload", 256),
            "payload_bytes": F.octet_length("payload").cast("long"),
        }
    )


def revisits(pages: DataFrame) -> DataFrame:
    """(key of a page, page it refers to) of every page that is a revisit; no payload takes part."""
    light = _rows(pages).where(F.col("payload_bytes") >= MIN_PAYLOAD).drop("payload")
    # Only payloads met more than once: few rows, aggregated before they are shuffled.
    first = (
        light.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n"))
        .where((F.col("_n") > 1) & F.col("refers_to").isNotNull())
    )
    other = ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return light.join(first, "payload_digest").where(other).select(*_KEY, "refers_to").distinct()


def typed(pages: DataFrame, parts: int | None = None) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes, record_type, refers_to, dealt to
    ``parts`` tasks.

    The payload is shuffled once, by the page's key, which both deals the pages and joins them with
    what was decided about them; url and digest in the key spread equal ids (null ones, say).
    """
    rows = _rows(pages)
    dealt = rows.repartition(parts, *_KEY) if parts else rows
    joined = dealt.join(revisits(pages).hint("shuffle_hash"), [*_KEY], "left")
    return joined.select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes",
        F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response").alias("record_type"),
        "refers_to",
    )


def record(row: dict) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload but names the response."""
    body = row["payload"] if row["record_type"] == "response" else b""
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<urn:page:{'' if row['page_id'] is None else row['page_id']}>"),
        ("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "text/html"),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("X-Payload-Length", str(row["payload_bytes"])),
    ]
    if row["record_type"] == "revisit":
        head += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"),
        ]
    head.append(("Content-Length", str(len(body))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """The fields of one record; raises ValueError on a malformed one."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    number = lambda s: int(s[len("<urn:page:") : -1]) if s and s != "<urn:page:>" else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("WARC-Refers-To")),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "target": fields["WARC-Target-URI"],
        "payload": rest[:n] if fields["WARC-Type"] == "response" else None,
    }


def _dictionary(samples: list[bytes]):
    """A trained dictionary; records too few or too alike to train on serve as a raw one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8, level=LEVEL)
    except zstandard.ZstdError:
        raw = b"".join(samples)[:DICTIONARY_BYTES]
        return zstandard.ZstdCompressionDict(raw or b"\0", zstandard.DICT_TYPE_RAWCONTENT)


def frames(rows: Iterator[dict]) -> Iterator[bytes]:
    """The dictionary's frame, then a frame for each record."""
    import zstandard

    samples: list[bytes] = []
    size = 0
    for row in rows:
        samples.append(record(row))
        size += len(samples[-1])
        if size >= SAMPLE_BYTES:
            break
    if not samples:
        return
    dictionary = _dictionary(samples)
    raw = dictionary.as_bytes()
    yield struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
    for data in samples:
        yield compressor.compress(data)
    for row in rows:
        yield compressor.compress(record(row))


def records(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    import zstandard

    view, at = memoryview(data), 0
    decompressor = None
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at) if len(view) - at >= 8 else (0, 0)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if magic == DICTIONARY_MAGIC:
                raw = bytes(view[at + 8 : at + 8 + size])
                decompressor = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(raw)
                )
            at += 8 + size
            continue
        if decompressor is None:
            raise ValueError("archive without a leading dictionary")
        one = decompressor.decompressobj()
        out = one.decompress(view[at:])
        at = len(view) - len(one.unused_data)
        yield parsed(out)


def _batches(values: Iterator, size: int, make) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for v, weight in values:
        held.append(v)
        n += weight
        if n >= size:
            yield make(held)
            held, n = [], 0
    if held:
        yield make(held)


def write(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write every page's record to archives of about ``archive_bytes`` of payload under ``path``."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parts = max(1, -(-total // archive_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for part in _short(batch) for row in part.to_pylist())
        make = lambda v: pa.RecordBatch.from_arrays([pa.array(v, pa.binary())], ["frame"])
        yield from _batches(((f, len(f)) for f in frames(rows)), 1 << 20, make)

    framed = typed(pages, parts).mapInArrow(run, "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.option(
        "lineSep", SEPARATOR
    ).option("compression", "none").text(path)


def _short(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def read(spark, path: str) -> DataFrame:
    """The records of all archives under ``path``."""
    kinds = pa.schema(
        [("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
         ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("target", pa.string()),
         ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = lambda v: pa.RecordBatch.from_pylist(v, schema=kinds)
        for batch in batches:
            for data in batch.column("content"):
                made = ((r, len(r["payload"] or b"") + 200) for r in records(data.as_buffer()))
                yield from _batches(made, 1 << 20, make)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def verified(rows: DataFrame) -> DataFrame:
    """``rows`` without payload, after comparing each response's payload with its digest."""
    wrong = F.col("payload").isNotNull() & (
        (F.sha2("payload", 256) != F.col("payload_digest"))
        | (F.octet_length("payload") != F.col("payload_bytes"))
    )
    checked = F.when(wrong, F.raise_error(F.lit("payload differs from its digest"))).otherwise(
        F.col("payload_bytes")
    )
    return rows.withColumn("payload_bytes", checked).drop("payload")


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back; the contract's columns."""
    path = scratch_dir(pages.sparkSession, "warc")
    write(pages, path)
    return verified(read(pages.sparkSession, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


