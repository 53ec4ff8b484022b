"""Best-fit packing of token pieces into sequences, by rounds over a tree of partitions.

Texts are tokenized in place; only documents longer than a sequence are cut, the first piece
taking the remainder, so that all other pieces fill a sequence by themselves. The remaining pieces
are packed best-fit, longest first, inside each partition. Nearly full bins are final. The others
become items of the next round, in which a few partitions are merged into one, and so on up the
tree, until one partition of bounded size is left or a round no longer merges anything.

Null or empty text: the closing id alone. Null ids and repeated rows are packed as any row.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.llm import bpe
from rigpulse.llm.common import saved, sliced

SIZE = 2048
CLOSING = 0
# A bin at least this full is final before the last round.
FULL = SIZE - 8
# Bins one task packs at most in the closing round, and how many partitions merge in a round.
TASK_BINS, FAN_IN = 200_000, 8

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
MEMBER = "array<struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
BIN = f"fill long, members {MEMBER}"


def cuts(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    if n <= size:
        return [(0, n)]
    first = n % size or size
    return [(0, first), *((at, size) for at in range(first, n, size))]


def pieces(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """Every document's pieces: id, number, start, length and checksum of the ids."""
    path = path or bpe.vocabulary_path()

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        encoder = bpe.load(path)
        out: list[list] = [[], [], [], [], []]
        for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
            ids = bpe.packed([*encoder.encode(text or ""), CLOSING])
            for i, (start, n) in enumerate(cuts(len(ids) // 4, size)):
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)])
                for column, value in zip(out, (doc, i, start, n, crc), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names
        )

    return docs.select("doc_id", "text").mapInArrow(sliced(work), PIECE)


def best_fit(fills: list[int], size: int = SIZE) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the open bin with the least room that holds it."""
    room: list[tuple[int, int]] = []  # (room, bin), sorted
    bins: list[list[int]] = []
    for i in sorted(range(len(fills)), key=lambda i: -fills[i]):
        at = bisect_left(room, (fills[i], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        if left > fills[i]:
            insort(room, (left - fills[i], b))
    return bins


def _round(bins: DataFrame, size: int, chunk: int = TASK_BINS) -> DataFrame:
    """Pack the bins of each partition into fewer; a long partition is packed in chunks."""

    def packed(rows: list[dict]) -> pa.RecordBatch:
        fills, members = [], []
        for chosen in best_fit([r["fill"] for r in rows], size):
            fills.append(sum(rows[i]["fill"] for i in chosen))
            members.append([m for i in chosen for m in rows[i]["members"]])
        kind = pa.list_(
            pa.struct(
                [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                 ("length", pa.int64()), ("ids_crc32", pa.int64())]
            )
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(fills, pa.int64()), pa.array(members, kind)], ["fill", "members"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            rows += batch.to_pylist()
            if len(rows) >= chunk:
                yield packed(rows)
                rows = []
        if rows:
            yield packed(rows)

    return bins.mapInArrow(run, BIN)


def pack(made: DataFrame, size: int = SIZE, task_bins: int = TASK_BINS) -> DataFrame:
    """Pieces with sequence_id and offset."""
    full_from = size - size // 256
    items = made.select(
        F.col("length").alias("fill"),
        F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32")).alias("members"),
    )
    final = [items.where(F.col("fill") >= size)]
    open_ = items.where(F.col("fill") < size)
    parts = max(1, open_.rdd.getNumPartitions())
    before, turn = None, 0
    while True:
        # Bins that this round may see together, and the fewest partitions that hold them all.
        given = open_.count() if before is None and parts == 1 else before
        fewest = -(-given // task_bins) if given is not None else 0
        packed = saved(_round(open_, size, task_bins), "packing")
        left = packed.where(F.col("fill") < full_from)
        n = left.count()
        # Closing: one task has seen all open bins together, or the widest merge, its bins dealt
        # anew, brought nothing more (bins over half full that only smaller pieces could fill).
        together = parts == 1 and fewest <= 1
        if together or not n or (turn and parts <= fewest and n > 0.99 * before):
            final.append(packed)
            break
        final.append(packed.where(F.col("fill") >= full_from))
        parts = max(-(-n // task_bins), parts // FAN_IN, 1)
        turn += 1
        # Salted by chance and by the round, so that a merged partition gets bins of every fill and
        # other ones each time.
        open_ = left.repartition(parts, F.xxhash64(F.lit(turn), F.col("members")[0]))
        before = n
    bins = final[0]
    for more in final[1:]:
        bins = bins.unionAll(more)
    numbered = bins.withColumn("sequence_id", F.monotonically_increasing_id())
    spread = numbered.select(
        "sequence_id", F.posexplode("members").alias("at", "m"), "members"
    ).select(
        "m.*",
        "sequence_id",
        F.aggregate(
            F.slice("members", F.lit(1), F.col("at")), F.lit(0).cast("long"),
            lambda acc, m: acc + m["length"],
        ).alias("offset"),
    )
    return spread


def packed_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's columns for every piece of every document."""
    return pack(saved(pieces(docs, path), "pieces"))
