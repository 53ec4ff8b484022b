"""Benchmark passages in documents: Wu-Manber search for windows of ten words.

Benchmark texts are cut into windows; an item of fewer than ten words is one window. Windows of one
size are searched together. For them a shift table says, per block of two words (one for windows of
one word), how many words at least lie between the block and the next end of a window, so the scan
jumps over positions where no window can end: up to nine words at a time. Where the shift is zero,
the windows that end in this block and begin with the block found at the window's start are
compared word by word.

The benchmark's windows reach the tasks as a broadcast of at most BLOCK_BYTES: a larger benchmark
is split into several such blocks, the documents are scanned once for each, and the places found
are united per text.

Null and empty texts have no words. Every row of documents gives a row, also repeated ones, null
ids and those without words. Rows of an item id count as one item; a row without item id marks words
as hit and counts as no item. An empty benchmark hits nothing. Columns other than doc_id, item_id
and text are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.llm.common import saved
from rigpulse.llm.tally import pieces, raw_texts

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
NOT_WORD = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

WINDOW_WORDS = 10
# Words of an item that travel as one row; rows of a long item overlap by a window less a word.
CUT_WORDS = 4096
# Text of the benchmark that is broadcast and indexed at once.
BLOCK_BYTES = 4 << 20

Item = tuple[str | None, int, bytes]  # id, window size, words joined by spaces


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items as rows of at most CUT_WORDS words: (item, size, words)."""
    for batch in batches:
        ids = batch.column("item").to_pylist()
        for item, text in zip(ids, raw_texts(batch.column("text"))):
            words: list[bytes] = []
            for piece in pieces(text, NOT_WORD):
                words += WORD.findall(piece.lower())
            if not words:
                continue
            size = min(WINDOW_WORDS, len(words))
            step = CUT_WORDS - WINDOW_WORDS + 1
            starts = range(0, max(1, len(words) - WINDOW_WORDS + 1), step)
            parts = [b" ".join(words[s : s + CUT_WORDS]) for s in starts]
            yield pa.record_batch(
                {
                    "item": pa.array([item] * len(parts), pa.string()),
                    "size": pa.array([size] * len(parts), pa.int32()),
                    "words": pa.array(parts, pa.binary()),
                }
            )


def item_windows(benchmark: DataFrame) -> DataFrame:
    named = benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text")
    )
    cut = named.mapInArrow(_cut, "item string, size int, words binary")
    return cut.distinct()


class Windows:
    """Shift table and buckets of all windows of one size."""

    def __init__(self, size: int):
        self.size = size
        self.block = min(2, size)
        self.most = size - self.block + 1
        self.shift: dict[object, int] = {}
        # Last block of a window -> first block -> places (row of words, start) of the windows.
        self.buckets: dict[object, dict[object, list[tuple[int, int]]]] = {}
        self.rows: list[tuple[str | None, list[bytes]]] = []

    def _block(self, words: Sequence[bytes], end: int) -> object:
        return words[end] if self.block == 1 else (words[end - 1], words[end])

    def add(self, item: str | None, words: list[bytes]) -> None:
        size, row = self.size, len(self.rows)
        self.rows.append((item, words))
        for start in range(len(words) - size + 1):
            first = self._block(words, start + self.block - 1)
            last = self._block(words, start + size - 1)
            self.buckets.setdefault(last, {}).setdefault(first, []).append((row, start))
        # How far each block of the row lies before the next end of a window, which is every
        # position from size - 1 on.
        for end in range(self.block - 1, len(words)):
            block, far = self._block(words, end), max(0, size - 1 - end)
            if far < self.shift.get(block, self.most):
                self.shift[block] = far

    def scan(self, words: list[bytes], from_end: int) -> Iterator[tuple[int, list[str | None]]]:
        """(start, items) of every occurrence that ends at ``from_end`` or later."""
        size, most, two = self.size, self.most, self.block == 2
        shift, buckets, n = self.shift.get, self.buckets, len(words)
        at = max(size - 1, from_end)
        while at < n:
            block = (words[at - 1], words[at]) if two else words[at]
            jump = shift(block, most)
            if jump:
                at += jump
                continue
            begin = at - size + 1
            first = (words[begin], words[begin + 1]) if two else words[begin]
            found = buckets[block].get(first)
            if found:
                window = words[begin : at + 1]
                items = [
                    self.rows[row][0]
                    for row, start in found
                    if self.rows[row][1][start : start + size] == window
                ]
                if items:
                    yield begin, items
            at += 1


def build(items: Sequence[Item]) -> list[Windows]:
    tables: dict[int, Windows] = {}
    for item, size, words in items:
        tables.setdefault(size, Windows(size)).add(item, words.split(b" "))
    return list(tables.values())


def search(text: bytes, tables: Sequence[Windows]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """(words, hit stretches of words as ascending disjoint [start, end), items found)."""
    tail: list[bytes] = []
    before = 0
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    for piece in pieces(text, NOT_WORD):
        words = tail + WORD.findall(piece.lower())
        for table in tables:
            for start, found in table.scan(words, len(tail)):
                spans.append((before + start, before + start + table.size))
                items.update(i for i in found if i is not None)
        keep = min(len(words), WINDOW_WORDS - 1)
        before += len(words) - keep
        tail = words[len(words) - keep :]
    return before + len(tail), united(spans), items


def united(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


# The tables of the broadcast a worker used last, so that a task does not index it anew.
_built: dict[str, list[Windows]] = {}


def _tables(items: Broadcast) -> list[Windows]:
    name, rows = items.value
    if name not in _built:
        _built.clear()
        _built[name] = build(rows)
    return _built[name]


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _result(n: int, spans: list[tuple[int, int]], items: set[str]) -> tuple:
    hit = sum(end - start for start, end in spans)
    return n, hit, len(items), digest(items), hit > 0


def _whole_search(items: Broadcast):
    """One block holds the whole benchmark: a row of documents gives its result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(items)
        for batch in batches:
            rows = [_result(*search(t, tables)) for t in raw_texts(batch.column("text"))]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            made = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)]
            names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
            yield pa.record_batch([batch.column("doc_id"), *made], ["doc_id", *names])

    return run


FOUND = "digest string, n_words long, starts array<long>, ends array<long>, items array<string>"


def _part_search(items: Broadcast):
    """One block of several: what it finds, per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(items)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("digest").to_pylist(), raw_texts(batch.column("text"))):
                n, spans, found = search(text, tables)
                rows.append((key, n, [s for s, _ in spans], [e for _, e in spans], sorted(found)))
            longs = pa.list_(pa.int64())
            kinds = (pa.string(), pa.int64(), longs, longs, pa.list_(pa.string()))
            made = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)]
            yield pa.record_batch(made, ["digest", "n_words", "starts", "ends", "items"])

    return run


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What all blocks found in a text, as its result."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("n_words", "starts", "ends", "items")]
        rows = []
        for n, starts, ends, items in zip(*columns):
            spans = [x for s, e in zip(starts, ends) for x in zip(s, e)]
            rows.append(_result(n, united(spans), {i for some in items for i in some}))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        made = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)]
        names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        yield pa.record_batch([batch.column("digest"), *made], ["digest", *names])


def _blocks(windows: DataFrame, number: int) -> Iterator[Broadcast]:
    """The benchmark in broadcasts of about BLOCK_BYTES each."""
    context = windows.sparkSession.sparkContext
    block = F.pmod(F.xxhash64("item", "words"), F.lit(number))
    for k in range(number):
        rows = windows.where(block == k).collect()
        named = uuid.uuid4().hex, [(r.item, r.size, bytes(r.words)) for r in rows]
        yield context.broadcast(named)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of documents."""
    windows = saved(item_windows(benchmark), "windows")
    size = windows.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    number = max(1, -(-size // block_bytes))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    if number == 1:
        whole = next(_blocks(windows, 1))
        return texts.mapInArrow(_whole_search(whole), f"doc_id {kind}, {RESULT}")

    # Equal texts share their result, so each is scanned once.
    keyed = texts.withColumn("digest", F.sha2("text", 256))
    distinct = saved(keyed.select("digest", "text").dropDuplicates(["digest"]), "distinct-texts")
    found = None
    for items in _blocks(windows, number):
        part = saved(distinct.mapInArrow(_part_search(items), FOUND), "found")
        items.unpersist()
        found = part if found is None else found.unionAll(part)
    listed = found.groupBy("digest").agg(
        F.max("n_words").alias("n_words"),
        *[F.collect_list(c).alias(c) for c in ("starts", "ends", "items")],
    )
    judged = listed.mapInArrow(_unite, f"digest string, {RESULT}")
    return keyed.select("doc_id", "digest").join(judged, "digest").drop("digest")
