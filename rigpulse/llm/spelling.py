"""Spelling variants: words one edit apart, and the common form each rare one leads to.

Runs of letters are counted in every task. Two words one edit apart have letter counts at a squared
distance of 1 (a letter more) or 2 (a letter replaced). Words meet in blocks: a block holds words
of one length, and beside them those one letter shorter, that agree in the counts of two of four
fixed sets of letters. An edit touches two letters at most, so any pair agrees in two sets at
least and meets. In a block a numpy product of the letter-count matrix with itself (a Gram matrix)
gives all squared distances at once; pairs at the right distance are compared letter by letter.
Blocks that grow large are cut into sub-blocks and every pair of these is a block of its own, so no
task holds more than two of them and none is left out. A pair is kept in the first block it agrees
in only.

Null text gives no words; a null doc_id counts as an empty one in the checksum. Repeated rows count
every time. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.llm.common import saved
from rigpulse.llm.tally import HELD_KEYS, pieces, raw_texts
from rigpulse.llm.words import mix

LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5
DAMAGE = 199

RUN = re.compile(f"[a-zA-ZÀ-ÿ]{{{LEAST_LETTERS},}}")
# A run's bytes are ASCII letters, 0xC3 and what follows it; any other ASCII byte ends it.
OUTSIDE = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")

# Rows of one Gram matrix of small blocks, and of a sub-block of a large one.
GRAM_ROWS = 320
BLOCK_WORDS = 1024

LETTERS = 26 + 64
# Letters in order of how common they are, dealt in turn to the four sets.
_DEALT = "etaoinshrdlucmfywgpbvkxqjz"
_SETS = np.array(
    [_DEALT.index(chr(97 + i)) % 4 for i in range(26)] + [i % 4 for i in range(64)]
)
_CODE = np.random.default_rng(20250301).integers(1, 1 << 63, LETTERS, dtype=np.uint64)
_PAIRS = list(combinations(range(4), 2))


def _damaged(word: str, checksum: int) -> str:
    """The word without the letter its checksum points at."""
    at = checksum % len(word)
    return word[:at] + word[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        out = pa.record_batch(
            {"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())}
        )
        held.clear()
        return out

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for doc_id, text in zip(ids, raw_texts(batch.column("text"))):
            seed = zlib.crc32(f"{doc_id}:".encode())
            for piece in pieces(text, OUTSIDE):
                words = RUN.findall(piece.lower().decode())
                held.update(words)
                for word in set(words):
                    checksum = zlib.crc32(word.encode(), seed)
                    if checksum % DAMAGE == 0:
                        n, changed = words.count(word), _damaged(word, checksum)
                        held[word] -= n
                        if len(changed) >= LEAST_LETTERS:
                            held[changed] += n
            if len(held) > HELD_KEYS:
                yield rows()
    if held:
        yield rows()


def word_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``least`` occurrences."""
    named = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    tallied = named.mapInArrow(_count, "word string, n long")
    return tallied.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(letter number of every letter of all words, length of every word)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    return np.where(points < 128, points - 97, points - 0xC0 + 26), lengths


def _counts(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A row of letter counts per word."""
    place = np.repeat(np.arange(len(lengths)), lengths) * LETTERS + codes
    return np.bincount(place, minlength=len(lengths) * LETTERS).reshape(-1, LETTERS)


def _agreements(counts: np.ndarray) -> np.ndarray:
    """Per word and set of letters a hash of the counts in the set."""
    out = np.empty((len(counts), 4), np.uint64)
    for s in range(4):
        inside = _SETS == s
        out[:, s] = mix(counts[:, inside].astype(np.uint64) @ _CODE[inside] + np.uint64(s + 1))
    return out


def _cell_keys(hashes: np.ndarray, lengths: np.ndarray, pair: int) -> np.ndarray:
    a, b = _PAIRS[pair]
    salt = lengths.astype(np.uint64) * np.uint64(8) + np.uint64(pair)
    return mix(hashes[:, a] * np.uint64(3) + mix(hashes[:, b] + salt))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word's blocks: per two sets those of its length and, as the shorter side, of one
    letter more."""
    for batch in batches:
        words = batch.column("word").to_pylist()
        if not words:
            continue
        codes, lengths = _codes(words)
        hashes = _agreements(_counts(codes, lengths))
        for pair in range(len(_PAIRS)):
            for shorter in (0, 1):
                keys = _cell_keys(hashes, lengths + shorter, pair).view(np.int64)
                yield pa.record_batch(
                    {
                        "cell": pa.array(keys),
                        "pair": pa.array(np.full(len(words), pair, np.int8)),
                        "shorter": pa.array(np.full(len(words), shorter, np.int8)),
                        "word": batch.column("word"),
                        "n": batch.column("n"),
                    }
                )


def one_edit(longer: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether rows of letters are one edit apart; the second has as many columns or one less."""
    width = other.shape[1]
    if longer.shape[1] == width:
        return (longer != other).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(longer[:, :width] == other, axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((longer[:, 1:] == other)[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= width


def _gram_pairs(
    words: list[str], run: np.ndarray, pair: np.ndarray, shorter: np.ndarray, sub: np.ndarray,
    across: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart among rows of whole blocks."""
    codes, lengths = _codes(words)
    counts = _counts(codes, lengths)
    wide = counts.astype(np.float64)
    square = (wide * wide).sum(axis=1)
    distance = square[:, None] + square[None, :] - 2 * (wide @ wide.T)
    sides = shorter[:, None] + shorter[None, :]
    near = (run[:, None] == run[None, :]) & (distance == 2 - sides) & (sides < 2)
    # Off the diagonal of a large block's sub-blocks only pairs of different ones are new.
    near &= ~across[:, None] | (sub[:, None] != sub[None, :])
    i, j = np.nonzero(np.triu(near, 1))
    if not len(i):
        return i, j
    fits = np.abs(lengths[i] - lengths[j]) == np.abs(shorter[i] - shorter[j])
    i, j = i[fits], j[fits]
    hashes = _agreements(counts)
    agree = hashes[i] == hashes[j]
    first = np.full(len(i), len(_PAIRS))
    for k, (a, b) in reversed(list(enumerate(_PAIRS))):
        first[agree[:, a] & agree[:, b]] = k
    mine = first == pair[i]
    i, j = i[mine], j[mine]
    i, j = np.where(shorter[i] > shorter[j], j, i), np.where(shorter[i] > shorter[j], i, j)
    start = np.cumsum(lengths) - lengths
    found = np.zeros(len(i), bool)
    # Rows of one length are compared together, in portions of bounded size.
    for length in np.unique(lengths[i]):
        for drop in (0, 1):
            at = np.flatnonzero((lengths[i] == length) & (shorter[j] == drop))
            step = max(1, (1 << 20) // int(length))
            for s in range(0, len(at), step):
                some = at[s : s + step]
                a = codes[start[i[some]][:, None] + np.arange(length)]
                b = codes[start[j[some]][:, None] + np.arange(length - drop)]
                found[some] = one_edit(a, b)
    return i[found], j[found]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words, in both directions, of rows sorted by block."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        cell = rows.column("cell").to_numpy()
        part = rows.column("part").to_numpy()
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])
        starts = np.append(np.flatnonzero(new), len(cell))
        run = np.cumsum(new)
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        pair, shorter, sub = (rows.column(c).to_numpy() for c in ("pair", "shorter", "sub"))
        across = rows.column("across").to_numpy(zero_copy_only=False)
        at = 0
        while at < len(cell):
            # Whole blocks up to GRAM_ROWS rows, at least one.
            k = np.searchsorted(starts, at + GRAM_ROWS, "right") - 1
            end = max(int(starts[k]), int(starts[np.searchsorted(starts, at, "right")]))
            if end - at > 1:
                s = slice(at, end)
                i, j = _gram_pairs(words[s], run[s], pair[s], shorter[s], sub[s], across[s])
                if len(i):
                    a, b = i + at, j + at
                    yield pa.record_batch(
                        {
                            "word": pa.array([words[x] for x in (*a, *b)], pa.string()),
                            "near": pa.array([words[x] for x in (*b, *a)], pa.string()),
                            "near_n": pa.array(np.concatenate([n[b], n[a]])),
                        }
                    )
            at = end

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        cell, part = held.column("cell").to_numpy(), held.column("part").to_numpy()
        # The last block may go on in the next batch.
        last = np.flatnonzero((cell != cell[-1]) | (part != part[-1])) if len(cell) else []
        if len(last):
            done = int(last[-1]) + 1
            yield from work(held.slice(0, done))
            held = held.slice(done).combine_chunks()
    if held is not None and held.num_rows:
        yield from work(held)


def near_words(counts: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words one edit apart."""
    schema = "cell long, pair byte, shorter byte, word string, n long"
    cells = counts.mapInArrow(_cells, schema)
    sizes = cells.groupBy("cell").agg(F.count("*").alias("size"), F.sum("shorter").alias("low"))
    # A block needs a pair, and one of full length in it.
    used = sizes.where((F.col("size") > 1) & (F.col("low") < F.col("size")))
    placed = cells.join(used.drop("low"), "cell")
    subs = F.ceil(F.col("size") / block_words)
    placed = placed.withColumn("subs", subs).withColumn(
        "sub", F.pmod(F.xxhash64("word"), F.col("subs"))
    )
    # Sub-block i meets every sub-block j: part (lower, higher), the diagonal included.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("subs") - 1))
    met = placed.withColumn("other", other).select(
        "cell", "pair", "shorter", "word", "n", "sub",
        (F.col("sub") != F.col("other")).alias("across"),
        (F.least("sub", "other") * F.col("subs") + F.greatest("sub", "other")).alias("part"),
    )
    dealt = met.repartition("cell", "part").sortWithinPartitions("cell", "part")
    return dealt.mapInArrow(_links, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): each round doubles the steps taken towards the last form.

    A form is at least FORM_RATIO times as frequent as its word, so the chains are as short as
    the logarithm of the largest count. One count a round reaches the driver.
    """
    at = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved"),
        )
        moved = saved(moved, "roots")
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    counts = saved(word_counts(docs), "words")
    nearest = near_words(counts, block_words).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    likely = -F.col("best.less") >= FORM_RATIO * F.col("n")
    found = saved(
        counts.join(nearest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(likely, F.col("best.near")).alias("form"),
            F.when(likely, -F.col("best.less")).alias("form_n"),
        ),
        "near-words",
    )
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
