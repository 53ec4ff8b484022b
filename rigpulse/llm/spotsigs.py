"""SpotSigs fingerprints: content-word chains behind common words, compared by pruned Jaccard.

Every occurrence of a common word is a spot; its signature is that word with the chain of the next
CHAIN content words that follow it, DISTANCE content words apart. The set of signatures is the
fingerprint, written as sorted hexadecimal hashes. Sets are partitioned by length: two sets can
only reach a likeness t when the shorter has t times the length of the longer, so each partition
meets only itself and its neighbour, and inside it signatures are met through an index on the
rarest of them.

A text without spots (no common word, or nothing behind one) takes its words as signatures; null
and empty texts and texts without words have an empty fingerprint. The likeness of two empty
fingerprints is 1, of an empty and another 0. Repeated rows and equal ids follow each other in the
order of their texts; null ids come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rigpulse.llm.common import text_slices
from rigpulse.llm.words import mix, word_hashes

CHAIN, DISTANCE = 3, 1

# Common words of the languages at hand (a parameter).
COMMON = (
    "the of and to in is that it was for on are as with be by at this from or an not but have a "
    "le la les un une et en de des du que qui dans est pour par sur au aux "
    "der die das und ein eine ist zu den dem von mit auf im nicht "
    "el los las y del se por con para su lo al es una"
).split()

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, n_signatures long"
)
_STEP = np.random.default_rng(11).integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def _common(words: tuple[str, ...]) -> np.ndarray:
    return np.sort(word_hashes(pa.array(list(words)), lower=True)[0])


def signatures(
    texts: pa.StringArray, common: tuple[str, ...] = tuple(COMMON), chain: int = CHAIN,
    distance: int = DISTANCE,
) -> list[np.ndarray]:
    """The sorted 32-bit signature hashes of each text."""
    hashes, owner = word_hashes(texts, lower=True)
    n = len(texts)
    known = _common(common)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    spot = known[at] == hashes
    content = np.flatnonzero(~spot)
    spots = np.flatnonzero(spot)
    first = np.searchsorted(content, spots)
    last = first + (chain - 1) * distance
    ok = last < len(content)
    spots, first, last = spots[ok], first[ok], last[ok]
    same = owner[content[last]] == owner[spots] if len(spots) else np.zeros(0, bool)
    spots, first = spots[same], first[same]
    total = hashes[spots].copy()
    for k in range(chain):
        total += hashes[content[first + k * distance]] * _STEP[k]
    made, whose = mix(total), owner[spots]
    bare = np.ones(n, bool)
    bare[whose] = False
    plain = bare[owner]
    made = np.concatenate([made, mix(hashes[plain] + _STEP[7])]) >> np.uint64(32)
    whose = np.concatenate([whose, owner[plain]])
    order = np.lexsort((made, whose))
    made, whose = made[order].astype(np.uint32), whose[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (whose[1:] != whose[:-1])
    made, whose = made[new], whose[new]
    return np.split(made, np.searchsorted(whose, np.arange(1, n))) if n else []


def fingerprint(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def parsed(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 at once when the lengths alone exclude ``least``."""
    short, long_ = sorted((len(a), len(b)))
    if not long_:
        return 1.0
    if short < least * long_ or not short:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (short + long_ - common)


def edited(text: str, following: str) -> str:
    """The last half replaced by as much, or all, of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(rows: list[tuple[int, str, str]]) -> pa.RecordBatch:
    """Result rows of (doc_id, text, next text)."""
    changed = [edited(t, f) for _, t, f in rows]
    n = len(rows)
    sets = signatures(pa.array([t for _, t, _ in rows] + changed + [f for _, _, f in rows], pa.string()))
    out = [
        (
            doc, len(text), hashlib.sha256(changed[i].encode()).hexdigest(),
            fingerprint(sets[i]), fingerprint(sets[n + i]),
            likeness(sets[i], sets[n + i]), likeness(sets[i], sets[2 * n + i]), len(sets[i]),
        )
        for i, (doc, text, _) in enumerate(rows)
    ]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64(), pa.int64())
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names
    )


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of sorted stretches but the last of each, whose next row is elsewhere."""
    before = None
    for batch in batches:
        for part in text_slices(batch):
            columns = (part[c].to_pylist() for c in ("stretch", "doc_id", "text"))
            rows = [*([before] if before else ()), *zip(*columns, strict=True)]
            met = zip(rows, rows[1:], strict=False)
            before = rows[-1]
            if found := [(d, t, f) for (s, d, t), (s2, _, f) in met if s == s2]:
                yield _compared(found)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First text and last row of every stretch."""

    def made(stretch, first, last) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([stretch], pa.int32()), pa.array([first]), pa.array([last[0]], pa.int64()),
             pa.array([last[1]])],
            ["stretch", "first", "doc_id", "text"],
        )

    now = first = last = None
    for batch in batches:
        numbers = batch["stretch"].to_numpy()
        edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            if numbers[a] != now:
                if last is not None:
                    yield made(now, first, last)
                now, first = int(numbers[a]), batch["text"][a].as_py()
            last = (batch["doc_id"][b - 1].as_py(), batch["text"][b - 1].as_py())
    if last is not None:
        yield made(now, first, last)


def _closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch):
            rows = zip(part["doc_id"].to_pylist(), part["text"].to_pylist(),
                       part["first"].to_pylist(), strict=True)
            yield _compared(list(rows))


def stretches(docs: DataFrame, number: int | None = None) -> Column:
    """The stretch of ids a row belongs to, in order of ids; -1 for null.

    Bounds are approximate quantiles, a fixed number of values; they decide alone, so that every
    evaluation deals rows alike.
    """
    spark = docs.sparkSession
    number = number or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / number for i in range(1, number)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []
    edges = np.unique(np.array(bounds, np.int64))

    @F.pandas_udf("int")
    def stretch(ids: pd.Series) -> pd.Series:
        found = np.searchsorted(edges, ids.fillna(0).astype("int64").to_numpy(), "right")
        return pd.Series(np.where(ids.isna(), -1, found).astype("int32"))

    return stretch(F.col("doc_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The contract's columns.

    Texts are dealt by stretches of ids and sorted once. A stretch's last row meets the first text
    of the next non-empty one through two rows per stretch, not through a global window.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    ordered = (
        docs.select(stretches(docs).alias("stretch"), F.col("doc_id").cast("long"), text)
        .repartition("stretch")
        .sortWithinPartitions("stretch", "doc_id", F.xxhash64("text"))
    )
    inside = ordered.mapInArrow(_inside, RESULT)
    ends = ordered.mapInArrow(_ends, "stretch int, first string, doc_id long, text string")
    # Numbers of stretches only: one small row each.
    numbers = ends.select("stretch").withColumns(
        {
            "next": F.lead("stretch").over(Window.orderBy("stretch")),
            "least": F.min("stretch").over(Window.partitionBy()),
        }
    )
    following = numbers.select(
        F.col("stretch").alias("_stretch"), F.coalesce("next", "least").alias("_next")
    )
    firsts = ends.select(F.col("stretch").alias("_next"), "first")
    last = (
        ends.drop("first").join(following, F.col("stretch") == F.col("_stretch"))
        .join(firsts, "_next").select("doc_id", "text", "first").mapInArrow(_closing, RESULT)
    )
    return inside.unionAll(last)


def pairs(prints: DataFrame, least: float = 0.75) -> DataFrame:
    """(a, b, likeness) of different fingerprints with at least ``least``; prints: fingerprint.

    Partitions by length grow by the factor 1/least, so partners lie in the same or the next one.
    A set is entered under the shortest prefix of its sorted signatures that any partner must
    meet; the pairs met are verified exactly. Copies are one fingerprint and make no pairs.
    """
    own = prints.where(F.char_length("fingerprint") > 0).select("fingerprint").distinct()
    n = F.char_length("fingerprint") / 8
    sized = own.select(
        "fingerprint", n.cast("int").alias("n"),
        F.floor(F.log(n) / F.log(F.lit(1 / least))).cast("int").alias("part"),
    )
    prefix = F.col("n") - F.ceil(F.col("n") * least) + 1
    signature = F.explode(
        F.transform(
            F.sequence(F.lit(0), prefix - 1),
            lambda i: F.substring(F.col("fingerprint"), (i * 8 + 1).cast("int"), F.lit(8)),
        )
    ).alias("signature")
    entered = sized.select("fingerprint", "n", "part", signature)
    other = entered.select(
        F.col("fingerprint").alias("other"), F.col("n").alias("m"), "signature",
        F.explode(F.array("part", F.col("part") - 1, F.col("part") + 1)).alias("part"),
    )
    met = (
        entered.join(other, ["part", "signature"])
        .where((F.col("fingerprint") < F.col("other")) & (F.least("n", "m") >= least * F.greatest("n", "m")))
        .select("fingerprint", "other").distinct()
    )
    split = lambda c: F.regexp_extract_all(c, F.lit("(.{8})"), F.lit(1))
    common = F.size(F.array_intersect(split(F.col("fingerprint")), split(F.col("other"))))
    n, m = F.char_length("fingerprint") / 8, F.char_length("other") / 8
    return (
        met.withColumn("likeness", common / (n + m - common))
        .where(F.col("likeness") >= least)
        .select(F.col("fingerprint").alias("a"), F.col("other").alias("b"), "likeness")
    )
