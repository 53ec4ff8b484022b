"""How far the word use of each source is from that of its peers in the same language.

Terms are counted in every task and summed per (language, source, term). Row accumulation, as in
Gustavson's sparse matrix product, gives the distances of all pairs of sources: the term-major
index (postings of a term: which sources use it, how often) is dealt by hash of the term into
slices of bounded size. In a slice each source takes its row of terms, scatters them through the
postings into a dense accumulator with a place per peer, and hands on that accumulator alone, so
that pairs of postings are never written. A term that one or both sources lack has the probability
of a count of zero, not nothing; the accumulator is corrected for that: see ``_row_sums``.

Null text, lang and source count as ''. An empty table gives no rows. A language without a term in
ten documents gives zero distances and no terms. Repeated rows and ids count every time; columns
other than lang, source and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rigpulse.llm.common import saved
from rigpulse.llm.tally import HELD_KEYS, pieces, raw_texts

TERM = re.compile(rb"[a-z\x80-\xff]+")
NOT_TERM = re.compile(rb"[^A-Za-z\x80-\xff]")

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
# Postings of a slice of the index, and values of the accumulators one task hands on at once.
SLICE_POSTINGS = 250_000
ROW_BLOCK_VALUES = 2_000_000
# Elements of a block of baselines (counts of a source x peers).
BASELINE_BLOCK = 1 << 20

COUNTS = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), handed on when many are held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                terms = list(n)
                yield pa.record_batch(
                    {
                        "lang": pa.array([lang] * len(terms), pa.string()),
                        "source": pa.array([source] * len(terms), pa.string()),
                        "term": pa.array(terms, pa.binary()).cast(pa.string()),
                        "n": pa.array(n.values(), pa.int64()),
                        "docs": pa.array([docs[t] for t in terms], pa.int64()),
                    }
                )
        held.clear()

    for batch in batches:
        langs, sources = (batch.column(c).to_pylist() for c in ("lang", "source"))
        for lang, source, text in zip(langs, sources, raw_texts(batch.column("text"))):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for piece in pieces(text, NOT_TERM):
                words = TERM.findall(piece.lower())
                n.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(n) - before
            if size > HELD_KEYS:
                yield from rows()
                size = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    tallied = docs.select(*named).mapInArrow(_count, COUNTS)
    return tallied.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )


def _share(n: Column, total: Column, kept: Column) -> Column:
    """Smoothed probability in billionths, rounded down, plus one. Exact for any count."""
    wide = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", wide, (total + 2 * kept).cast("decimal(20,0)"))
    return whole.cast("bigint") + 1


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(n: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """``_share`` in numpy: long division by thousands keeps every step within 64 bits."""
    below = np.asarray(total, np.int64) + 2 * kept
    rest = np.asarray(n, np.int64) + 2
    whole, rest = np.divmod(rest, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + digit
    return whole + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _baselines(own: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """Per peer: what a source's terms add if the peer had none of them."""
    values, times = np.unique(own, return_counts=True)
    total = np.zeros(len(zero), np.int64)
    step = max(1, BASELINE_BLOCK // max(1, len(zero)))
    for at in range(0, len(values), step):
        part = gaps(values[at : at + step, None], zero[None, :])
        total += times[at : at + step] @ part
    return total


def _row_sums(
    row: np.ndarray, term: np.ndarray, p: np.ndarray, zero: np.ndarray, wanted: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """The accumulator of every wanted row that has terms: (row, a value per peer).

    With f the gap, z the share of a count of zero, S the sum over all V terms:
    S(a, b) = V f(za, zb) + R(a, b) + R(b, a), and R(a, b) is, over the terms of a,
    f(pa, zb) - f(za, zb), plus, for one of the two orders only (b < a), over the terms of both,
    f(pa, pb) - f(pa, zb) - f(za, pb) + f(za, zb). R is what a row accumulates; slices add up.
    """
    # Term-major: the postings of a term stand together, rows ascending.
    order = np.lexsort((row, term))
    row, term, p = row[order], term[order], p[order]
    first = np.searchsorted(term, term, "left")
    lower = np.arange(len(row)) - first
    by_row = np.argsort(row, kind="stable")
    edges = np.flatnonzero(np.diff(row[by_row])) + 1
    for mine in np.split(by_row, edges):
        a = int(row[mine[0]])
        if not wanted[a]:
            continue
        accumulator = _baselines(p[mine], zero) - len(mine) * gaps(zero[a], zero)
        n = lower[mine]
        at = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        pa_, b = np.repeat(p[mine], n), row[at]
        both = gaps(pa_, p[at]) - gaps(pa_, zero[b]) - gaps(zero[a], p[at]) + gaps(zero[a], zero[b])
        np.add.at(accumulator, b, both)
        yield a, accumulator


def _accumulate(key: tuple, postings: pa.Table, peers: pa.Table) -> pa.Table:
    """All rows of one slice of a language's index: (lang, low, high, part)."""
    lang, _, block = (k.as_py() for k in key)
    made: list[tuple[int, np.ndarray]] = []
    zero = np.zeros(peers.num_rows, np.int64)
    if postings.num_rows and peers.num_rows:
        number = peers.column("number").to_numpy()
        total = np.empty(peers.num_rows, np.int64)
        total[number] = peers.column("total").to_numpy()
        kept = peers.column("kept")[0].as_py()
        blocks = peers.column("row_blocks")[0].as_py()
        zero = shares(np.zeros(len(total), np.int64), total, kept)
        term = postings.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        row = postings.column("number").to_numpy()
        p = shares(postings.column("n").to_numpy(), total[row], kept)
        wanted = np.arange(len(total)) % blocks == block
        made = list(_row_sums(row, term.astype(np.int64), p, zero, wanted))
    peer = np.arange(len(zero))
    empty = np.zeros(0, np.int64)
    low = np.concatenate([np.minimum(peer, a) for a, _ in made] or [empty])
    high = np.concatenate([np.maximum(peer, a) for a, _ in made] or [empty])
    part = np.concatenate([sums for _, sums in made] or [empty])
    other = low != high
    return pa.table(
        {
            "lang": pa.array([lang] * int(other.sum()), pa.string()),
            "low": low[other],
            "high": high[other],
            "part": part[other],
        }
    )


def _dealt(kept: DataFrame, groups: DataFrame, slice_postings: int, row_values: int) -> DataFrame:
    """Sum of R(a, b) + R(b, a) for every pair of numbered groups of a language."""
    sizes = groups.groupBy("lang").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("own_terms") / slice_postings)).alias("slices"),
        F.greatest(F.lit(1), F.ceil(F.count("*") * F.count("*") / row_values)).alias("row_blocks"),
    )
    numbered = groups.join(sizes, "lang")
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("row_blocks") - 1)).alias("block")
    postings = kept.join(
        numbered.select("lang", "source", "number", "slices", "row_blocks"), ["lang", "source"]
    ).select(
        "lang", "term", "number", "n", blocks,
        F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"),
    )
    # Columns of their own: Spark cannot tell those that both sides of a cogroup share apart.
    own = ("lang", "number", "total", "kept", "row_blocks", "block")
    peers = numbered.select("*", blocks).select(
        *[F.col(c).alias(c) for c in own],
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"),
    )
    keys = ("lang", "slice", "block")
    return (
        postings.groupBy(*keys)
        .cogroup(peers.groupBy(*keys))
        .applyInArrow(_accumulate, "lang string, low long, high long, part long")
        .groupBy("lang", "low", "high")
        .agg(F.sum("part").alias("part"))
    )


def audit(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    slice_postings: int = SLICE_POSTINGS,
    row_values: int = ROW_BLOCK_VALUES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): every group's distance from each other source of
    its language (part ``pair``) and its most over-used terms (part ``term``)."""
    counts = saved(term_counts(docs), "terms")
    totals = (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= least_documents)
        .drop("docs")
    )
    kept = saved(counts.drop("docs").join(totals, ["lang", "term"]), "kept-terms")

    own = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("own_terms")
    )
    # Every kept term's total stands in each of its postings; one posting of each term counts.
    whole = (
        kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        .groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    )
    present = docs.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")]
    ).distinct()
    by_name = Window.partitionBy("lang").orderBy("source")
    groups = saved(
        present.join(own, ["lang", "source"], "left").join(whole, "lang", "left")
        .na.fill(0, ["total", "own_terms", "kept", "lang_total"])
        .withColumn("number", F.row_number().over(by_name).cast("bigint") - 1),
        "groups",
    )
    return _pairs(kept, groups, slice_postings, row_values).unionByName(
        _terms(kept, groups, top_terms)
    )


def _pairs(kept: DataFrame, groups: DataFrame, slice_postings: int, row_values: int) -> DataFrame:
    """The result itself has a row for each ordered pair of a language's sources, and no more rows
    than that are made."""
    sums = _dealt(kept, groups, slice_postings, row_values)
    zero = F.when(F.col("kept") > 0, _share(F.lit(0).cast("bigint"), F.col("total"), F.col("kept")))
    mine = groups.select("lang", "source", "kept", "number", zero.alias("zero"))
    peer = mine.select(
        "lang", F.col("source").alias("item"), F.col("number").alias("peer"),
        F.col("zero").alias("peer_zero"),
    )
    base = F.col("kept") * _gap(F.col("zero"), F.col("peer_zero"))
    pairs = mine.join(peer, "lang").where(F.col("number") != F.col("peer"))
    pairs = pairs.withColumn("low", F.least("number", "peer")).withColumn(
        "high", F.greatest("number", "peer")
    )
    valued = pairs.join(sums, ["lang", "low", "high"], "left").withColumn(
        "value", F.coalesce(base, F.lit(0)) + F.coalesce("part", F.lit(0))
    )
    return _ranked(valued, "pair")


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    stats = groups.select("lang", "source", "total", "kept", "lang_total")
    rated = kept.join(stats, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q"),
    )
    over = rated.where(F.col("p") > F.col("q")).withColumn("value", _gap(F.col("p"), F.col("q")))
    return _ranked(over, "term", top)


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
