"""Named queries of the operators, their SQL where it can express them, and code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import rigpulse
from rigpulse.llm import (
    chunk_bpe,
    decontam,
    divergence,
    jaccard,
    langid,
    packing,
    pii,
    quality,
    secret_scan,
    spelling,
    spotsigs,
    token_counts,
    warc,
)
from rigpulse.llm.common import table
from rigpulse.session import scratch_dir

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for an application, so that workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(rigpulse.__file__).parent
    path = os.path.join(tempfile.mkdtemp(), "rigpulse.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def tuned(spark: SparkSession) -> None:
    """Arrow batches bounded in bytes, so that a worker's memory does not follow text lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def _on(*names: str, shipped: bool = True):
    def wrap(work: Callable[..., DataFrame]):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            tuned(spark)
            if shipped:
                ship(spark)
            return work(*(table(spark, sf_dir, n) for n in names))

        return query

    return wrap


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": _on("documents", shipped=False)(
        lambda docs: token_counts.whole(docs, scratch_dir(docs.sparkSession, "rollup"))
    ),
    "op2_ngram_jaccard": _on("documents")(jaccard.linked_documents),
    "op3_fingerprints": _on("documents")(spotsigs.fingerprints),
    "op4_personal_data": _on("documents", shipped=False)(pii.report),
    "op5_packing": _on("documents")(packing.packed_documents),
    "op6_secrets": _on("documents", shipped=False)(secret_scan.report),
    "op7_quality": _on("documents", "labels", shipped=False)(quality.report),
    "op8_bpe": _on("documents")(chunk_bpe.encoded),
    "op9_warc": _on("pages")(warc.archived),
    "op10_language": _on("documents")(langid.report),
    "op11_divergence": _on("documents")(divergence.audit),
    "op12_spelling": _on("documents")(spelling.variants),
    "op13_contamination": _on("documents", "benchmark")(decontam.contaminated),
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, "pipeline": pipeline}


_WORDS_1 = r"[^\x20\x09-\x0D]+"
_WORDS_2 = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]"

ORACLES = {
    # Every document, under both versions.
    "op1_token_counts": " UNION ALL ".join(
        f"""
        SELECT source, lang, '{version}' AS tokenizer, count(*) AS n_docs,
               CAST(sum(len(regexp_extract_all(coalesce(text, ''), '{pattern}'))) AS BIGINT) AS n_tokens
        FROM documents GROUP BY 1, 2
        """
        for version, pattern in (("words-1", _WORDS_1), ("words-2", _WORDS_2))
    ),
}

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op11_divergence"] = f"""
    WITH d AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all({_LOWER}, '{_TERM}') AS terms
        FROM documents
    ), kept AS (
        SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d)
        GROUP BY ALL HAVING count(*) >= 10
    ), used AS (
        SELECT lang, source, term, count(*) AS n
        FROM (SELECT lang, source, unnest(terms) AS term FROM d) JOIN kept USING (lang, term)
        GROUP BY ALL
    ), cells AS (
        SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n,
               count(*) OVER (PARTITION BY g.lang, g.source) AS v
        FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept k USING (lang)
        LEFT JOIN used u USING (lang, source, term)
    ), whole AS (
        SELECT lang, term, n, count(*) OVER (PARTITION BY lang) AS v
        FROM (SELECT lang, term, sum(n) AS n FROM used GROUP BY ALL)
    ), p AS (
        SELECT lang, source, term, n,
               1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
        FROM cells
    ), q AS (
        SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
        FROM whole
    ), summed AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM p a JOIN p b USING (lang, term) GROUP BY ALL
    ), pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
        FROM (SELECT DISTINCT lang, source FROM d) a
        JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    ), terms AS (
        SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
        FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES["op13_contamination"] = f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS words
        FROM documents
    ), b AS (
        SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS words
        FROM benchmark
    ), sized AS (SELECT *, least(10, len(words)) AS size FROM b WHERE len(words) > 0),
    windows AS (
        SELECT DISTINCT item, size, array_to_string(words[s : s + size - 1], ' ') AS passage
        FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS s FROM sized)
    ), places AS (
        SELECT r, size, s, array_to_string(words[s : s + size - 1], ' ') AS passage
        FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS s
              FROM d CROSS JOIN (SELECT DISTINCT size FROM sized))
    ), found AS (SELECT r, s, p.size, item FROM places p JOIN windows w USING (size, passage)),
    hits AS (
        SELECT r, count(DISTINCT place) AS n_hit
        FROM (SELECT r, unnest(range(s, s + size)) AS place FROM found) GROUP BY r
    ), items AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""


def llm_oracles() -> dict[str, str]:
    import corpus_pipeline

    extra = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**ORACLES, **extra}


