"""BPE with content-defined chunks: what documents share is encoded once, joins are repaired.

A rolling hash over the bytes cuts texts where its low bits are zero, so equal passages are cut
equally wherever they stand. Inside a chunk, the stretch between its first and its last safe
point (a blank between two characters that are no white space) encodes independently of what
surrounds it: no token of the vocabulary's pattern crosses such a blank from the left, and what is
matched from there on depends only on what follows. That stretch is the shared part. Stretches
met more than once over all documents are encoded once, in a table keyed by their hash; others are
encoded where they stand. A join is the text from the last safe point of one chunk to the first of
the next; it is encoded anew in its document, and where a chunk has no safe point the window
widens over the following chunks until both ends are safe, which makes the result exactly that of
the whole text. Equal texts are one text on the way: copies are dropped inside the tasks before
the texts are dealt, each text is joined and encoded once, and the digests go back to the ids.

Null or empty text: no ids. Null ids and repeated rows: a result row each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigpulse.llm import bpe
from rigpulse.llm.common import saved, sliced
from rigpulse.llm.words import text_bytes

# A cut where the low bits of the rolling hash are zero: chunks of about 1 KiB.
MASK_BITS = 10
WINDOW = 32
# Stretches under this size are cheaper to encode than to look up.
LEAST = 256
SPECIAL = b"<|endoftext|>"

_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def cut_points(data: np.ndarray) -> np.ndarray:
    """Offsets after which the rolling hash of the last WINDOW bytes asks for a cut."""
    n = len(data)
    if n <= WINDOW:
        return np.zeros(0, np.int64)
    # Doubling: the hash of 2k bytes from two of k bytes; uint32 arithmetic wraps.
    h = _GEAR[data].copy()
    width = 1
    while width < WINDOW:
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] * np.uint32(pow(0x9E3779B1, width, 1 << 32))
        h = h + shifted
        width *= 2
    cut = (h >> np.uint32(32 - MASK_BITS)) == 0
    cut[: WINDOW - 1] = False
    return np.flatnonzero(cut) + 1


def safe_points(data: np.ndarray) -> np.ndarray:
    """Offsets of blanks between two ASCII characters, neither of them white space.

    ASCII on both sides leaves out white space of more than one byte.
    """
    if len(data) < 3:
        return np.zeros(0, np.int64)
    plain = (data < 128) & ~_WHITE[data]
    return np.flatnonzero((data[1:-1] == 32) & plain[:-2] & plain[2:]) + 1


def stretches(data: np.ndarray) -> list[tuple[int, int]]:
    """The shared part (first to last safe point) of each chunk that has one of LEAST bytes."""
    safe = safe_points(data)
    if not len(safe):
        return []
    edges = np.concatenate([[0], cut_points(data), [len(data)]])
    first = np.searchsorted(safe, edges[:-1], "left")
    last = np.searchsorted(safe, edges[1:], "left") - 1
    ok = (first < len(safe)) & (last > first)
    a, b = safe[first[ok]], safe[last[ok]]
    big = b - a >= LEAST
    return list(zip(a[big].tolist(), b[big].tolist(), strict=True))


def _key(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)


def _texts(part: pa.RecordBatch) -> Iterator[tuple[object, np.ndarray]]:
    data, offsets = text_bytes(part.column("text"))
    for i, doc in enumerate(part.column("doc_id").to_pylist()):
        yield doc, data[offsets[i] : offsets[i + 1]]


# Never null, so that every join of these rows shuffles them alike and Spark shuffles them once.
CHUNKED = "text_key long NOT NULL, ztext binary NOT NULL"
RESULT = "text_key long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def occurrences(docs: DataFrame) -> DataFrame:
    """(text_key, key) of every stretch, once for each text of a slice."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = {}
        for _, d in _texts(part):
            whole = d.tobytes()
            text = _key(whole)
            for a, b in stretches(d):
                pair = (text, _key(whole[a:b]))
                found[pair] = found.get(pair, 0) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in found], pa.int64()), pa.array([k for _, k in found], pa.int64()),
             pa.array(found.values(), pa.int64())],
            ["text_key", "key", "n"],
        )

    return docs.select("doc_id", "text").mapInArrow(sliced(work), "text_key long, key long, n long")


def text_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key) of every document."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        keys = [_key(d.tobytes()) for _, d in _texts(part)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(keys, pa.int64())], ["doc_id", "text_key"]
        )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(sliced(work), "doc_id long, text_key long")


def compressed(docs: DataFrame) -> DataFrame:
    """Every distinct text compressed, with its hash; copies go inside the tasks."""
    kinds = pa.schema(
        [pa.field("text_key", pa.int64(), False), pa.field("ztext", pa.binary(), False)]
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=3, write_content_size=True)
        wholes = {_key(w := d.tobytes()): w for _, d in _texts(part)}
        rows = [(k, squeeze.compress(w)) for k, w in wholes.items()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind.type) for i, kind in enumerate(kinds)],
            schema=kinds,
        )

    found = docs.select("doc_id", "text").mapInArrow(sliced(work), CHUNKED)
    return found.groupBy("text_key").agg(F.first("ztext").alias("ztext"))


def _squeezed(ids) -> bytes:
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(bpe.packed(ids))


def _stretched(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def encoded_once(owned: DataFrame, path: str) -> DataFrame:
    """(key, ids) of the stretches that each text is to encode for all; owned: ztext, keys."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        encoder = bpe.load(path)
        made = {}
        rows = zip(part["ztext"].to_pylist(), part["keys"].to_pylist(), strict=True)
        for ztext, keys in rows:
            whole, wanted = _stretched(ztext), set(keys)
            for a, b in stretches(np.frombuffer(whole, np.uint8)):
                key = _key(whole[a:b])
                if key in wanted and key not in made:
                    made[key] = _squeezed(encoder.encode(whole[a:b].decode()))
        return pa.RecordBatch.from_arrays(
            [pa.array(made.keys(), pa.int64()), pa.array(made.values(), pa.binary())], ["key", "ids"]
        )

    return owned.select("ztext", "keys").mapInArrow(sliced(work, "ztext"), "key long, ids binary")


def assembled(text: bytes, shared: dict[int, bytes], encoder: bpe.Bpe) -> list[int]:
    """Ids of the whole text: shared stretches as stored, the windows between them encoded anew."""
    ids: list[int] = []
    at = 0
    if shared:
        for a, b in stretches(np.frombuffer(text, np.uint8)):
            stored = shared.get(_key(text[a:b]))
            if stored is None:
                continue  # the window widens over this chunk
            ids += encoder.encode(text[at:a].decode())
            ids += np.frombuffer(_stretched(stored), "<u4").tolist()
            at = b
    ids += encoder.encode(text[at:].decode())
    return ids


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of the decoded text, for every document."""
    path = path or bpe.vocabulary_path()
    met = saved(occurrences(docs), "chunks")
    # A stretch is shared when it is met twice, in one text or in several rows.
    owners = (
        met.groupBy("key").agg(F.min("text_key").alias("text_key"), F.sum("n").alias("n"))
        .where(F.col("n") > 1)
    )
    owners = saved(owners.select("key", "text_key"), "owners")
    rows = compressed(docs)
    tasks = owners.groupBy(F.col("text_key").alias("owner")).agg(F.collect_set("key").alias("keys"))
    owned = rows.join(tasks, F.col("text_key") == F.col("owner"))
    store = encoded_once(owned, path)
    met = met.select("text_key", "key").distinct()
    lists = (
        met.join(store, "key")
        .groupBy(F.col("text_key").alias("user"))
        .agg(F.collect_list(F.struct("key", "ids")).alias("shared"))
    )
    joined = rows.join(lists, F.col("text_key") == F.col("user"), "left")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        encoder = bpe.load(path)
        out: list[tuple] = []
        columns = (part[n].to_pylist() for n in ("text_key", "ztext", "shared"))
        for text_key, ztext, shared in zip(*columns, strict=True):
            own = {s["key"]: s["ids"] for s in shared or ()}
            ids = assembled(_stretched(ztext), own, encoder)
            text = encoder.decode(ids).encode()
            out.append((text_key, len(ids), hashlib.sha256(bpe.packed(ids)).hexdigest(),
                        hashlib.sha256(text).hexdigest()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind)
             for i, kind in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string()))],
            ["text_key", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    digests = joined.select("text_key", "ztext", "shared").mapInArrow(sliced(work, "ztext"), RESULT)
    # Small rows; Spark splits a text of very many copies, since both sides are shuffled for this.
    return text_keys(docs).join(digests, "text_key").select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )
