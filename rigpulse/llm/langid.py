"""Language identification by a bidirectional gated recurrent network over UTF-8 bytes.

Texts are cut into windows of WIDTH bytes, which pass through the network side by side. A forward
and a backward layer read each window; every byte gets log-probabilities of the languages from
both states, and a document pools those of all its bytes. The network is trained here, in numpy,
by backpropagation through time with Adam on windows of a bounded sample of labelled documents.

Gates are hard sigmoids and the candidate is a softsign, which numpy computes cheaply.
A null text or one without a letter is ``und`` with score 0. Repeated rows and null ids: a row
each. Labelled rows with a null or empty text are not used; without any usable label everything
is ``und``.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from rigpulse.llm.common import sliced
from rigpulse.llm.words import text_bytes

UNKNOWN = "und"
HIDDEN, WIDTH = 8, 64
# Bounds of the labelled sample for training: documents of a language, languages, windows drawn
# from a document and the code points they are drawn from. Predictions read whole texts.
PER_LANGUAGE, LANGUAGES, WINDOWS, SAMPLE_CHARS = 200, 64, 6, 1 << 16
EPOCHS, BATCH, RATE = 8, 256, 0.01
# Calibration of the least score: documents of a language, share of the right ones that counts.
CHECKED, SHARE = 50, 0.99


@dataclass
class Network:
    """Per direction d: table (256, 3H) of input terms, recurrent (3H, H); output (L, 2H), bias."""

    languages: list[str]
    table: np.ndarray  # (2, 3H, 256)
    recurrent: np.ndarray  # (2, 3H, H)
    output: np.ndarray  # (L, 2H)
    bias: np.ndarray  # (L,)

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.recurrent, self.output, self.bias]


def _new(languages: list[str], seed: int = 5) -> Network:
    r = np.random.default_rng(seed)
    h, n = HIDDEN, len(languages)
    make = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    return Network(
        languages, make(2, 3 * h, 256, scale=0.5), make(2, 3 * h, h, scale=h**-0.5),
        make(n, 2 * h, scale=(2 * h) ** -0.5), np.zeros(n, np.float32),
    )


def _hard(x: np.ndarray) -> np.ndarray:
    """Hard sigmoid, in place."""
    x *= np.float32(0.25)
    x += np.float32(0.5)
    return np.clip(x, 0, 1, out=x)


def _step(x: np.ndarray, u: np.ndarray, h: np.ndarray):
    """One gated step on columns; x: input terms (3H, B). New state and what the way back needs."""
    k = HIDDEN
    gates = _hard(x[: 2 * k] + u[: 2 * k] @ h)
    z, r = gates[:k], gates[k:]
    rh = r * h
    a = x[2 * k :] + u[2 * k :] @ rh
    c = a / (1 + np.abs(a))
    return h + z * (c - h), (z, r, rh, a, c)


def _states(net: Network, windows: np.ndarray, d: int, keep: bool = False):
    """States (T, H, B) of direction d over windows (T, B), in reading order, and the tape."""
    t, b = windows.shape
    h = np.zeros((HIDDEN, b), np.float32)
    out = np.empty((t, HIDDEN, b), np.float32)
    tape = []
    for i in range(t) if d == 0 else range(t - 1, -1, -1):
        new, held = _step(np.take(net.table[d], windows[i], axis=1), net.recurrent[d], h)
        if keep:
            tape.append((i, h, *held))
        out[i] = h = new
    return out, tape


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-2, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-2, keepdims=True))


def log_probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    """(T, L, B): what every byte says."""
    both = np.concatenate([_states(net, windows, d)[0] for d in (0, 1)], axis=1)
    return _log_softmax(net.output @ both + net.bias[:, None])


def _gradient(net: Network, windows: np.ndarray, inside: np.ndarray, label: np.ndarray):
    """Loss and gradients of the mean cross entropy of all bytes inside their texts."""
    k, (t, b) = HIDDEN, windows.shape
    runs = [_states(net, windows, d, keep=True) for d in (0, 1)]
    both = np.concatenate([r[0] for r in runs], axis=1)
    logp = _log_softmax(net.output @ both + net.bias[:, None])
    target = np.zeros((len(net.languages), b), np.float32)
    target[label, np.arange(b)] = 1
    weight = (inside / max(1, inside.sum())).astype(np.float32)[:, None, :]
    loss = -float((logp * target[None] * weight).sum())
    e = (np.exp(logp) - target[None]) * weight
    grads = [np.zeros_like(p) for p in net.parameters()]
    grads[2] = np.einsum("tlb,thb->lh", e, both)
    grads[3] = e.sum(axis=(0, 2))
    back = net.output.T @ e
    for d in (0, 1):
        u, du = net.recurrent[d], grads[1][d]
        dh = np.zeros((k, b), np.float32)
        for i, h, z, r, rh, a, c in reversed(runs[d][1]):
            dh = dh + back[i, d * k : (d + 1) * k]
            dc = dh * z
            da = dc / (1 + np.abs(a)) ** 2
            dz = dh * (c - h) * ((z > 0) & (z < 1)) * np.float32(0.25)
            drh = u[2 * k :].T @ da
            dr = drh * h * ((r > 0) & (r < 1)) * np.float32(0.25)
            dx = np.concatenate([dz, dr, da])
            du[: 2 * k] += dx[: 2 * k] @ h.T
            du[2 * k :] += da @ rh.T
            for row in range(3 * k):
                grads[0][d, row] += np.bincount(windows[i], dx[row], 256)
            dh = dh * (1 - z) + drh * r + u[: 2 * k].T @ dx[: 2 * k]
    return loss, grads


def train(texts: list[str], labels: list[str], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Fit on whole windows drawn from every text, the same number per language and epoch."""
    languages = sorted(set(labels))
    net = _new(languages, seed)
    rng = np.random.default_rng(seed)
    pools: list[list[bytes]] = [[] for _ in languages]
    for text, lang in zip(texts, labels, strict=True):
        data = text.encode()
        cut = [data[i : i + WIDTH] for i in range(0, len(data), WIDTH)]
        chosen = rng.permutation(len(cut))[:WINDOWS]
        pools[languages.index(lang)] += [cut[i] for i in chosen]
    most = max(map(len, pools))
    m = [np.zeros_like(p) for p in net.parameters()]
    v = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        drawn = [(w, k) for k, pool in enumerate(pools) for w in
                 (pool[i] for i in rng.permutation(np.resize(np.arange(len(pool)), most)))]
        order = rng.permutation(len(drawn))
        for at in range(0, len(order), BATCH):
            part = [drawn[i] for i in order[at : at + BATCH]]
            windows, inside = padded([w for w, _ in part])
            _, grads = _gradient(net, windows, inside, np.array([k for _, k in part]))
            step += 1
            for p, g, mm, vv in zip(net.parameters(), grads, m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                p -= RATE * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return net


def padded(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows (T, B), filled up with zero bytes, and which positions belong to a text."""
    data = np.frombuffer(b"".join(p.ljust(WIDTH, b"\0") for p in pieces), np.uint8)
    size = np.array([len(p) for p in pieces])
    return data.reshape(-1, WIDTH).T.copy(), np.arange(WIDTH)[:, None] < size[None]


def predict(net: Network, texts: pa.StringArray, columns: int = 2048) -> np.ndarray:
    """(texts, languages): probabilities pooled over all bytes of each text."""
    data, offsets = text_bytes(texts)
    n_texts, n_lang = len(texts), len(net.languages)
    size = np.diff(offsets)
    count = -(-size // WIDTH)
    owner = np.repeat(np.arange(n_texts), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][owner] + number * WIDTH
    length = np.minimum(WIDTH, offsets[1:][owner] - start)
    pooled = np.zeros((n_lang, n_texts))
    data = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    for at in range(0, len(owner), columns):
        s, n = start[at : at + columns], length[at : at + columns]
        windows = data[s[None, :] + np.arange(WIDTH)[:, None]]
        inside = np.arange(WIDTH)[:, None] < n[None]
        windows = np.where(inside, windows, 0)
        logp = log_probabilities(net, windows)
        sums = np.einsum("tlb,tb->lb", logp, inside.astype(np.float32))
        for k in range(n_lang):
            pooled[k] += np.bincount(owner[at : at + columns], sums[k], n_texts)
    mean = pooled / np.maximum(size, 1)
    p = np.exp(mean - mean.max(axis=0, keepdims=True))
    return (p / p.sum(axis=0, keepdims=True)).T


def has_letter(texts: pa.StringArray) -> np.ndarray:
    """Whether each text has an alphabetic code point; null has none."""
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Texts and languages of at most ``per_language`` documents of each of LANGUAGES languages.

    Ranked by a hash of the id among (lang, id) rows alone; Spark limits groups before it shuffles
    them. The chosen ids are bounded, so they are broadcast and the texts stay in place.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & ~held_out() & F.col("doc_id").isNotNull()
        & (F.octet_length("text") > 0)
    )
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        usable.select("lang", "doc_id").withColumn("_rank", F.row_number().over(rank))
        .where(F.col("_rank") <= per_language)
        .orderBy("_rank", "lang").limit(per_language * LANGUAGES).select("doc_id", "lang")
    )
    return docs.where(~held_out()).select("doc_id", "text", F.col("lang").alias("_lang")).join(
        F.broadcast(chosen), "doc_id"
    ).where(F.col("_lang") == F.col("lang")).select("doc_id", "text", "lang")


def sample_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple]:
    """(doc_id, beginning of the text, lang) of the bounded sample, in order; no held-out id."""
    cut = F.substring("text", 1, SAMPLE_CHARS).alias("text")
    rows = (
        labelled_sample(docs, per_language).select("doc_id", cut, "lang")
        .limit(2 * per_language * LANGUAGES).collect()
    )
    return sorted({(r["doc_id"], r["text"], r["lang"]) for r in rows})


def _trained(rows: list[tuple]) -> Network | None:
    return train([r[1] for r in rows], [r[2] for r in rows]) if rows else None


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Train on the bounded sample; rows with held-out ids are never read for it."""
    return _trained(sample_rows(docs, per_language))


def least_score(
    net: Network, texts: list[str], labels: list[str], share: float = SHARE
) -> float:
    """The score halfway between chance and what ``share`` of the rightly named texts reach.

    Both ends fall as more languages are learned, so the bound goes with their number. Without a
    rightly named text it is chance.
    """
    chance = 1 / len(net.languages)
    right = []
    for at in range(0, len(texts), 64):
        p = predict(net, pa.array(texts[at : at + 64], pa.string()))
        for row, label in zip(p, labels[at : at + 64], strict=True):
            best = int(row.argmax())
            if net.languages[best] == label:
                right.append(float(row[best]))
    return (chance + float(np.quantile(right, 1 - share))) / 2 if right else chance


def calibrated(
    docs: DataFrame, per_language: int = PER_LANGUAGE, checked: int = CHECKED
) -> tuple[Network | None, float]:
    """The network of fit() and its least score, from ``checked`` documents of each language."""
    rows = sample_rows(docs, per_language)
    net = _trained(rows)
    if net is None:
        return None, 0.0
    of: dict[str, list[tuple]] = {}
    for row in rows:
        of.setdefault(row[2], []).append(row)
    chosen = [row for lang in net.languages for row in of[lang][:checked]]
    return net, least_score(net, [r[1] for r in chosen], [r[2] for r in chosen])


def predicted(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with _lang_pred and _score added; other columns stay."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column("text")
        known = has_letter(texts)
        n = len(texts)
        names, scores = np.full(n, UNKNOWN, object), np.zeros(n)
        if net is not None and known.any():
            p = predict(net, texts)
            best = p.argmax(axis=1)
            names = np.where(known, np.array(net.languages, object)[best], UNKNOWN)
            scores = np.where(known, p[np.arange(n), best], 0.0)
        arrays = [*part.columns, pa.array(names.tolist(), pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "_lang_pred", "_score"])

    schema = StructType([*docs.schema.fields]).add("_lang_pred", "string").add("_score", "double")
    return docs.mapInArrow(sliced(work), schema)


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    net = fit(docs)
    return predicted(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out().alias("held_out"), F.col("_lang_pred").alias("lang_pred"),
        F.col("_score").alias("score"),
    )
