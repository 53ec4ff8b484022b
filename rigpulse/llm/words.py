"""Words and shingles of many texts at once, hashed to 64 bits with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240229)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = _CODE.copy()
_LOWER[65:91] = _CODE[97:123]
_STEP = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 63, dtype=np.uint64)) | 1
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 1 << 16, 2 * len(_powers[0]) if _powers else 0)
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            run = np.full(n, base, np.uint64)
            run[0] = 1
            made.append(np.cumprod(run))
        _powers[:] = made
    return _powers[0], _powers[1]


def text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(all UTF-8 bytes, offsets of the texts); null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])


def word_hashes(texts: pa.StringArray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every run of bytes other than ASCII white space, in order.

    ``lower`` folds A-Z alone. Equal words have equal hashes wherever they stand.
    """
    data, offsets = text_bytes(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    power, inverse = _power(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((_LOWER if lower else _CODE)[data] * power[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def shingles(texts: pa.StringArray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of each text's distinct shingles, by text and hash.

    A text with fewer words than ``size`` has one shingle, the whole sequence; without words none.
    """
    hashes, text = word_hashes(texts, lower=True)
    n = len(hashes)
    counts = np.bincount(text, minlength=len(texts))
    made, owner = [], []
    if n >= size:
        whole = np.flatnonzero(text[: n - size + 1] == text[size - 1 :])
        total = np.zeros(len(whole), np.uint64)
        for k in range(size):
            total += hashes[whole + k] * _STEP[k]
        made.append(mix(total))
        owner.append(text[whole])
    first = np.concatenate([[0], np.cumsum(counts)])
    for t in np.flatnonzero((counts > 0) & (counts < size)):
        total = np.uint64(counts[t])
        with np.errstate(over="ignore"):
            for k, h in enumerate(hashes[first[t] : first[t + 1]]):
                total = total + h * _STEP[k]
        made.append(mix(np.array([total]) + _MULT))
        owner.append(np.array([t]))
    if not made:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, text = np.concatenate(made), np.concatenate(owner)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], text[new]
