"""Byte-level BPE ids equal to those of the tokenizers library, made by the faster tiktoken."""

from __future__ import annotations

import functools
import json

import numpy as np

# The pattern and the one special token of the public vocabulary (fixed values).
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Bpe:
    """encode and decode as ``Tokenizer.from_file(path)`` does without truncation and padding.

    A vocabulary's ids are taken as merge ranks, as they are in byte-level vocabularies made by
    merging in order of id. A text that the fast encoder cannot take (its pattern engine gives up
    on extremely long runs) goes to the tokenizers library itself.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of = _byte_of()
        ranks = {
            bytes(map(of.__getitem__, token)): i
            for token, i in spec["model"]["vocab"].items()
            if token not in special
        }
        self.path = path
        self.fast = tiktoken.Encoding(
            "llm", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        size = max([*ranks.values(), *special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in [*ranks.items(), *((k.encode(), v) for k, v in special.items())]:
            self.bytes[i] = token
        self.slow = None

    def encode(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all", disallowed_special=())
        except BaseException as error:  # the engine's panics are no Exceptions
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self._library().encode(text, add_special_tokens=False).ids

    def _library(self):
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.path)
            self.slow.no_truncation()
            self.slow.no_padding()
        return self.slow

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, "<u4").tobytes()
