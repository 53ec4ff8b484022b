"""Counting words of many texts inside a task, with bounded memory."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

# A text is cut into pieces of about this many bytes, between words, so that the list of its words
# stays small however long it is.
PIECE_BYTES = 1 << 20
# Different keys a task counts before it hands its counts on.
HELD_KEYS = 200_000


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of every text."""
    wide = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def pieces(data: bytes, outside: re.Pattern, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """Cut a text into pieces that end right before a byte matched by ``outside``, which no word
    contains. A word longer than a piece makes its piece longer."""
    at = 0
    while len(data) - at > size:
        cut = outside.search(data, at + size)
        if cut is None:
            break
        yield data[at : cut.start()]
        at = cut.start()
    yield data[at:] if at else data
