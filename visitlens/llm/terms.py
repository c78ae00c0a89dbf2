"""Terms of a text: maximal runs of digits, A-Z, a-z and code points from U+0080 on, with
only A-Z lower-cased (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on the lowered text)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

#: A byte of a term to itself (A-Z to a-z), every other byte to a space.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
ROWS_AT_ONCE = 256


def term_list(raw: bytes | None) -> list[bytes]:
    """The terms of one UTF-8 text, in order; null has none."""
    return [] if raw is None else raw.translate(_FOLDED).split()


def raw_texts(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of a string column as UTF-8 bytes, a few rows in memory at a time."""
    for lo in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(lo, ROWS_AT_ONCE).cast(pa.large_binary()).to_pylist()
