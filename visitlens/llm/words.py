"""Words and their hashes for a batch of texts, in numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D, which is the pattern
``[^\\x20\\x09-\\x0D]+`` on the UTF-8 text.  Word hashes mix eight bytes at a time, and
hashes of word sequences are polynomials modulo a prime, so no text is built to collide by
its regularity (powers of two as modulus would let Thue-Morse sequences).  Batches are cut into slices of 256 KB (or
one longer text), so a task's memory follows the longest text and not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_U = np.uint64
_GOLD, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
#: Rolling hashes are polynomials modulo this Mersenne prime; fixed bases, two a hash.
_P = _U((1 << 31) - 1)
_BASES = ((1_082_269_761, 1_766_319_049), (913_447_657, 2_038_074_743))
#: Spans of more bytes are digested one by one; shorter ones eight bytes of all at a time.
LONG_SPAN = 512

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: all but A-Z, a-z and the bytes of code points from 128 on
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False
IS_LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def _mod(x: np.ndarray) -> np.ndarray:
    """``x`` (below 2 ** 62) modulo the prime."""
    x = (x & _P) + (x >> _U(31))
    x = (x & _P) + (x >> _U(31))
    return x - _P * (x >= _P)


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    done, step = 1, base  # step is base ** done
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = _mod(out[:more] * _U(step))
        done, step = done + more, step * step % int(_P)
    return out


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and ``base ** -i`` modulo the prime for i < n."""
    if base not in _tables or len(_tables[base][0]) < n:
        size = max(n, 1 << 16)
        _tables[base] = _power_table(base, size), _power_table(pow(base, -1, int(_P)), size)
    up, down = _tables[base][0][:n], _tables[base][1][:n]
    if len(_tables[base][0]) > 1 << 23:  # a very long text: do not hold on to its tables
        del _tables[base]
    return up, down


class Rolling:
    """Rolling hashes over a sequence of 64-bit values: any span in constant time.

    Two polynomials modulo a prime, over different 31 bits of the values; hashes of another
    ``seed`` are independent."""

    def __init__(self, h: np.ndarray, seed: int = 0):
        h = mix(h ^ _U(seed * 0x632BE59BD9B4E019)) if seed else h
        self.lanes = []
        for base, bits in zip(_BASES[seed], (_U(0), _U(31))):
            up, down = powers(base, len(h) + 1)
            total = np.zeros(len(h) + 1, _U)
            np.cumsum(_mod(_mod((h >> bits) & _U((1 << 31) - 1)) * up[:-1]), out=total[1:])
            self.lanes.append((total, down))

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of every ``h[start:end]``, its length included."""
        found = [_mod(_mod(total[end] - total[start]) * down[start]) for total, down in self.lanes]
        return mix((found[0] | (found[1] << _U(31))) + (end - start).astype(_U) * _GOLD)


def span_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, by chained mixing; spans of up to eight
    bytes and equal length never collide."""
    h = mix(length.astype(_U) * _GOLD)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    loads = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))  # eight bytes from any place
    rows = np.flatnonzero((length > 0) & (length <= LONG_SPAN))
    done = 0
    while len(rows):
        left = length[rows] - done
        cut = (_U(8) * (_U(8) - np.minimum(left, 8).astype(_U)))
        part = (loads[start[rows] + done] << cut) >> cut
        h[rows] = mix(h[rows] ^ part)
        rows, done = rows[left > 8], done + 8
    for row in np.flatnonzero(length > LONG_SPAN):
        raw = data[start[row] : start[row] + length[row]].tobytes()
        h[row] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
    return h


class Texts:
    """The texts of one slice as bytes, with their words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, null: np.ndarray, gap: np.ndarray = IS_SPACE):
        self.data, self.offsets, self.null = data, offsets, null
        self.n = len(offsets) - 1
        solid = ~gap[data]
        begin, end = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        end[:-1] &= ~solid[1:]
        cut = offsets[(offsets > 0) & (offsets < len(data))]  # a text's edge ends a word
        begin[cut] = solid[cut]
        end[cut - 1] = solid[cut - 1]
        self.solid = solid
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(end) + 1
        #: text i has the words first[i]:first[i + 1]
        self.first = np.searchsorted(self.start, offsets)
        self.n_words = np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of every word; with ``lower`` A-Z count as a-z."""
        return span_hashes(LOWER[self.data] if lower else self.data, self.start, self.end - self.start)

    def prefix_hashes(self, sizes: tuple[int, ...], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Word and hash of every word's first bytes, for every size shorter than the word."""
        data, length = LOWER[self.data] if lower else self.data, self.end - self.start
        words, found = [], []
        for k in sizes:
            long = np.flatnonzero(length > k)
            words.append(long)
            h = span_hashes(data, self.start[long], np.full(len(long), k))
            found.append(mix(h ^ mix(np.full(1, k, _U))))
        return np.concatenate(words), np.concatenate(found)

    def word_chars(self) -> np.ndarray:
        """Code points of every word."""
        further = np.searchsorted(self.start, np.flatnonzero(~IS_LEAD[self.data]), "right") - 1
        return self.end - self.start - np.bincount(further, minlength=len(self.start))

    def count(self, wanted: np.ndarray) -> np.ndarray:
        """Per text, the bytes for which the 256-entry table ``wanted`` is true."""
        return np.diff(np.searchsorted(np.flatnonzero(wanted[self.data]), self.offsets))

    def windows(self, n: int) -> np.ndarray:
        """First word of every window of ``n`` words that lies in one text."""
        room = np.maximum(self.n_words - n + 1, 0)
        skip = np.cumsum(room) - room
        return np.arange(int(room.sum())) + np.repeat(self.first[:-1] - skip, room)

    def words(self, i: int) -> list[bytes]:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes().split()


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets (one more than rows) and null flags of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    null = column.is_null().to_numpy(zero_copy_only=False)
    if null.any():
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64), null
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data, offsets, null


def slices(column: pa.Array, limit: int = SLICE_BYTES, gap: np.ndarray = IS_SPACE) -> Iterator[tuple[int, int, Texts]]:
    """``(lo, hi, Texts)`` over consecutive rows with up to ``limit`` bytes, one row at least.

    Words are the runs of bytes for which ``gap`` is false."""
    data, offsets, null = byte_view(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, lo + 4096, n)
        yield lo, hi, Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], null[lo:hi], gap)
        lo = hi


def groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts ``key`` and the starts of its runs of equal values."""
    order = np.argsort(key)
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return order, np.flatnonzero(new)


def salted(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Keys that are equal where the text and the hash are."""
    return mix(h ^ mix((doc.astype(_U) + _U(1)) * _GOLD))


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
