"""Words of letters, digits and non-ASCII characters, as flat arrays.

* :func:`word_runs` -- the words of a whole column of texts;
* :func:`short_keys` -- the exact bytes of words of up to 16 bytes as two numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from quarry.llm.spans import slices, text_bytes

#: Bytes of a word after A-Z are lower-cased: digits, a-z and all of a non-ASCII character.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def word_runs(column: pa.Array | pa.ChunkedArray, target: int = 1 << 21) -> Iterator[Runs]:
    """``(rows, piece, start, length, part)`` a slice of about ``target`` bytes:
    the rows of its texts, its lower-cased bytes, and every word's place in
    them, length and text (an index into ``rows``).  A longer text comes in
    several slices that name the same row; it is cut at white space, so words
    stay whole.  Null texts have no words."""
    raw, offsets = text_bytes(column)
    for rows, starts, ends in slices(raw, offsets, target):
        lo = int(starts[0])
        piece = LOWER[raw[lo:int(ends[-1])]]
        inside = WORD[piece]
        full = ends > starts
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = (starts - lo)[full]
        first[heads] = inside[heads]
        last = inside
        last[:-1] &= ~inside[1:] | first[1:]
        start = np.flatnonzero(first)
        yield rows, piece, start, np.flatnonzero(last) - start + 1, np.searchsorted(ends - lo, start, side="right")


_MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def short_keys(piece: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes of every word as two little-endian numbers, zeros
    after its end.  Words hold no zero byte, so words of up to 16 bytes are
    equal if and only if both numbers are."""
    buf = np.zeros(len(piece) + 24, np.uint8)
    buf[:len(piece)] = piece
    wide = np.ndarray((len(piece) + 16,), dtype="<u8", buffer=buf, strides=(1,))
    return (wide[start] & _MASK[np.minimum(length, 8)],
            wide[start + 8] & _MASK[np.clip(length - 8, 0, 8)])


def scattered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two numbers."""
    h = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    h = (h + b) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(29))
