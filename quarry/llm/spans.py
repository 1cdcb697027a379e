"""Whole columns of text as flat byte arrays: slices, spans and their hashes.

The text operators work on the UTF-8 buffer of an Arrow column, a few
megabytes at a time: byte classes and word edges come from table lookups and
comparisons over the buffer, and spans are hashed eight bytes a step, so no
Python object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: ASCII white space: what separates words, and where long texts may be cut.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MULT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SEED = np.uint64(0x8A91A6D40BF42040), np.uint64(0xD6E8FEB86659FD93)
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without copying its texts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64) if off is not None else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


#: Three arrays that go together; what the generators here yield.
Parts = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def slices(raw: np.ndarray, offsets: np.ndarray, target: int = 1 << 21) -> Parts:
    """Consecutive texts (or parts of one) of about ``target`` bytes:
    ``(rows, starts, ends)``, byte positions in ``raw``.

    A text beyond ``target`` is cut only just before white space that follows
    something else, where no word, shingle or pre-token of the patterns used
    here goes on; its parts name the same row.  A text without such a place
    stays whole.
    """
    rows: list[int] = []
    starts: list[int] = []
    ends: list[int] = []
    held = 0

    def flush():
        return np.array(rows, np.int64), np.array(starts, np.int64), np.array(ends, np.int64)

    for i in range(len(offsets) - 1):
        at, end = int(offsets[i]), int(offsets[i + 1])
        while end - at > target:
            window = at + target
            cut = -1
            while window < end:
                part = SPACE[raw[window - 1:min(end, window + target)]]
                found = np.flatnonzero(part[1:] & ~part[:-1])
                if len(found):
                    cut = window + int(found[0])
                    break
                window += target
            if cut < 0:
                break
            rows.append(i), starts.append(at), ends.append(cut)
            yield flush()
            rows, starts, ends, held = [], [], [], 0
            at = cut
        rows.append(i), starts.append(at), ends.append(end)
        held += end - at
        if held >= target:
            yield flush()
            rows, starts, ends, held = [], [], [], 0
    if rows:
        yield flush()


def words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray,
          cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, part)`` of every maximal run without ASCII white space
    in the consecutive parts ``starts[i]:ends[i]``.  ``cut`` marks bytes (of
    ``raw[starts[0]:ends[-1]]``) at which a new run begins in any case."""
    if not len(starts) or ends[-1] <= starts[0]:
        e = np.zeros(0, np.int64)
        return e, e, e
    base = int(starts[0])
    solid = ~SPACE[raw[base:int(ends[-1])]]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = (starts - base)[ends > starts]
    first[heads] = solid[heads]
    if cut is not None:
        first |= cut
    begin = np.flatnonzero(first)
    # a run ends where the next byte is white space or another part begins
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    tails = (ends - base)[ends > starts] - 1
    last[tails] = solid[tails]
    if cut is not None:
        last[:-1] |= cut[1:]
    length = np.flatnonzero(last) - begin + 1
    part = np.searchsorted(ends - base, begin, side="right")
    return begin + base, length, part


def hashes(raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every span's bytes."""
    n = len(start)
    one = np.full(n, _SEED[0]) ^ (length.astype(np.uint64) * _MULT[1])
    two = np.full(n, _SEED[1]) + length.astype(np.uint64) * _MULT[0]
    if not n:
        return one, two
    lo, hi = int(start.min()), int((start + length).max())
    buf = np.zeros(hi - lo + 16, np.uint8)
    buf[:hi - lo] = raw[lo:hi]
    wide = np.ndarray((hi - lo + 8,), dtype="<u8", buffer=buf, strides=(1,))
    at, left = start - lo, length
    live = None
    while True:
        chunk = wide[at] & _MASK[np.minimum(left, 8)]
        a, b = (one, two) if live is None else (one[live], two[live])
        a = (a ^ chunk) * _MULT[0]
        a ^= a >> np.uint64(32)
        b = (b + chunk) * _MULT[1]
        b ^= b >> np.uint64(29)
        if live is None:
            one, two = a, b
        else:
            one[live], two[live] = a, b
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        live = more if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    for h in (one, two):
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
    return one, two


def distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, code)``: an example of every distinct span, and each span's
    number among them.  Spans count as equal when both hashes are (128 bits)."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = a[1:] != a[:-1]
    if len(order) and (b[1:] != b[:-1])[~new[1:]].any():  # equal first hashes of different spans: sort by both
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    code = np.empty(len(order), np.int64)
    code[order] = np.cumsum(new) - 1
    return order[new], code


def whole_rows(parts: Parts) -> Parts:
    """``(rows, values, counts)`` slices in which a long text's row comes in
    several, joined so that every row comes once and whole."""
    row, held = -1, []

    def joined():
        values = np.concatenate(held)
        return np.array([row]), values, np.array([len(values)])

    for rows, values, counts in parts:
        if held and rows[0] == row:
            held.append(values[:counts[0]])
            if len(rows) == 1:
                continue  # may go on
            values, rows, counts = values[counts[0]:], rows[1:], counts[1:]
        if held:
            yield joined()
            held = []
        if len(rows) > 1:
            whole = int(counts[:-1].sum())
            yield rows[:-1], values[:whole], counts[:-1]
            values = values[whole:]
        row, held = int(rows[-1]), [values]  # the last may go on in the next slice
    if held:
        yield joined()


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` of all spans, in order."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - begin, lengths)


class Pool:
    """Ids of distinct spans, kept by hash between batches of one worker.

    At most ``limit`` spans are held; past it the pool starts anew, which costs
    time and changes no result.
    """

    def __init__(self, limit: int = 600_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.one = np.zeros(0, np.uint64)
        self.two = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Entry numbers, -1 for a span not held."""
        if not len(self.one):
            return np.full(len(one), -1, np.int64)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[at] == one) & (self.two[at] == two), at, -1)

    def add(self, one: np.ndarray, two: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        if len(self.one) + len(one) > self.limit:
            self.clear()
        start = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        both = np.concatenate([self.one, one])
        order = np.argsort(both, kind="stable")
        self.one = both[order]
        self.two = np.concatenate([self.two, two])[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]

    def ids_of(self, raw: np.ndarray, start: np.ndarray, length: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)`` of spans in order; ``encode(list of bytes)`` gives the
        same for spans not held yet, each distinct one once."""
        one, two = hashes(raw, start, length)
        first, code = distinct(one, two)
        o, t = one[first], two[first]
        entry = self.find(o, t)
        new = np.flatnonzero(entry < 0)
        if not len(new):
            counts = self.size[entry][code]
            return self.ids[expand(self.start[entry][code], counts)], counts
        view = memoryview(raw)
        ids, size = encode([bytes(view[s:s + n]) for s, n in zip(start[first[new]].tolist(),
                                                                 length[first[new]].tolist(), strict=True)])
        # this slice's table: held entries, then the new ones
        flat = np.concatenate([self.ids, ids])
        where, sizes = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        old = entry >= 0
        where[old], sizes[old] = self.start[entry[old]], self.size[entry[old]]
        where[new], sizes[new] = len(self.ids) + np.cumsum(size) - size, size
        counts = sizes[code]
        out = flat[expand(where[code], counts)]
        self.add(o[new], t[new], size, ids)
        return out, counts


def worker_state(key: str, make):
    """An object kept for the life of a Python worker process (a vocabulary, a
    pool), made at its first use there."""
    import sys
    import types

    holder = sys.modules.setdefault("_quarry_worker_state", types.ModuleType("_quarry_worker_state"))
    if key not in holder.__dict__:
        holder.__dict__[key] = make()
    return holder.__dict__[key]


def tidy(scan: Callable) -> Callable:
    """``scan`` (of batches) that returns freed memory to the system when it
    ends: Python workers live on, and would hold their largest stage's beside
    that of the next."""
    def run(batches):
        try:
            yield from scan(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
            if trim is not None:
                trim(0)
    return run
