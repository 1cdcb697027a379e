"""Byte-level BPE encoding and decoding, looked up in two tiers.

A text falls into pre-tokens (the public pattern's matches, found for a whole
slice at once by comparing character classes).  Tier one resolves a
pre-token that is a vocabulary entry itself through a minimal perfect hash
of the vocabulary; tier two merges the others with a heap over linked bytes,
each distinct one once per worker.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.spans import Pool, distinct, expand, hashes, slices, text_bytes, worker_state

LETTER, NUMBER, OTHER, BLANK = range(4)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def character_classes() -> np.ndarray:
    """Class of every code point as the tiktoken library's regular expressions
    see it (its Unicode tables, asked through the library)."""
    import tiktoken

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    table = np.full(0x110000, OTHER, np.uint8)
    single = {bytes([i]): i for i in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = bytes(probe.encode_ordinary(every)).decode()  # what the pattern doesn't match is left out
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return table


class PerfectHash:
    """Minimal perfect hash by levels of bit arrays (Limasset et al. 2017).

    A level places the keys that fall alone on a bit; the others go to the
    next.  A key's number is the count of bits set before its own, so the
    numbers are 0 to n - 1 without gaps.
    """

    def __init__(self, one: np.ndarray, two: np.ndarray, gamma: float = 2.0):
        left = np.arange(len(one))
        self.bits: list[np.ndarray] = []
        self.before: list[np.ndarray] = []
        placed = 0
        while len(left):
            size = max(64, int(gamma * len(left)))
            at = self._at(one[left], two[left], len(self.bits), size)
            alone = np.bincount(at, minlength=size) == 1
            self.bits.append(alone)
            self.before.append(placed + np.cumsum(alone) - alone)
            placed += int(alone.sum())
            left = left[~alone[at]]
            if len(self.bits) > 200:
                raise ValueError("equal keys")

    @staticmethod
    def _at(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
        h = (one + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) * two)
        h ^= h >> np.uint64(31)
        return (h % np.uint64(size)).astype(np.int64)

    def numbers(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Each key's number; any number or -1 for what isn't a key."""
        out = np.full(len(one), -1, np.int64)
        left = np.arange(len(one))
        for level, (bits, before) in enumerate(zip(self.bits, self.before, strict=True)):
            at = self._at(one[left], two[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = before[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank merges first, leftmost on
    a tie.  Parts are linked by their ends; the heap holds candidate pairs,
    and one whose parts have changed since is skipped."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0 once merged away
    back = list(range(-1, n))    # start of the part before the one that begins here
    heap = []
    get = ranks.get
    for i in range(n - 1):
        r = get(piece[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, e = pop(heap)
        j = end[i]
        if not j or j >= n or end[j] != e:
            continue
        end[i], end[j] = e, 0
        if e < n:
            back[e] = i
            after = end[e]
            r = get(piece[i:after])
            if r is not None:
                push(heap, (r, i, after))
        b = back[i]
        if b >= 0:
            r = get(piece[b:e])
            if r is not None:
                push(heap, (r, b, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


@dataclass
class Vocabulary:
    """A byte-level vocabulary laid out for lookups; of a size its file fixes."""

    ranks: dict[bytes, int]
    classes: np.ndarray

    def __post_init__(self):
        keys = list(self.ranks)
        self.key_size = np.fromiter(map(len, keys), np.int64, len(keys))
        flat = np.frombuffer(b"".join(keys), np.uint8)
        start = np.cumsum(self.key_size) - self.key_size
        one, two = hashes(flat, start, self.key_size)
        self.hash = PerfectHash(one, two)
        number = self.hash.numbers(one, two)
        rank = np.fromiter(self.ranks.values(), np.int64, len(keys))
        self.one, self.two, self.rank = (np.empty_like(x) for x in (one, two, rank))
        self.one[number], self.two[number], self.rank[number] = one, two, rank
        # bytes and decimal digits of every id, for decoding and digests
        top = int(rank.max()) + 1
        self.size, self.start, self.flat = np.zeros(top, np.int64), np.zeros(top, np.int64), flat
        self.size[rank], self.start[rank] = self.key_size, start
        digits = [b"%d " % i for i in range(top)]
        self.digit_size = np.fromiter(map(len, digits), np.int64, top)
        self.digit_start = np.cumsum(self.digit_size) - self.digit_size
        self.digits = np.frombuffer(b"".join(digits), np.uint8)

    def whole(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Tier one: the id of every span that is an entry, -1 for others."""
        number = self.hash.numbers(one, two)
        at = np.maximum(number, 0)
        known = (number >= 0) & (self.one[at] == one) & (self.two[at] == two)
        return np.where(known, self.rank[at], -1)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids."""
        ids = np.asarray(ids, np.int64)
        return self.flat[expand(self.start[ids], self.size[ids])].tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers with one space between."""
        ids = np.asarray(ids, np.int64)
        return self.digits[expand(self.digit_start[ids], self.digit_size[ids])].tobytes()[:-1]


def pre_tokens(points: np.ndarray, classes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """First code point of every pre-token of consecutive texts that begin at
    ``heads`` -- what the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^sLN]+|s+(?!S)|s+`` matches in turn.

    A run of one class begins a pre-token; a space right before it joins it;
    a run of white space before something else gives up its last character;
    a contraction takes its letters from the run after its apostrophe.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[points]
    head = np.zeros(n, bool)
    head[heads[heads < n]] = True
    run = head.copy()
    run[0] = True
    run[1:] |= kind[1:] != kind[:-1]
    joins = np.zeros(n, bool)  # follows white space in the same text
    joins[1:] = run[1:] & ~head[1:] & (kind[:-1] == BLANK)
    begin = run.copy()
    begin[1:] &= ~(joins[1:] & (points[:-1] == 0x20))
    begin[:-1] |= joins[1:]
    mark = np.flatnonzero((points == 0x27) & begin)
    mark = mark[mark + 1 < n]
    mark = mark[~head[mark + 1]]
    if len(mark):
        a = points[mark + 1]
        last = np.minimum(mark + 2, n - 1)
        b = np.where((mark + 2 < n) & ~head[last], points[last], 0)
        short = (a == 0x73) | (a == 0x74) | (a == 0x6D) | (a == 0x64)
        long = ((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C)
        hit, size = mark[short | long], np.where(short, 2, 3)[short | long]
        begin[hit + 1] = False
        after = hit + size
        after, hit = after[after < n], hit[after < n]
        begin[after[~head[after] & (kind[after] == LETTER)]] = True
    return np.flatnonzero(begin)


class Coder:
    """Encodes columns of texts; one per worker process."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pool = Pool()

    def _tokens(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """``(raw, start, length, part)`` of the pre-tokens of consecutive parts."""
        lo, hi = int(starts[0]), int(ends[-1])
        piece = raw[lo:hi]
        starts, ends = starts - lo, ends - lo
        if (piece < 0x80).all():
            points, place = piece, None
        else:
            try:
                text = piece.tobytes().decode()
            except UnicodeDecodeError:  # broken text: what can't be read becomes U+FFFD, text by text
                fixed = [piece[s:e].tobytes().decode("utf-8", "replace").encode() for s, e in zip(starts, ends, strict=True)]
                piece = np.frombuffer(b"".join(fixed), np.uint8)
                ends = np.cumsum([len(x) for x in fixed])
                starts = ends - np.array([len(x) for x in fixed])
                text = piece.tobytes().decode()
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            place = np.flatnonzero((piece & 0xC0) != 0x80)
        heads = starts if place is None else np.searchsorted(place, starts)
        begin = pre_tokens(points, self.vocabulary.classes, heads)
        start = begin if place is None else place[begin]
        length = np.diff(start, append=len(piece))
        part = np.searchsorted(ends, start, side="right")
        return piece, start, length, part

    def batches(self, column: pa.Array, target: int = 1 << 21):
        """``(rows, ids, counts)`` a slice, as :meth:`quarry.llm.tokens.WordIds.batches`."""
        v = self.vocabulary
        raw, offsets = text_bytes(column)
        for rows, starts, ends in slices(raw, offsets, target):
            if ends[-1] <= starts[0]:
                yield rows, np.zeros(0, np.int64), np.zeros(len(rows), np.int64)
                continue
            piece, start, length, part = self._tokens(raw, starts, ends)
            one, two = hashes(piece, start, length)
            first, code = distinct(one, two)
            ids = v.whole(one[first], two[first])
            missed = ids < 0
            size = np.ones(len(first), np.int64)
            where = np.arange(len(first))
            if missed.any():
                some = np.flatnonzero(missed)
                got, counts = self.pool.ids_of(piece, start[first[some]], length[first[some]], self._merged)
                where[some] = len(ids) + np.cumsum(counts) - counts
                size[some] = counts
                ids = np.concatenate([ids, got.astype(np.int64)])
            counts = size[code]
            out = ids[expand(where[code], counts)]
            yield rows, out, np.bincount(part, weights=counts, minlength=len(rows)).astype(np.int64)

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ranks = self.vocabulary.ranks
        lists = [merge(p, ranks) for p in pieces]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((x for one in lists for x in one), np.uint32, int(size.sum())), size


def vocabulary(path: str | None = None) -> Vocabulary:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return Vocabulary(read_ranks(path), character_classes())


def bpe_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                path: str | None = None) -> DataFrame:
    """Every text encoded and decoded: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``.

    Null texts are empty; an empty text has no ids and the digests of the
    empty string; rows pass one by one, so repeated rows, ties and null ids
    change nothing; extra columns are ignored.  A text is encoded in slices
    and its digests grow slice by slice, so a long one is never held as a
    list.  The vocabulary (a file of fixed size) is broadcast once.
    """
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(vocabulary(path))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    key = f"bpe:{path}"

    def encode(batches):
        coder = worker_state(key, lambda: Coder(tables.value))
        v = coder.vocabulary
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            count = np.zeros(n, np.int64)
            id_hash: list = [None] * n
            text_hash: list = [None] * n
            held: dict[int, tuple] = {}
            for rows, ids, per in coder.batches(batch.column(1)):
                bounds = np.concatenate([[0], np.cumsum(per)])
                sizes = v.size[ids]
                text = v.flat[expand(v.start[ids], sizes)].tobytes()
                at = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
                digit_sizes = v.digit_size[ids]
                digits = v.digits[expand(v.digit_start[ids], digit_sizes)].tobytes()
                put = np.concatenate([[0], np.cumsum(digit_sizes)])[bounds].tolist()
                per_list = per.tolist()
                for k, row in enumerate(rows.tolist()):
                    a, b = held.get(row) or held.setdefault(row, (hashlib.sha256(), hashlib.sha256()))
                    if per_list[k]:
                        if count[row]:
                            a.update(b" ")
                        a.update(digits[put[k]:put[k + 1] - 1])
                        b.update(text[at[k]:at[k + 1]])
                        count[row] += per_list[k]
                last = int(rows[-1])  # may go on in the next slice
                for row in [r for r in held if r < last]:
                    a, b = held.pop(row)
                    id_hash[row], text_hash[row] = a.hexdigest(), b.hexdigest()
            for row, (a, b) in held.items():
                id_hash[row], text_hash[row] = a.hexdigest(), b.hexdigest()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.array(id_hash, pa.string()),
                                              pa.array(text_hash, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
