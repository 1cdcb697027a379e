"""Importance resampling of documents towards a target distribution.

Hashed n-gram features (Xie et al., "Data selection for language models via
importance resampling", NeurIPS 2023): words and pairs of neighbouring words
fall into buckets by the CRC-32 of their text; a bucket's gain is the
logarithm of its share in the target texts over its share in the documents,
a document's weight the mean gain of its features, and Gumbel noise by id
draws documents in proportion to their weights.

Features are hashed in two tiers.  Head: frequent words are broadcast with
their exact bytes and the CRC states of the word and of the word with a blank
after it, frequent pairs of head words with their buckets; a feature found
there is hashed by a look-up.  Tail: all others take a CRC over their bytes,
a pair by continuing its first word's state: appending ``n`` bytes is linear
in the state, so four table look-ups join two words' sums.  Both tiers give
the same sums, so bucket totals are exact whatever the head holds; the head
is chosen from counts over all documents.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder
from quarry.llm.terms import scattered, short_keys, word_runs
from quarry.operators.common import ranked

_ONES = np.uint32(0xFFFFFFFF)
_BYTE = np.uint32(0xFF)
#: Words up to this length are joined by table; longer ones are read by zlib.
_WIDE = 64


def _crc_table() -> np.ndarray:
    """CRC-32 (reflected polynomial 0xEDB88320) of every byte value."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_T = _crc_table()


def _append_tables() -> np.ndarray:
    """``[n, k, v]``: what byte ``k`` of a sum, holding ``v``, becomes when ``n`` zero bytes follow."""
    z = np.zeros((_WIDE + 1, 4, 256), np.uint32)
    for k in range(4):
        z[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, _WIDE + 1):
        z[n] = _T[z[n - 1] & _BYTE] ^ (z[n - 1] >> np.uint32(8))
    return z


_Z = _append_tables()


def crc_of(piece: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of every span's bytes, a byte of all spans a step."""
    out = np.empty(len(start), np.uint32)
    for i in np.flatnonzero(length > _WIDE).tolist():
        out[i] = zlib.crc32(piece[start[i]:start[i] + length[i]])
    short = np.flatnonzero(length <= _WIDE)
    order = short[np.argsort(-length[short], kind="stable")]
    at, size = start[order], length[order]
    crc = np.full(len(order), _ONES)
    ends = np.searchsorted(-size, -np.arange(1, _WIDE + 1), side="right")  # spans that have a j-th byte
    for j in range(int(size[0]) if len(size) else 0):
        n = ends[j]
        c = crc[:n]
        crc[:n] = _T[(c ^ piece[at[:n] + j]) & _BYTE] ^ (c >> np.uint32(8))
    out[order] = crc ^ _ONES
    return out


def after_blank(crc: np.ndarray) -> np.ndarray:
    """The sums of the same texts with a blank after them."""
    c = crc ^ _ONES
    return (_T[(c ^ np.uint32(0x20)) & _BYTE] ^ (c >> np.uint32(8))) ^ _ONES


def joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums of two texts one after the other, from their own sums and the
    second's length (at most 64)."""
    out = second.copy()
    for k in range(4):
        out ^= _Z[length, k, (first >> np.uint32(8 * k)) & _BYTE]
    return out


@dataclass
class Head:
    """The frequent words and pairs; empty tables make every feature tail.

    ``slots`` places of each table; what falls on a taken place is tail."""

    low: np.ndarray  # a word's bytes, first eight; zero: no word
    high: np.ndarray
    crc: np.ndarray
    blank: np.ndarray
    pair: np.ndarray  # place of the first word * slots + place of the second + 1; zero: none
    bucket: np.ndarray

    @classmethod
    def build(cls, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int, bits: int = 17) -> Head:
        size = 1 << bits
        u64, u32 = (lambda: np.zeros(size, np.uint64)), (lambda: np.zeros(size, np.uint32))
        head = cls(u64(), u64(), u32(), u32(), u64(), u32())
        place: dict[bytes, int] = {}
        for w in words:
            lo, hi = np.frombuffer(w.ljust(16, b"\0"), "<u8")
            at = int(head.place(lo[None], hi[None])[0])
            if not head.low[at]:
                head.low[at], head.high[at], place[w] = lo, hi, at
                head.crc[at], head.blank[at] = zlib.crc32(w), zlib.crc32(w + b" ")
        for a, b in pairs:
            if a in place and b in place:
                key = np.array([place[a] * size + place[b] + 1], np.uint64)
                at = int(head.pair_place(key)[0])
                if not head.pair[at]:
                    head.pair[at], head.bucket[at] = key[0], zlib.crc32(a + b" " + b) % buckets
        return head

    def arrays(self) -> tuple[np.ndarray, ...]:
        """What a broadcast carries: ``Head(*arrays)`` is the head again."""
        return tuple(getattr(self, f.name) for f in fields(self))

    def place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (scattered(np.atleast_1d(low), np.atleast_1d(high)) % np.uint64(len(self.low))).astype(np.int64)

    def pair_place(self, key: np.ndarray) -> np.ndarray:
        return (scattered(key, key) % np.uint64(len(self.pair))).astype(np.int64)


def features(column, head: Head, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, words, place, bucket)`` a slice: the number of words of every
    text (part), and for each feature the text (an index into ``rows``) and
    its bucket.  A pair over the border of two parts of a text comes with the second."""
    carry = None  # (row, sum of its last word with a blank, that word's place in the head)
    size = np.uint64(len(head.low))
    for rows, piece, start, length, part in word_runs(column):
        words = np.bincount(part, minlength=len(rows))
        if len(start):
            low, high = short_keys(piece, start, length)
            at = head.place(low, high)
            known = (head.low[at] == low) & (head.high[at] == high) & (length <= 16)
            crc, blank = head.crc[at], head.blank[at]
            tail = np.flatnonzero(~known)
            crc[tail] = crc_of(piece, start[tail], length[tail])
            blank[tail] = after_blank(crc[tail])
            place, found = [part], [crc % np.uint32(buckets)]
            # neighbouring words of one text; the first word's side may be carried over
            one = np.flatnonzero(part[1:] == part[:-1])
            ones, heads, both = blank[one], at[one], one + 1
            ok = known[one] & known[both]
            if carry and carry[0] == rows[0] and words[0]:
                ones, both = np.append(ones, carry[1]), np.append(both, 0)
                heads, ok = np.append(heads, max(carry[2], 0)), np.append(ok, carry[2] >= 0 and known[0])
            key = heads.astype(np.uint64) * size + at[both].astype(np.uint64) + np.uint64(1)
            slot = head.pair_place(key)
            held = ok & (head.pair[slot] == key)
            bucket = head.bucket[slot]
            rest = np.flatnonzero(~held)
            wide = length[both[rest]] > _WIDE
            near, far = rest[~wide], rest[wide]
            bucket[near] = joined(ones[near], crc[both[near]], length[both[near]]) % np.uint32(buckets)
            for i in far.tolist():
                s = start[both[i]]
                bucket[i] = zlib.crc32(piece[s:s + length[both[i]]], int(ones[i])) % buckets
            place.append(part[both]), found.append(bucket)
            yield rows, words, np.concatenate(place), np.concatenate(found).astype(np.int64)
            if part[-1] == len(rows) - 1:
                carry = int(rows[-1]), blank[-1], int(at[-1]) if known[-1] else -1
            elif not (carry and carry[0] == rows[-1]):
                carry = None
        else:
            yield rows, words, np.zeros(0, np.int64), np.zeros(0, np.int64)
            if not (carry and carry[0] == rows[-1]):
                carry = None


def _frequent(per_slice: int):
    """Every slice's most frequent words (``c``, ``d`` null) and pairs of words
    up to 16 bytes, as the numbers of :func:`short_keys`, with their counts."""
    schema = pa.schema([(x, pa.int64()) for x in ("a", "b", "c", "d", "n")])

    def top(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, first, n = np.unique(h, return_index=True, return_counts=True)
        keep = np.argsort(-n, kind="stable")[:per_slice]
        keep = keep[n[keep] > 1]
        return first[keep], n[keep]

    def scan(batches):
        for batch in batches:
            for _, piece, start, length, part in word_runs(batch.column(0)):
                low, high = short_keys(piece, start, length)
                short = length <= 16
                h = scattered(low, high)
                some = np.flatnonzero(short)
                i, n = top(h[some])
                words = some[i]
                two = np.flatnonzero((part[1:] == part[:-1]) & short[1:] & short[:-1])
                j, m = top(scattered(h[two], h[two + 1]))
                pairs = two[j]
                single = np.arange(len(words) + len(pairs)) < len(words)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([low[words], low[pairs]]).view(np.int64)),
                    pa.array(np.concatenate([high[words], high[pairs]]).view(np.int64)),
                    pa.array(np.concatenate([low[words], low[pairs + 1]]).view(np.int64), mask=single),
                    pa.array(np.concatenate([high[words], high[pairs + 1]]).view(np.int64), mask=single),
                    pa.array(np.concatenate([n, m]).astype(np.int64))], schema=schema)
    return scan


def frequent_head(texts: DataFrame, work: WorkFolder, buckets: int, words: int = 16_384, pairs: int = 32_768,
                  per_slice: int = 2_048) -> Head:
    """The head for :func:`features`, from all of ``texts`` (one column): every
    slice names its most frequent words and pairs, and those with the largest
    sums are taken.  At most ``words`` and ``pairs`` of 16 and 32 bytes reach
    the driver; the choice moves work between the tiers and no result."""
    counts = work.save(texts.mapInArrow(_frequent(per_slice), "a long, b long, c long, d long, n long")
                       .groupBy("a", "b", "c", "d").agg(F.sum("n").alias("n")), "frequent")
    order = [F.col("n").desc(), "a", "b", "c", "d"]

    def word(lo: int, hi: int) -> bytes:
        return np.array([lo, hi], np.int64).tobytes().rstrip(b"\0")

    few = counts.filter(F.col("c").isNull()).orderBy(*order).limit(words) \
        .unionAll(counts.filter(F.col("c").isNotNull()).orderBy(*order).limit(pairs)).collect()
    few.sort(key=lambda r: -r["n"])
    return Head.build([word(r["a"], r["b"]) for r in few if r["c"] is None],
                      [(word(r["a"], r["b"]), word(r["c"], r["d"])) for r in few if r["c"] is not None], buckets)


def bucket_totals(texts: DataFrame, head, buckets: int) -> np.ndarray:
    """How many features of ``texts`` (one column) fall into every bucket; a
    task adds up its own, so ``buckets`` rows a task are shuffled."""
    def scan(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in features(batch.column(0), Head(*head.value), buckets):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(scan, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of every bucket's smoothed share in the target over that in the source."""
    k = float(len(source))
    s, t = float(source.sum()) + k, float(target.sum()) + k
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t)))
                     for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighed(docs: DataFrame, head, gain, buckets: int) -> DataFrame:
    """``(doc_id, words, n_features, weight)`` of ``docs`` (id, text)."""
    def scan(batches):
        worth = gain.value
        for batch in batches:
            words, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for rows, n, place, found in features(batch.column(1), Head(*head.value), buckets):
                words[rows] += n
                # sums of a slice stay far below 2**53, where doubles are exact
                total[rows] += np.bincount(place, weights=worth[found], minlength=len(rows)).astype(np.int64)
            count = np.where(words > 0, 2 * words - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(count), pa.array(total // np.maximum(count, 1))],
                ["doc_id", "words", "n_features", "weight"])

    return docs.mapInArrow(scan, "doc_id long, words long, n_features long, weight long")


def importance_resample(docs: DataFrame, target: DataFrame, work: WorkFolder, id_col: str = "doc_id",
                        text_col: str = "text", target_col: str = "text", percent: int = 25, min_words: int = 20,
                        buckets: int = 10_000, seed: str = "7", head: Head | None = None) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs``.

    Words are runs of digits, letters and non-ASCII characters, A-Z
    lower-cased; features are words and pairs of neighbouring words, repeats
    counted.  ``score`` adds the noise ``-1000 ln(-ln u)``, where ``u`` comes
    from the SHA-256 of ``<seed>:<id>``.  Of the rows with ``min_words`` words,
    ``percent`` of a hundred (rounded down) are drawn: ``rank`` counts them
    from the highest score, ties to the smaller id; it is null for the others.

    Null and empty texts have no features and weight 0.  Rows are documents of
    their own, also if they repeat an id (equal rows score alike); a null id is
    hashed as an empty text and stands after others of its score.  Extra
    columns are ignored; without rows there is no result row; an empty target
    leaves every bucket its smoothing.  ``head`` replaces the counted one.
    """
    spark, work = docs.sparkSession, work.scope()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    texts, wanted = rows.select("text"), target.select(F.col(f"`{target_col}`").alias("text"))
    held = spark.sparkContext.broadcast((head or frequent_head(texts, work, buckets)).arrays())
    gain = spark.sparkContext.broadcast(
        gains(bucket_totals(texts, held, buckets), bucket_totals(wanted, held, buckets)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    scored = work.save(weighed(rows, held, gain, buckets).withColumn(
        "score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")), "scored")

    # how many of the long enough rows have each score: at most some hundred thousand
    # different scores, because logarithms of 64-bit counts bound gains and noise
    can = F.col("words") >= min_words
    levels = {r["score"]: r["n"] for r in scored.filter(can).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = percent * sum(levels.values()) // 100
    cut, above = None, 0
    for score in sorted(levels, reverse=True):
        if above >= drawn:
            break
        cut, above = score, above + levels[score]
    out = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    high = can & (F.col("score") >= cut)
    # the last key only deals out rows that share an id and score
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_u")]
    top = ranked(scored.filter(high).select(*out, F.monotonically_increasing_id().alias("_u")), order, work)
    return top.select(*out, F.when(F.col("rank") < drawn, F.col("rank") + 1).alias("rank")) \
        .unionAll(scored.filter(~high).select(*out, F.lit(None).cast("long").alias("rank")))
