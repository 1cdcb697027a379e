"""N-gram Jaccard join: near duplicates by word shingles, with prefix filtering.

Texts with equal shingle sets are one class.  Every class lists its rarest
shingles (by a corpus-wide frequency sketch; any order common to all is
right, rare first is short) as its prefix: two sets that reach the threshold
share a shingle of both prefixes (Chaudhuri, Ganti, Kaushik, ICDE 2006).
Pairs from a shared prefix shingle pass length, positional (Xiao et al., WWW
2008) and suffix filters and are verified on the sets, once a pair.

The suffix filter is a parity sketch: a bit for every bucket of the hash range,
set if an odd number of a set's shingles falls into it.  What two sets share
cancels in the exclusive or of their sketches, and every shingle of the
symmetric difference turns one bit at most, so the number of bits left never
exceeds the size of the difference: a pair with more than the threshold allows
is no link, and a pair just under it is told apart almost exactly.  The filter
is a few machine words in the condition of the join that makes the pairs.

Only reachability is asked for, so not every pair of a dense group is made:
first the classes listed under a shingle meet a few leaders of the list, in two
rounds, the second only for what the first left apart; then every pair that
the filters allow and that is not yet connected is verified.  Pairs left out
are connected already, so no component changes -- a group of m near copies
costs some m verifications.
"""

from __future__ import annotations

import functools
import hashlib
import math
import operator
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder, components
from quarry.llm.spans import hashes, slices, text_bytes, tidy, whole_rows, words

_FACTOR = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                                  0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                                  0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_SLICES = 16  # parts of the sketch, added up by different tasks
#: ASCII upper case to lower case, every other byte to itself.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _word_parts(column, target: int = 1 << 21):
    raw, offsets = text_bytes(column)
    for rows, starts, ends in slices(raw, offsets, target):
        lo = int(starts[0])
        piece = _LOWER[raw[lo:int(ends[-1])]]
        start, length, part = words(piece, starts - lo, ends - lo)
        one, _ = hashes(piece, start, length)
        yield rows, one, np.bincount(part, minlength=len(rows)).astype(np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def shingle_sets(column, k: int = 5):
    """``(row, sorted distinct 64-bit shingle hashes)`` of every text of a
    column.  Shorter texts have one shingle of all their words; texts without
    words an empty set.  Different shingles of a corpus share a hash with
    probability of about 2**-64 a pair."""
    for rows, one, counts in whole_rows(_word_parts(column)):
        ends = np.cumsum(counts)
        n = len(one)
        if n >= k:
            total = np.full(n - k + 1, np.uint64(k))
            for j in range(k):
                total += one[j:n - k + 1 + j] * _FACTOR[j]
            total = _mix(total)
        for row, end, count in zip(rows.tolist(), ends.tolist(), counts.tolist(), strict=True):
            if count >= k:
                s = np.sort(total[end - count:end - k + 1])
                yield row, s[np.concatenate([[True], s[1:] != s[:-1]])]
            elif count:
                few = np.array([count], np.uint64)
                for j in range(count):
                        few += one[end - count + j:end - count + j + 1] * _FACTOR[j]
                yield row, _mix(few)
            else:
                yield row, np.zeros(0, np.uint64)


def need_of(n, percent: int):
    """Smallest overlap that a set of ``n`` needs with any partner: ceil(n * t)."""
    return (n * percent + 99) // 100


#: Sets up to this size are told apart by a sketch of 512 bits; larger ones by as many bits as they have shingles.
_SMALL = 700
_BITS = 9
_WORDS = (1 << _BITS) // 64
#: Lists of more classes carry the sketches into the join that pairs them.
_DENSE = 64


def parity(s: np.ndarray, bits: int) -> np.ndarray:
    """For every one of ``2**bits`` equal hash ranges whether it holds an odd
    number of a set's shingles, packed into 64-bit words."""
    odd = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8) & 1
    return np.packbits(odd).view("<i8")


def level(n: int) -> int:
    """Bits of the large sketch of ``n`` shingles; sets of similar size differ by one at most."""
    return math.ceil(math.log2(n))


def sketches(s: np.ndarray) -> tuple[list[int], list[int] | None, list[int] | None]:
    """The small sketch, and for large sets those of their own level and the next."""
    if len(s) <= _SMALL:
        return parity(s, _BITS).tolist(), None, None
    return parity(s, _BITS).tolist(), parity(s, level(len(s))).tolist(), parity(s, level(len(s)) + 1).tolist()


_SKETCH = "p array<long>, w array<long>, v array<long>"


def _describe(k: int, bits: int):
    """Rows ``(doc_id, th, n, cls, p, w, v)``, and the partition's frequency
    counters at the end (doc rows have ``slice`` null; counter rows their slice)."""
    def scan(batches):
        from pyspark import TaskContext

        total = np.zeros(1 << bits, np.int32)
        longs = pa.list_(pa.int64())
        schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()),
                            ("p", longs), ("w", longs), ("v", longs), ("sig", pa.binary()), ("slice", pa.int32()),
                            ("task", pa.int32())])
        for b in (x.slice(i, 1024) for x in batches for i in range(0, x.num_rows, 1024)):
            n, cls, made = [], [], []
            for _, s in shingle_sets(b.column(2), k):
                n.append(len(s))
                cls.append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                           if len(s) else None)
                made.append(sketches(s))
                np.add.at(total, (s >> np.uint64(64 - bits)).astype(np.int64), 1)
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                 *[pa.array([m[i] for m in made], longs) for i in range(3)], pa.nulls(size, pa.binary()),
                 pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32())], schema=schema)
        cut = np.split(total, _SLICES)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(_SLICES, pa.int64())] * 4, *[pa.nulls(_SLICES, longs)] * 3,
             pa.array([_packed(p) for p in cut], pa.binary()), pa.array(range(_SLICES), pa.int32()),
             pa.array([TaskContext.get().partitionId()] * _SLICES, pa.int32())], schema=schema)
    return tidy(scan)


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = 0
    for s in pdf["sig"]:
        total = total + np.frombuffer(zlib.decompress(s), "<i8")
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "task": pdf["task"].iloc[:1], "sig": [_packed(total)]})


def frequency_sketch(described: DataFrame) -> np.ndarray:
    """The counters of all partitions added up, 256 a step; a fixed number of
    counters reaches the driver."""
    parts = described.filter(F.col("slice").isNotNull()).select("slice", "task", "sig")
    few = parts.groupBy("slice", F.floor(F.col("task") / 256).alias("_g")) \
        .applyInPandas(_added, "slice int, task int, sig binary")
    rows = few.groupBy("slice").applyInPandas(_added, "slice int, task int, sig binary").collect()
    got = {r["slice"]: np.frombuffer(zlib.decompress(r["sig"]), "<i8") for r in rows}
    if not got:  # no partition at all
        return np.zeros(1, np.int32)
    total = np.concatenate([got[i] for i in sorted(got)])
    return np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)


def _prefixes(k: int, percent: int, bits: int, sketch):
    """Postings ``(h, cls, n, pos)`` of every class's prefix, rarest first; a
    class that a partition holds twice is listed once there."""
    def scan(batches):
        counts = sketch.value
        done: set[bytes] = set()
        for b in batches:
            h, cls, n, pos = [], [], [], []
            for _, s in shingle_sets(b.column(0), k):
                if not len(s):
                    continue
                key = hashlib.blake2b(s.tobytes(), digest_size=8).digest()
                if key in done:
                    continue
                done.add(key)
                p = len(s) - need_of(len(s), percent) + 1
                rare = np.argsort(counts[(s >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")[:p]
                h.append(s[rare])
                cls.append(np.full(p, int.from_bytes(key, "little", signed=True), np.int64))
                n.append(np.full(p, len(s), np.int32))
                pos.append(np.arange(p, dtype=np.int32))
            if h:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(cls)),
                     pa.array(np.concatenate(n)), pa.array(np.concatenate(pos))], ["h", "cls", "n", "pos"])
    return tidy(scan)


def _allowed(percent: int):
    """Length and positional filter for postings a and b of one shingle: the
    sizes fit, and what is left after the shared place can still reach the
    overlap ``t / (1 + t) * (n_a + n_b)``."""
    na, nb = F.col("a.n"), F.col("b.n")
    left = F.least(na - F.col("a.pos"), nb - F.col("b.pos"))
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (left * (100 + percent) >= (na + nb) * percent)


def _unlike(x: list, y: list):
    """Bits in which two small sketches differ."""
    return functools.reduce(operator.add, [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(x, y, strict=True)])


def _sketches_allow(percent: int, a: str = "a", b: str = "b"):
    """Whether the sketches of classes ``a`` and ``b`` leave a link possible:
    ``|x| + |y|`` shingles reach the threshold with a symmetric difference of
    ``(100 - percent) / (100 + percent)`` of them at most."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    small = _unlike([f"{a}.p{i}" for i in range(_WORDS)], [f"{b}.p{i}" for i in range(_WORDS)])

    def large(x: str, y: str):
        each = F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v)))
        return F.aggregate(each, F.lit(0), lambda t, u: t + u) * (100 + percent) <= n * (100 - percent)
    la, lb = F.size(f"{a}.w"), F.size(f"{b}.w")
    wide = F.col(f"{a}.w").isNotNull() & F.col(f"{b}.w").isNotNull()
    return (small * (100 + percent) <= n * (100 - percent)) & (~wide | F.when(la == lb, large(f"{a}.w", f"{b}.w")).when(
        la < lb, large(f"{a}.v", f"{b}.w")).otherwise(large(f"{a}.w", f"{b}.v")))


def _sketch_columns() -> list:
    return [*[F.col("p")[i].alias(f"p{i}") for i in range(_WORDS)], "w", "v"]


def _leaders(rows: DataFrame, by: list[str], orders: range) -> DataFrame:
    """Up to one class of every group for each of ``orders``, which all groups
    share, so that groups with common members lead to common leaders."""
    first = [F.min(F.struct(F.xxhash64("cls", F.lit(i)), "cls", "n", "pos")) for i in orders]
    heads = rows.groupBy(*by).agg(F.array(*first).alias("x"))
    some = F.array_distinct(F.transform("x", lambda v: F.struct(
        v["cls"].alias("cls"), v["n"].alias("n"), v["pos"].alias("pos"))))
    return heads.select(*by, F.explode(some).alias("e")).select(*by, "e.cls", "e.n", "e.pos")


def _sets(k: int):
    """``(cls, s)``: the sorted shingle hashes of every text of ``(cls, text)``."""
    def scan(batches):
        for b in (x.slice(i, 256) for x in batches for i in range(0, x.num_rows, 256)):
            made = [pa.array(s.view(np.int64)) for _, s in shingle_sets(b.column(1), k)]
            offsets = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(made))], ["cls", "s"])
    return tidy(scan)


def near_duplicates(docs: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80, sketch_bits: int = 22, leaders: int = 6,
                    broadcast_rows: int = 2_000_000) -> DataFrame:
    """``(doc_id, n_shingles, component_id, text_hash, component)`` for every row.

    Words are what stands between ASCII white space, A-Z lower-cased; a set
    holds the distinct ``k``-word shingles (all words as one if there are
    fewer).  Texts link when ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest id reachable.  Null texts and texts
    without words have no shingles and link with nothing.  Repeated rows are
    copies of each other; rows with a null id link like others, and a
    component of such rows only has a null ``component_id``.  Extra columns
    are ignored; an empty table gives no rows.  ``text_hash`` tells rows of
    one id apart; ``component`` is a key of the component (null without words).
    """
    spark, work = docs.sparkSession, work.scope()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")) \
        .select("doc_id", F.xxhash64("text").alias("th"), "text")
    described = work.save(rows.mapInArrow(
        _describe(k, sketch_bits), f"doc_id long, th long, n long, cls long, {_SKETCH}, sig binary, slice int, task int"),
        "described")
    sketch = spark.sparkContext.broadcast(frequency_sketch(described))
    listed = described.filter(F.col("slice").isNull()).select("doc_id", "th", "n", "cls")
    # one row a class: a row that has it (the smallest id), size and sketches
    classes = work.save(described.filter(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("at"),
        F.first("n").alias("n"), *[F.first(c).alias(c) for c in ("p", "w", "v")])
        .select("cls", "rep", "at", "n", *_sketch_columns()), "classes")
    sketched = classes.drop("rep", "at")

    postings = work.save(rows.select("text").mapInArrow(
        _prefixes(k, percent, sketch_bits, sketch), "h long, cls long, n int, pos int"), "postings")
    several = postings.groupBy("h").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")) \
        .filter(F.col("lo") < F.col("hi")).select("h")
    shared = work.save(postings.join(several, "h", "left_semi").distinct(), "shared")
    work.drop(postings)

    def verified(pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b) whose sets reach the threshold; both sets' hashes
        meet in a join, and no text does."""
        if not pairs.head(1):
            return pairs
        used = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        reps = work.save(used.join(classes, "cls").select("cls", F.col("at.doc_id").alias("at"), F.col("at.th").alias("ah")),
                         "used")
        # the ids of texts that are compared; broadcast only while they are few, else both sides are shuffled
        few = F.broadcast(reps) if reps.count() <= broadcast_rows else reps
        sets = work.save(rows.join(few, F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("th") == F.col("ah")))
                         .select("cls", "text").mapInArrow(_sets(k), "cls long, s array<long>")
                         .dropDuplicates(["cls"]), "sets")
        both = pairs.join(sets.toDF("b", "sb"), "b").join(sets.toDF("a", "sa"), "a")
        same, n = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
        out = work.save(both.filter(same * (100 + percent) >= n * percent).select("a", "b"), "links")
        work.drop(sets)
        work.drop(reps)
        return out

    def likely(pairs: DataFrame, done: DataFrame | None) -> DataFrame:
        """New pairs (a, b) that the sketches allow, each once."""
        new = pairs.distinct() if done is None else pairs.distinct().join(done, ["a", "b"], "left_anti")
        x, y = new.alias("x"), sketched
        met = x.join(y.alias("l"), F.col("x.a") == F.col("l.cls")).join(y.alias("r"), F.col("x.b") == F.col("r.cls"))
        return work.save(met.filter(_sketches_allow(percent, "l", "r")).select("a", "b"), "pairs")

    def ordered(joined: DataFrame) -> DataFrame:
        return joined.select(F.least("a.cls", "b.cls").alias("a"), F.greatest("a.cls", "b.cls").alias("b"))

    def mixed_lists(lists: DataFrame, part: DataFrame) -> DataFrame:
        """Listings under shingles that still hold several components, with
        their list's ``size``; ``big`` tells members of its largest component."""
        known = lists.join(part.withColumnRenamed("node", "cls"), "cls", "left") \
            .select("h", "cls", "n", "pos", F.coalesce("component", "cls").alias("c"))
        sizes = known.groupBy("h", "c").agg(F.count(F.lit(1)).alias("m"))
        mixed = sizes.groupBy("h").agg(F.count(F.lit(1)).alias("cs"), F.max(F.struct("m", "c")).alias("x"),
                                       F.sum("m").alias("size")) \
            .filter(F.col("cs") > 1).select("h", F.col("x.c").alias("major"), "size")
        return work.save(known.join(mixed, "h").select("h", "cls", "n", "pos", "c", "size",
                                                       (F.col("c") == F.col("major")).alias("big")), "mixed")

    # 1. every listed class against a leader of its list and size range
    ranged = shared.withColumn("r", F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent)))
    heads = _leaders(ranged, ["h", "r"], range(1))
    met = ranged.alias("b").join(heads.alias("a"), ["h", "r"]).filter((F.col("a.cls") != F.col("b.cls")) & _allowed(percent))
    done = likely(ordered(met), None)
    links = verified(done)
    part = work.save(components(links, work), "part")

    # 2. in long lists: what is not in the list's largest component yet, against more leaders of that component
    apart = mixed_lists(shared, part)
    dense = apart.filter(F.col("size") > _DENSE)
    heads = _leaders(dense.filter("big"), ["h"], range(1, 1 + leaders))
    met = dense.filter("not big").alias("b").join(heads.alias("a"), "h").filter(_allowed(percent))
    more = likely(ordered(met), done)
    if more.head(1):
        done = work.save(done.unionAll(more), "done")
        links = work.save(links.unionAll(verified(more)), "links")
        part = work.save(components(links, work), "part")
        last, apart = apart, mixed_lists(apart.select("h", "cls", "n", "pos"), part)
        work.drop(last)

    # 3. every pair not connected yet, but none within one component: the pairs of long lists
    # are told apart by sketches as they are made, those of short ones afterwards
    new = (F.col("a.h") == F.col("b.h")) & (F.col("a.c") != F.col("b.c")) \
        & (F.col("b.big") | (F.col("a.cls") < F.col("b.cls"))) & _allowed(percent)
    short = apart.filter(F.col("size") <= _DENSE)
    few = ordered(short.filter("not big").alias("a").join(short.alias("b"), new))
    full = work.save(apart.filter(F.col("size") > _DENSE).join(sketched.drop("n"), "cls"), "full")
    many = ordered(full.filter("not big").alias("a").join(full.alias("b"), new & _sketches_allow(percent)))
    left = likely(few, done).unionAll(many.distinct().join(done, ["a", "b"], "left_anti")).distinct()
    found = verified(work.save(left, "pairs"))
    work.drop(full)
    if found.head(1):
        links = work.save(links.unionAll(found), "links")
        part = components(links, work)

    ids = classes.join(part.withColumnRenamed("node", "cls"), "cls", "left") \
        .select("cls", "rep", F.coalesce("component", "cls").alias("c"))
    ids = work.save(ids, "ids")
    least = ids.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = work.save(ids.join(least, "c").select("cls", "component_id", F.col("c").alias("component")), "named")
    work.keep(described, named)
    return listed.join(named, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("th").alias("text_hash"), "component")


def drop_near_duplicates(docs: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text",
                         broadcast_rows: int = 2_000_000, **options) -> DataFrame:
    """``docs`` with one row of every component: that of the smallest id (and
    text hash).  Rows without words are in no component and stay; all columns
    stay as they are.

    What goes is listed by id and text hash.  The list is broadcast while it
    has at most ``broadcast_rows`` rows, and joined by a shuffle beyond that.
    """
    inner = work.scope()
    found = work.save(near_duplicates(docs, inner, id_col, text_col, broadcast_rows=broadcast_rows, **options)
                      .filter(F.col("component").isNotNull()).select("doc_id", "text_hash", "component"), "found")
    inner.release()
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    kept = found.groupBy("component").agg(F.min(first).alias("x"), F.count(F.lit(1)).alias("m")).filter(F.col("m") > 1)
    keys = found.join(kept, "component") \
        .groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"), F.first("x").alias("x"))
    stays = F.col("x").eqNullSafe(first)
    # rows to remove, and those kept rows that are there more than once
    out = work.save(keys.filter(~stays | (F.col("rows") > 1)).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"), stays.alias("_twice")), "out")
    work.drop(found)
    listed = F.broadcast(out) if out.count() <= broadcast_rows else out
    th = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    # the row as one value: no column of the input can meet one of the plan
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("id"), th.alias("th"))
    marked = rows.join(listed, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    single = marked.filter(F.col("_th").isNull()).select("row.*")
    twice = marked.filter(F.col("_twice")).dropDuplicates(["_id", "_th"]).select("row.*")
    return single.unionAll(twice)
