"""Ranked lexical search of all documents for a set of items, term partition by term partition.

Documents are read once: a block of them becomes one row with its ids,
lengths and postings (document, term, occurrences) of the items' terms.  Terms
are dealt to owners by the share of documents that hold them, rarest first.
Items travel in bundles through the owners' stages (Moffat, Webber, Zobel,
Baeza-Yates, "A pipelined architecture for distributed text query
evaluation", Information Retrieval 2007): at every stage a bundle's sparse
accumulators of a block meet the owner's postings of that block in a cogroup,
and leave with the owner's integer contributions added.

Between stages an item's k-th best partial score is known over all blocks.
Scores only grow, so an accumulator that stays below it even with the most
that the remaining owners can add is left behind: exact, nothing is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder
from quarry.llm.spans import expand, hashes
from quarry.llm.terms import word_runs

#: A term's factor ``(10^9 tf) div (1000 tf + 12 m)`` stays below this.
_FULL = 1_000_000
_STEP = 1 << 20  # contributions made at a time


def _terms_of(batches):
    """Every word of the items, as ``(item, one, two)`` hash pairs."""
    for batch in batches:
        for rows, piece, start, length, part in word_runs(batch.column(1)):
            one, two = hashes(piece, start, length)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[part])), pa.array(one.view(np.int64)),
                                              pa.array(two.view(np.int64))], ["item", "one", "two"])


@dataclass
class Batch:
    """Items that are searched together; its arrays hold ``batch_terms`` entries at most (or one item's)."""

    items: np.ndarray  # ids
    one: np.ndarray  # the vocabulary: both hashes of every term, sorted by the first
    two: np.ndarray
    item: np.ndarray  # entries (item, term, occurrences): number of the item
    term: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Batch:
        items, item = np.unique(np.array([r["item"] for r in rows], np.int64), return_inverse=True)
        keys = np.array([(r["one"], r["two"]) for r in rows], np.int64).reshape(-1, 2).view(np.uint64)
        vocabulary, term = np.unique(keys, axis=0, return_inverse=True)
        return cls(items, vocabulary[:, 0].copy(), vocabulary[:, 1].copy(), item, term.reshape(-1),
                   np.array([r["n"] for r in rows], np.int64))


def batches_of(words: DataFrame, batch_terms: int) -> Iterator[Batch]:
    """``words`` (item, one, two, n) as batches of at most ``batch_terms`` rows;
    an item with more is a batch of its own."""
    total = words.count()
    parts = max(1, -(-total // batch_terms))
    while True:
        batch = F.pmod(F.xxhash64("item"), F.lit(parts))
        over = words.groupBy(batch.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("lo"),
                                                   F.max("item").alias("hi")) \
            .filter((F.col("n") > batch_terms) & (F.col("lo") < F.col("hi"))).limit(1).count()
        if not over:
            break
        parts *= 2
    for b in range(parts if total else 0):
        rows = words.filter(batch == b).collect()
        if rows:
            yield Batch.of(rows)


def _postings(vocabulary, block_docs: int):
    """Blocks ``(block, ids, n, pos, term, tf, n_docs, n_words)`` of documents (id, text)."""
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())),
                        ("pos", pa.list_(pa.int32())), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())),
                        ("n_docs", pa.int64()), ("n_words", pa.int64())])

    def row(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def scan(batches):
        one, two = vocabulary.value
        block = TaskContext.get().partitionId() << 32
        for batch in (b.slice(at, block_docs) for b in batches for at in range(0, b.num_rows, block_docs)):
            n, found = np.zeros(batch.num_rows, np.int64), []
            for rows, piece, start, length, part in word_runs(batch.column(1)):
                n[rows] += np.bincount(part, minlength=len(rows))
                a, b = hashes(piece, start, length)
                at = np.minimum(np.searchsorted(one, a), max(len(one) - 1, 0))
                hit = np.flatnonzero((one[at] == a) & (two[at] == b)) if len(one) else np.zeros(0, np.int64)
                found.append(rows[part[hit]] * len(one) + at[hit])
            key, tf = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
            pos, term = np.divmod(key, max(len(one), 1))
            yield pa.RecordBatch.from_arrays([
                pa.array([block]), row(batch.column(0).combine_chunks() if isinstance(batch.column(0), pa.ChunkedArray)
                                       else batch.column(0)),
                row(pa.array(n.astype(np.int32))), row(pa.array(pos.astype(np.int32))),
                row(pa.array(term.astype(np.int32))), row(pa.array(tf.astype(np.int32))),
                pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], schema=schema)
            block += 1
    return scan


def _dealt(stage_of, owners: int):
    """Every block's postings, one row an owner (also if it has none)."""
    def scan(batches):
        stages = stage_of.value
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                pos, term, tf = (one.column(c)[0].values for c in (3, 4, 5))
                owner = stages[term.to_numpy()]
                for s in range(owners):
                    at = pa.array(np.flatnonzero(owner == s))
                    yield pa.RecordBatch.from_arrays(
                        [one.column(0), one.column(1), one.column(2),
                         *[pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), x.take(at)) for x in (pos, term, tf)],
                         pa.array([s], pa.int32())], ["block", "ids", "n", "pos", "term", "tf", "stage"])
    return scan


def lengths(n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """``100 - 25 + ((25 n N) div L)`` of document lengths ``n``."""
    if len(n) and 25 * int(n.max()) * docs < 1 << 63:
        return 75 + (25 * n.astype(np.int64) * docs) // max(words, 1)
    return np.array([75 + 25 * x * docs // max(words, 1) for x in n.tolist()], np.int64)


def best(item: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of every item's ``k`` highest scores, ties to the smaller ``tie``."""
    order = np.lexsort((tie, -score, item))
    items = item[order]
    first = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else np.zeros(0, np.int64)
    place = np.arange(len(items)) - np.repeat(first, np.diff(np.append(first, len(items))))
    return order[place < k]


def _stage(plan, last: bool, k: int):
    """One owner's work on one bundle and block: accumulators in, postings met, accumulators out."""
    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        entries, docs, words = plan.value
        bundle, block = right.column("bundle")[0].as_py(), right.column("block")[0].as_py()
        term, item, worth, rest, bar = entries[bundle]
        ids, n, pos, of, tf = (right.column(c)[0].values for c in ("ids", "n", "pos", "term", "tf"))
        wide = len(ids)
        scores = np.zeros(len(rest) * wide, np.int64)
        for i in range(left.num_rows):
            scores[left.column("key")[i].values.to_numpy()] = left.column("score")[i].values.to_numpy()
        pos, of, tf = pos.to_numpy(), of.to_numpy(), tf.to_numpy().astype(np.int64)
        part = (1_000_000_000 * tf) // (1000 * tf + 12 * lengths(n.to_numpy(), docs, words)[pos])
        lo = np.searchsorted(term, of)
        count = np.searchsorted(term, of, side="right") - lo
        ends = np.cumsum(count)
        at = 0
        while at < len(of):  # so many postings that their contributions stay near _STEP
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _STEP, side="right")))
            entry, posting = expand(lo[at:to], count[at:to]), np.repeat(np.arange(at, to), count[at:to])
            np.add.at(scores, item[entry] * wide + pos[posting], worth[entry] * part[posting])
            at = to
        key = np.flatnonzero(scores)
        who, score = np.divmod(key, wide)[0] if wide else key, scores[key]
        stays = score + rest[who] >= bar[who]
        key, who, score = key[stays], who[stays], score[stays]
        if last:
            near = ids.take(pa.array(key - who * wide))
            missing = near.is_null().to_numpy(zero_copy_only=False)
            tie = np.where(missing, np.iinfo(np.int64).max, near.fill_null(0).to_numpy())
            at = pa.array(best(who, score, tie, k))
            return pa.table({"bundle": pa.array([bundle] * len(at), pa.int32()),
                             "item": pa.array(who.astype(np.int32)).take(at), "doc_id": near.take(at),
                             "score": pa.array(score).take(at)})
        some = np.flatnonzero(score >= bar[who])
        some = some[best(who[some], score[some], key[some], k)]
        one = pa.array([0, len(key)], pa.int32()), pa.array([0, len(some)], pa.int32())
        return pa.table({"bundle": pa.array([bundle], pa.int32()), "block": pa.array([block]),
                         "key": pa.ListArray.from_arrays(one[0], pa.array(key.astype(np.int32))),
                         "score": pa.ListArray.from_arrays(one[0], pa.array(score)),
                         "top_item": pa.ListArray.from_arrays(one[1], pa.array(who[some].astype(np.int32))),
                         "top": pa.ListArray.from_arrays(one[1], pa.array(score[some]))})
    return meet


_CARRIED = "bundle int, block long, key array<int>, score array<long>, top_item array<int>, top array<long>"


def ranked_search(docs: DataFrame, items: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", k: int = 20, bundle_items: int = 256,
                  block_docs: int = 2048, batch_terms: int = 1_000_000,
                  shares: tuple[float, ...] = (0.001, 0.01, 0.1)) -> DataFrame:
    """Every item's ``k`` best documents: ``(item_id, rank, doc_id, score)``.

    Terms are runs of digits, letters and non-ASCII characters, A-Z
    lower-cased.  A term's weight is ``w = floor(1000 ln((2N+2)/(2df+1)))``; a
    document scores the sum of ``w * ((10^9 tf) div (1000 tf + 12 m))`` over
    the item's terms, repeats included, with ``m = 75 + (25 n N) div L``.
    Only scores above 0 are listed, equal scores by ascending id.

    Null texts have no terms.  Rows of ``docs`` are documents of their own,
    also if they repeat an id or have none (null ids stand last among equals).
    Repeated rows of ``items`` count once; different texts of one item id are
    one item; items without an id are left out.  Extra columns are ignored;
    empty tables give no rows.

    ``shares`` of documents divide the owners; ``block_docs`` and
    ``bundle_items`` bound a stage's task (their product of sums);
    ``batch_terms`` bounds what is broadcast: more item terms are searched in
    several passes over the documents.  Terms are told apart by 128-bit hashes.
    """
    spark, work = docs.sparkSession, work.scope()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text")) \
        .filter(F.col("item").isNotNull() & F.col("text").isNotNull()).distinct()
    words = work.save(asked.mapInArrow(_terms_of, "item long, one long, two long")
                      .groupBy("item", "one", "two").agg(F.count(F.lit(1)).alias("n")), "words")
    found = None
    for batch in batches_of(words, batch_terms):
        part = _search(rows, batch, work, k, bundle_items, block_docs, shares)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, batch: Batch, work: WorkFolder, k: int, bundle_items: int, block_docs: int,
            shares: tuple[float, ...]) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast((batch.one, batch.two))
    blocks = work.save(docs.mapInArrow(
        _postings(vocabulary, block_docs), "block long, ids array<long>, n array<int>, pos array<int>, term array<int>, "
        "tf array<int>, n_docs long, n_words long"), "blocks")
    size = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_words").alias("words")).first()
    n_docs, n_words = size["docs"] or 0, size["words"] or 0
    df = np.zeros(len(batch.one), np.int64)  # a number a term of the batch
    for r in blocks.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    owner = np.searchsorted(np.array(shares) * max(n_docs, 1), df, side="left").astype(np.int8)
    stages = len(shares) + 1
    path = work.child("owned")
    blocks.mapInArrow(_dealt(spark.sparkContext.broadcast(owner), stages), "block long, ids array<long>, n array<int>, "
                      "pos array<int>, term array<int>, tf array<int>, stage int") \
        .write.partitionBy("stage").parquet(path)
    owned = spark.read.schema("block long, ids array<long>, n array<int>, pos array<int>, term array<int>, "
                              "tf array<int>, stage int").parquet(path)
    bundles = -(-len(batch.items) // bundle_items)
    worth = batch.times * weight[batch.term]
    bundle_of, place = np.divmod(batch.item, bundle_items)
    bars = [np.zeros(min(bundle_items, len(batch.items) - b * bundle_items), np.int64) for b in range(bundles)]

    def entries(stage: int) -> dict:
        out = {}
        for b in range(bundles):
            here = (bundle_of == b) & (owner[batch.term] == stage) & (worth > 0)
            order = np.flatnonzero(here)[np.argsort(batch.term[here], kind="stable")]
            later = (bundle_of == b) & (owner[batch.term] > stage)
            rest = np.zeros(len(bars[b]), np.int64)
            np.add.at(rest, place[later], worth[later] * _FULL)
            out[b] = batch.term[order], place[order], worth[order], rest, bars[b]
        return out

    every = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle")
    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in
            (("key", "int"), ("score", "long"), ("top_item", "int"), ("top", "long"))]
    carried = blocks.select(every, "block", *none)
    for stage in range(stages):
        last = stage == stages - 1
        plan = spark.sparkContext.broadcast((entries(stage), n_docs, n_words))
        postings = owned.filter(F.col("stage") == stage).select(every, "block", "ids", "n", "pos", "term", "tf")
        met = carried.groupBy("bundle", "block").cogroup(postings.groupBy("bundle", "block")).applyInArrow(
            _stage(plan, last, k), "bundle int, item int, doc_id long, score long" if last else _CARRIED)
        if last:
            break
        gone, carried = carried, work.save(met, "carried")
        if stage:
            work.drop(gone)
        kth = Window.partitionBy("bundle", "top_item").orderBy(F.col("top").desc())
        bar = carried.select("bundle", F.explode(F.arrays_zip("top_item", "top")).alias("x")).select("bundle", "x.*") \
            .withColumn("r", F.row_number().over(kth)).filter(F.col("r") <= k).filter(F.col("r") == k)
        for r in bar.collect():  # one row an item of the batch
            bars[r["bundle"]][r["top_item"]] = max(bars[r["bundle"]][r["top_item"]], r["top"])
    ids = spark.createDataFrame([(int(b), int(p), int(i)) for b, p, i in zip(
        *np.divmod(np.arange(len(batch.items)), bundle_items), batch.items, strict=True)],
        "bundle int, item int, item_id long")
    top = work.save(met, "found")  # k rows an item and block at most
    # one row an item of the batch
    return top.join(F.broadcast(ids), ["bundle", "item"]).select("item_id", "doc_id", "score")
