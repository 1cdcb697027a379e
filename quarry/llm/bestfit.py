"""Packing whole documents into as few sequences as possible: best fit in bulk-synchronous rounds.

Lengths are handled from the longest down, a range of them a round.  Open
sequences offer their gaps as slots.  Documents and slots are sorted by size
over the cluster, and a sweep over the partitions finds every document's
successor, the smallest slot that holds it.  Documents that want the same slot
are told apart by rank: with documents and slots numbered in ascending order,
document ``i`` takes slot ``i + max over j <= i of (successor(j) - j)``, the
first that is left when all documents before it have taken theirs.  The
maximum is a running one, so a partition scans its own rows and one row a
partition carries it on.  Slots and documents then meet in an equi-join on the
slot's number, gaps shrink by what they took, and documents beyond the last
slot open new sequences: as many as fit of their length stand together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder
from quarry.llm.packing import pieces

_LOWEST = -(1 << 62)
_DOC = "doc_id long, start long, length int, ids_crc32 long, pid long"
_SWEPT = f"kind int, size int, sequence_id long, {_DOC}, part int, docs long, slots long, lead long"


def _sweep(batches):
    """A partition of documents (kind 0) and slots (kind 1) in ascending order:
    how many of each stand before a row, and the largest ``successor - rank``
    of the documents up to it, all within the partition; a last row (kind 2)
    has the partition's totals."""
    part, docs, slots, lead = TaskContext.get().partitionId(), 0, 0, _LOWEST
    names = [f.split()[0] for f in _SWEPT.split(", ")]
    for b in batches:
        if not b.num_rows:
            continue
        doc = b.column("kind").to_numpy() == 0
        seen, open_ = np.cumsum(doc), np.cumsum(~doc)
        before, free = docs + seen - doc, slots + open_ - ~doc
        run = np.maximum.accumulate(np.append(lead, np.where(doc, free - before, _LOWEST)))[1:]
        docs, slots, lead = docs + int(seen[-1]), slots + int(open_[-1]), int(run[-1])
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(before), pa.array(free), pa.array(run)], names)
    if docs or slots:
        none = [pa.nulls(1, pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array([2], pa.int32()), pa.nulls(1, pa.int32()), *none[:3], pa.nulls(1, pa.int32()), *none[:2],
             pa.array([part], pa.int32()), pa.array([docs]), pa.array([slots]), pa.array([lead])], names)


def bounds(capacity: int, ratio: float) -> list[tuple[int, int]]:
    """Ranges ``(above, up to)`` of lengths: all that fill more than half of a
    sequence, then geometric ones."""
    out, hi = [(capacity // 2, capacity)], capacity // 2
    while hi > 0:
        lo = min(hi - 1, int(hi / ratio))
        out.append((lo, hi))
        hi = lo
    return out


def swept(docs: DataFrame, slots: DataFrame | None, work: WorkFolder) -> tuple[DataFrame, DataFrame, int, int]:
    """``(documents, slots, number of slots, number placed)``: documents with
    their ``rank`` and the number of the slot they take (``slot``, beyond the
    last for those left), slots with theirs (``slot``)."""
    spark = docs.sparkSession
    rows = docs.select(F.lit(0).alias("kind"), F.col("length").alias("size"), F.lit(None).cast("long").alias("sequence_id"),
                       "doc_id", "start", "length", "ids_crc32", "pid")
    if slots is not None:
        rows = rows.unionByName(slots.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    # documents before slots of their size; the hash only deals out equal sizes
    order = ["size", "kind", F.xxhash64("pid", "sequence_id")]
    table = work.save(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sweep, _SWEPT), "swept")
    totals = sorted(table.filter("kind = 2").select("part", "docs", "slots", "lead").collect())  # one row a partition
    carried, n_docs, n_slots, lead = [], 0, 0, _LOWEST
    for part, docs_here, slots_here, lead_here in totals:
        carried.append((part, n_docs, n_slots, lead))
        lead = max(lead, lead_here + n_slots - n_docs)
        n_docs, n_slots = n_docs + docs_here, n_slots + slots_here
    carry = F.broadcast(spark.createDataFrame(carried, "part int, _docs long, _slots long, _lead long"))
    joined = table.join(carry, "part")
    rank = F.col("_docs") + F.col("docs")
    placed = joined.filter("kind = 0").select(
        "doc_id", "start", "length", "ids_crc32", "pid", rank.alias("rank"),
        (rank + F.greatest("_lead", F.col("lead") + F.col("_slots") - F.col("_docs"))).alias("slot"))
    free = joined.filter("kind = 1").select("sequence_id", (F.col("_slots") + F.col("slots")).alias("slot"))
    # places rise by one at least, and none before the largest lead is beyond the slots
    return placed, free, n_slots, max(0, min(n_docs, n_slots - lead)) if n_slots else 0


def best_fit(docs: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
             end_id: int | None = 1, ratio: float = 1.6, spare: int = 4, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of all
    documents in sequences of at most ``capacity`` ids.

    Every document's ids end with ``end_id``; only documents of more than
    ``capacity`` ids are cut, into pieces of ``capacity`` and a rest.  Null
    texts are empty: one piece of the end id, or none where ``end_id`` is None.
    Repeated rows are documents of their own; null ids pass through; extra
    columns are ignored; no rows give no rows.

    ``ratio`` is the width of a round's range of lengths (smaller: more rounds,
    fuller sequences).  A round deals out at most about ``spare`` slots a
    document, and is repeated while that leaves documents and room.
    """
    work = work.scope()
    cut = work.save(pieces(docs, id_col, text_col, capacity, end_id, vocabulary).select(
        "doc_id", "start", F.col("length").cast("int").alias("length"), "ids_crc32",
        F.monotonically_increasing_id().alias("pid")).sortWithinPartitions("length"), "pieces")  # a round reads its lengths
    count = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        count[r["length"]] = r["count"]
    done: list[DataFrame] = []
    bins: DataFrame | None = None  # (sequence_id, gap) with room for some document
    room = (0, 0)  # open gaps, and slots in them, for the next round
    opened = 0
    ranges = [(lo, hi) for lo, hi in bounds(capacity, ratio) if count[lo + 1:hi + 1].any()]
    for turn, (lo, hi) in enumerate(ranges):
        left = count.copy()  # lengths of this round's documents that have no place yet
        left[:lo + 1] = left[hi + 1:] = 0
        band = cut.filter((F.col("length") > lo) & (F.col("length") <= hi))
        while left.any():
            n = int(left.sum())
            slots, limited = _slots(bins, left, room, spare * n) if room[0] else (None, False)
            placed, free, n_slots, fits = swept(band, slots, work)
            found = [placed.join(free, "slot").select("doc_id", "start", "length", "ids_crc32", "pid", "sequence_id",
                                                      F.lit(0).alias("room"))] if n_slots else []
            # documents stand in ascending length, so what is left is the longest of them
            rest = np.minimum(left, np.maximum(np.cumsum(left) - fits, 0))
            if limited and fits and rest.any():
                band = work.save(placed.filter(F.col("slot") >= n_slots).drop("rank", "slot"), "band")
            elif rest.any():
                new, more = _open(placed.filter(F.col("slot") >= n_slots) if n_slots else placed, rest, fits, capacity, opened)
                found.append(new)
                opened, rest = opened + more, rest * 0
            part = found[0] if len(found) == 1 else found[0].unionAll(found[1])
            done.append(work.save(part, "placed"))
            change = done[-1].select("sequence_id", (F.col("room") - F.col("length")).alias("gap"))
            held, after = bins, rest
            if not rest.any() and turn + 1 < len(ranges):
                after = count.copy()
                after[:ranges[turn + 1][0] + 1] = after[ranges[turn + 1][1] + 1:] = 0
            if after.any():
                need = int(np.flatnonzero(count[:hi + 1])[0])  # a gap of less takes no document any more
                seen = Observation()
                least, each = _per_gap(after)
                bins = work.save(
                    (change if bins is None else bins.unionAll(change)).groupBy("sequence_id")
                    .agg(F.sum("gap").cast("int").alias("gap")).filter(F.col("gap") >= need)
                    .observe(seen, F.count_if(F.col("gap") >= least).alias("gaps"),
                             F.sum(F.when(F.col("gap") >= least, each)).alias("slots")), "bins")
                room = seen.get["gaps"] or 0, seen.get["slots"] or 0
                if held is not None:
                    work.drop(held)
            left = rest
    if not done:
        return docs.sparkSession.createDataFrame([], "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                                     "sequence_id long, offset long")
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionAll(part)
    # a sequence holds ``capacity`` documents at most
    before = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return whole.select("doc_id", F.floor(F.col("start") / F.lit(capacity)).cast("int").alias("piece"), "start",
                        F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id",
                        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))


def _per_gap(left: np.ndarray):
    """The shortest of the documents that are left, and how many slots for any
    of them a gap has."""
    lengths = np.flatnonzero(left)
    return int(lengths[0]), F.greatest(F.lit(1), F.floor(F.col("gap") / F.lit(int(lengths[-1])))).cast("int")


def _slots(bins: DataFrame, left: np.ndarray, room: tuple[int, int], most: int) -> tuple[DataFrame, bool]:
    """Slots ``(sequence_id, size)`` of gaps for the documents that are left:
    one of the gap's size, or several that hold any of them.  ``room``: the
    number of such gaps and of slots in them; if that is far over ``most``,
    long gaps offer fewer (and the second value is True)."""
    least, each = _per_gap(left)
    top = int(np.flatnonzero(left)[-1])
    live = bins.filter(F.col("gap") >= least)
    limited = room[1] > max(most, room[0]) + room[0]
    if limited:
        each = F.least(each, F.lit(max(1, -(-most // room[0]))))
    # the last of several slots has what is left of the gap
    slot = live.select("sequence_id", "gap", each.alias("_n")) \
        .select("sequence_id", "gap", "_n", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i"))
    size = F.when(F.col("_i") < F.col("_n"), F.lit(top)).otherwise(F.col("gap") - (F.col("_n") - 1) * F.lit(top))
    return slot.select("sequence_id", size.cast("int").alias("size")), limited


def _open(docs: DataFrame, rest: np.ndarray, first: int, capacity: int, opened: int) -> tuple[DataFrame, int]:
    """New sequences for ``docs`` (with their rank, from ``first``): ``k`` of
    those documents of which ``k`` fit stand together.  ``rest``: how many there
    are of each length; ``opened``: the next sequence's number."""
    rows, at, new = [], first, 0
    fit = capacity // np.maximum(np.arange(len(rest)), 1)
    for k in np.unique(fit[np.flatnonzero(rest)])[::-1].tolist():  # ascending length
        n = int(rest[fit == k].sum())
        rows.append((k, at, opened + new))
        at, new = at + n, new - (-n // k)
    classes = docs.sparkSession.createDataFrame(rows, "_k int, _start long, _first long")
    place = F.col("rank") - F.col("_start")
    out = docs.withColumn("_k", F.floor(F.lit(capacity) / F.col("length")).cast("int")) \
        .join(F.broadcast(classes), "_k") \
        .select("doc_id", "start", "length", "ids_crc32", "pid",
                (F.col("_first") + F.floor(place / F.col("_k"))).cast("long").alias("sequence_id"),
                F.when(place % F.col("_k") == 0, capacity).otherwise(0).alias("room"))
    return out, new
