"""Packing documents into fixed-length sequences as a cutting-stock problem.

Token ids come first: every document is cut into pieces of the sequence
length and one rest.  The rests are the orders of a cutting-stock problem
(Gilmore, Gomory, Operations Research 1961): a linear program over patterns
of length classes, whose columns an unbounded knapsack prices by dynamic
programming.  Only the length histogram (as many numbers as lengths) reaches
the driver.  Rounded-down pattern counts, with a first-fit for what rounding
leaves, become intervals of ranks; rests are ranked inside their class over
the cluster and take the places of their intervals.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder, spread_rank
from quarry.llm.spans import tidy
from quarry.llm.tokens import documents


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int | None,
           vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)``: every document's ids
    in pieces of ``capacity`` and a rest."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def cut(batches):
        for part, ids, offsets in documents(batches, "text", vocabulary, end_id):
            raw = memoryview(ids.tobytes())
            row, start, length, crc = [], [], [], []
            bounds = offsets.tolist()
            for i in range(part.num_rows):
                lo, hi = bounds[i], bounds[i + 1]
                for at in range(lo, hi, capacity):
                    to = min(hi, at + capacity)
                    row.append(i), start.append(at - lo), length.append(to - at)
                    crc.append(zlib.crc32(raw[4 * at:4 * to]))
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                pa.array(np.diff(offsets)[np.array(row, np.int64)] if row else [], pa.int64())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return rows.mapInArrow(tidy(cut), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def price(dual: np.ndarray, width: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of classes
    ``1..len(dual)`` (class ``c`` is ``c`` wide) of highest value within ``width``."""
    worth = np.maximum(dual, 0.0)
    best = np.zeros(width + 1)
    take = np.zeros(width + 1, np.int64)
    for w in range(1, width + 1):
        n = min(w, len(worth))
        value = worth[:n] + best[w - 1::-1][:n]
        i = int(np.argmax(value))
        best[w], take[w] = value[i], i + 1
    pattern = np.zeros(len(dual), np.int64)
    w = width
    while w > 0 and best[w] > 0:
        pattern[take[w] - 1] += worth[take[w] - 1] > 0
        w -= int(take[w])
    return float(best[width]), pattern


def greedy_patterns(need: np.ndarray, widths: np.ndarray, width: int) -> list[np.ndarray]:
    """Patterns that first-fit decreasing would cut, each as often as it can be."""
    left = need.astype(np.int64).copy()
    out = []
    while left.any():
        pattern, room = np.zeros(len(left), np.int64), width
        for i in range(len(left) - 1, -1, -1):
            if left[i] and widths[i] <= room:
                pattern[i] = min(room // widths[i], left[i])
                room -= pattern[i] * widths[i]
        used = pattern > 0
        left[used] -= pattern[used] * int((left[used] // pattern[used]).min())
        out.append(pattern)
    return out


def cutting_stock(demand: np.ndarray, width: int, gap: float = 1e-3,
                  max_steps: int = 4_000) -> list[tuple[int, dict[int, int]]]:
    """Patterns and how often each is cut, covering ``demand[c - 1]`` pieces of
    every class ``c``: ``[(count, {class: pieces})]``.

    Column generation on the covering program (fewest sequences) by revised
    simplex, started from one pattern a class and the greedy ones, and ended
    within ``gap`` of the program's optimum; ``max_steps`` only bounds the
    effort (any basis on the way is a cover).  Duals are smoothed towards the
    best bound's (Wentges 1997).  Counts are rounded down and the pieces left,
    at most a pattern's worth for each class, placed first-fit from the widest.
    """
    classes = np.flatnonzero(demand > 0)
    if not len(classes):
        return []
    m = len(classes)
    need = demand[classes].astype(float)
    base = np.diag((width // (classes + 1)).astype(float))
    inverse = np.diag(1.0 / base.diagonal())
    cost = np.ones(m)
    x = inverse @ need
    bound, inner = 0.0, None

    def enter(column: np.ndarray, c: float) -> bool:
        nonlocal inverse, x
        way = inverse @ column
        rises = way > 1e-9
        if not rises.any():
            return False
        ratio = np.full(m, np.inf)
        ratio[rises] = np.maximum(x[rises], 0) / way[rises]
        out = int(np.argmin(ratio))
        base[:, out], cost[out] = column, c
        row = inverse[out] / way[out]
        inverse = inverse - np.outer(way, row)
        inverse[out] = row
        x = inverse @ need
        return True

    def priced(duals: np.ndarray) -> tuple[float, np.ndarray]:
        full = np.zeros(int(classes[-1]) + 1)
        full[classes] = duals
        value, pattern = price(full, width)
        return value, pattern[classes].astype(float)

    for pattern in greedy_patterns(need, classes + 1, width):
        if (cost @ inverse) @ pattern > 1 + 1e-7:
            enter(pattern.astype(float), 1.0)
    for step in range(max_steps):
        if step % 400 == 399:  # fresh inverse against rounding
            inverse = np.linalg.inv(base)
            x = inverse @ need
        dual = cost @ inverse
        tried = dual if inner is None else 0.8 * inner + 0.2 * dual
        value, column = priced(tried)
        # scaled by the best pattern's value, duals bound every plan from below (Farley)
        here = need @ np.maximum(tried, 0) / max(value, 1e-12)
        if here > bound:
            bound, inner = here, np.maximum(tried, 0) / max(value, 1e-12)
        if dual @ column <= 1 + 1e-7:  # smoothed too far: price the true duals
            value, column = priced(dual)
            here = need @ np.maximum(dual, 0) / max(value, 1e-12)
            if here > bound:
                bound, inner = here, np.maximum(dual, 0) / max(value, 1e-12)
        if cost @ x <= bound * (1 + gap):
            break
        if dual @ column > 1 + 1e-7:
            done = not enter(column, 1.0)
        else:  # no pattern pays: a surplus column
            low = int(np.argmin(dual))
            done = dual[low] >= -1e-9 or not enter(-np.eye(m)[low], 0.0)
        if done:
            break
    plan: list[tuple[int, dict[int, int]]] = []
    left = demand.astype(np.int64).copy()
    for k in range(m):
        count = int(np.floor(x[k] + 1e-7))
        if cost[k] == 0 or count < 1:
            continue
        items = {int(classes[i]) + 1: int(round(base[i, k])) for i in np.flatnonzero(base[:, k] > 0.5)}
        # rounding noise must not cut more sequences than some class still needs
        count = min(count, max(-(-int(left[c - 1]) // a) for c, a in items.items()))
        if count > 0:
            plan.append((count, items))
            for c, a in items.items():
                left[c - 1] = max(0, left[c - 1] - a * count)
    bins: list[list] = []  # [room, {class: pieces}]
    for c in range(len(left), 0, -1):
        for _ in range(int(left[c - 1])):
            spot = next((b for b in bins if b[0] >= c), None)
            if spot is None:
                bins.append(spot := [width, {}])
            spot[0] -= c
            spot[1][c] = spot[1].get(c, 0) + 1
    return plan + [(1, items) for _, items in bins]


def pack(docs: DataFrame, work: WorkFolder, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         end_id: int | None = 1, unit: int = 8, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` ids:
    ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    Every document's ids end with ``end_id``; each id lies in one piece.
    Lengths are classes of ``unit`` ids (rounded up while planning; offsets
    are exact and gapless).  Null texts are empty: one piece of the end id, or
    none where ``end_id`` is None.  Repeated rows are documents of their own;
    null ids pass through; extra columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    width = capacity // unit
    if width * unit != capacity:
        raise ValueError("unit must divide capacity")
    cut = work.save(pieces(docs, id_col, text_col, capacity, end_id, vocabulary), "pieces")
    classed = cut.withColumn("_class", F.ceil(F.col("length") / F.lit(unit)).cast("int"))
    demand = np.zeros(width, np.int64)
    for r in classed.groupBy("_class").count().collect():  # at most capacity / unit rows
        demand[r["_class"] - 1] = r["count"]
    whole = int(demand[-1])
    demand[-1] = 0  # a full piece is a sequence of its own
    plan = cutting_stock(demand, width) + ([(whole, {width: 1})] if whole else [])
    used = dict.fromkeys(range(1, width + 1), 0)
    rows, first = [], 0
    for count, items in plan:
        for c, a in items.items():
            rows.append((c, used[c], used[c] + a * count, a, first))
            used[c] += a * count
        first += count
    spans = spark.createDataFrame(rows, "_span int, _lo long, _hi long, _each long, _first long")
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id"), F.col("start"), F.col("ids_crc32")]
    ranked = spread_rank(classed, ["_class"], order,
                         F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"), salts, "_rank")
    inside = (F.col("_class") == F.col("_span")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    # the interval table holds the plan's patterns: bounded by the length classes, not by the rows
    placed = ranked.join(F.broadcast(spans), inside) \
        .withColumn("sequence_id", F.col("_first") + F.floor((F.col("_rank") - F.col("_lo")) / F.col("_each")))
    before = Window.partitionBy("sequence_id").orderBy(F.col("_class").desc(), "_rank") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         F.col("sequence_id").cast("long").alias("sequence_id"),
                         F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
