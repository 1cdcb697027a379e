"""k-nearest-neighbour classification and its evaluation.

Two inputs are supported:

* precomputed distance records ``(id, paired, distance)`` -- what the
  original job consumed (see ``quarry.sources.read_distance_records``);
* feature vectors ``(id, vector)`` -- :func:`nearest_vectors` finds the
  exact k nearest neighbours of every vector without forming the cross
  product (labelled extension: the original never says how its distance
  file was made; here it is Euclidean, both directions, no self pairs).

Then :func:`k_nearest` (window top-k, ties to the smaller neighbour id),
:func:`knn_classify` (label join + majority vote, ties to the smallest
label), :func:`confusion_matrix` and :func:`accuracy` all stay distributed:
no ``collect``, no driver loop.

Exact neighbours without the cross product
------------------------------------------
``nearest_vectors`` (one table) and ``nearest_between`` (queries against
another table) partition the references around ``P`` pivots (each goes to the
cell of its closest pivot; Lu, Shen, Chen, Ooi, "Efficient processing of k
nearest neighbor joins using MapReduce", VLDB 2012):

1. one pass assigns cells and records each vector's distance to its pivot.
   Equal references are one node: the k smallest ids stand for all of them,
   because no list can hold more.  Equal queries are one node, too, searched
   once;
2. a cell's references are sorted by their distance to the pivot (a ranged
   sort over the cluster) and cut into blocks of ``block_rows``: rings, each
   with its smallest and largest distance;
3. every query looks among the references of the ring it falls into first: the
   k-th distance found there is *its* bound;
4. no reference of a ring ``[lo, hi]`` is closer than ``lo - d`` or ``d - hi``
   for a query at distance ``d`` from the pivot, so a query only meets another
   ring, of its own cell or another one, if that is within its bound.  In many
   dimensions that is most rings, so vectors are not copied to rings: runs of
   rings are spans, few of them (``SPAN_BYTES``, shuffle partitions), a query is
   sent once to every span with such a ring, with its bound, and a numpy kernel
   meets the rings of the (queries, span) unit, the bounds shrinking meanwhile;
5. a final window top-k merges the candidates of each node, and its rows
   share the list.

Only the pivots (about the square root of the number of vectors) and two
numbers per ring (``max_blocks`` at most: beyond that rings grow) reach the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.common import Scratch, ranked

#: Vectors of one side of a (queries, span) unit, in bytes, at most.
SPAN_BYTES = 1 << 24

DISTANCE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("paired", T.LongType()),
    T.StructField("distance", T.DoubleType()),
])


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """A unique (not consecutive) long id per row, computed per
    partition without a shuffle; stable while the input splits are."""
    return df.withColumn(name, F.monotonically_increasing_id())


def with_row_index(df: DataFrame, name: str = "id") -> DataFrame:
    """Consecutive 0-based row positions (what a positional id in a companion
    file refers to), without a single-partition window over the data.

    Rows read from files are numbered in file order: by file path, then by
    position in the file, however Spark packs splits into tasks.  Rows of a
    split are counted (one small row per split), the running offsets are
    joined back, and each row adds its place inside its split.  Other inputs
    are numbered in partition order; their partitioning must be stable."""
    try:
        split = [F.col("_metadata.file_path").alias("_s1"), F.col("_metadata.file_block_start").alias("_s2")]
        tagged = df.select("*", *split, F.monotonically_increasing_id().alias("_mid"))
    except AnalysisException:  # not read from files
        tagged = df.select("*", F.lit("").alias("_s1"), F.spark_partition_id().cast("long").alias("_s2"),
                           F.monotonically_increasing_id().alias("_mid"))
    counts = tagged.groupBy("_s1", "_s2").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_s1", "_s2").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    offsets = counts.select("_s1", "_s2", "_first", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    return tagged.join(offsets, on=["_s1", "_s2"]) \
        .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_first")) \
        .drop("_s1", "_s2", "_mid", "_first", "_off")


def k_nearest(distances: DataFrame, k: int, id_col: str = "id", paired_col: str = "paired",
              distance_col: str = "distance") -> DataFrame:
    """The ``k`` smallest distances of every id (fewer when it has fewer
    partners); ties go to the smaller partner id; records without a
    distance are ignored.  Planned with a partial ``WindowGroupLimit``
    before the shuffle."""
    w = Window.partitionBy(id_col).orderBy(F.col(distance_col).asc_nulls_last(),
                                           F.col(paired_col).asc_nulls_last())
    return distances.filter(F.col(distance_col).isNotNull()) \
        .withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def knn_vote(neighbors: DataFrame, labels: DataFrame, id_col: str = "id", paired_col: str = "paired",
             label_col: str = "label") -> DataFrame:
    """Predicted label of every id = the most frequent label among its
    neighbours (smallest label on a tie): ``id, predicted``.  The ids need no
    label of their own; ``labels`` is looked up by the neighbour's id."""
    lab = labels.select(F.col(id_col).alias("_pid"), F.col(label_col).alias("_plabel"))
    votes = neighbors.select(id_col, paired_col) \
        .join(lab, F.col(paired_col) == F.col("_pid")) \
        .groupBy(id_col, "_plabel").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(id_col).orderBy(F.col("_n").desc(), F.col("_plabel").asc_nulls_last())
    return votes.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1) \
        .select(id_col, F.col("_plabel").alias("predicted"))


def knn_classify(neighbors: DataFrame, labels: DataFrame, id_col: str = "id", paired_col: str = "paired",
                 label_col: str = "label") -> DataFrame:
    """Predicted label of every id = the most frequent label
    among its neighbours (smallest label on a tie), with its actual label.

    ``neighbors``: ``(id, paired)`` rows (already the k nearest);
    ``labels``: ``(id, label)``.  Labels are looked up by id with joins,
    not by position.  Output: ``id, predicted, actual``."""
    pred = knn_vote(neighbors, labels, id_col, paired_col, label_col)
    actual = labels.select(id_col, F.col(label_col).alias("actual"))
    return pred.join(actual, on=id_col)


def confusion_matrix(predictions: DataFrame, predicted: str = "predicted", actual: str = "actual") -> DataFrame:
    """Long form ``(predicted, actual, n)``; pivot it for the square view."""
    return predictions.groupBy(predicted, actual).agg(F.count(F.lit(1)).alias("n"))


def accuracy(predictions: DataFrame, predicted: str = "predicted", actual: str = "actual") -> DataFrame:
    """One row, share of correct predictions and the number of rows."""
    hit = (F.col(predicted) == F.col(actual)).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- vectors

def _as_matrix(series: pd.Series) -> np.ndarray:
    if len(series) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in series])


def _pairwise(q: np.ndarray, x: np.ndarray, chunk_bytes: int = 1 << 25) -> np.ndarray:
    """Euclidean distances, computed from the differences (no
    |q|^2+|x|^2-2qx cancellation), in chunks of query rows."""
    out = np.empty((q.shape[0], x.shape[0]))
    per_row = max(1, x.shape[0] * max(1, q.shape[1]) * 8)
    step = max(1, chunk_bytes // per_row)
    for s in range(0, q.shape[0], step):
        diff = q[s:s + step, None, :] - x[None, :, :]
        out[s:s + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def _block_k_best(qv: np.ndarray, rv: np.ndarray, qid: np.ndarray, rid: np.ndarray, k: int, own: bool = False):
    """The k nearest reference rows of every query row (no self pairs, unless
    ``own``: the two ids are then unrelated), ties to the smaller reference id:
    (query ids, partner ids, distances).

    Squared distances come from one matrix product (BLAS).  Each row keeps
    its ``k + 8`` smallest, whose exact distances are computed from the
    differences before the final pick.  The product's rounding error is far
    below the margin: a row with yet more values within the margin of its
    k-th keeps all of those instead."""
    if not len(qid) or not len(rid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    order = np.argsort(rid, kind="stable")  # positions in id order, so ties fall to the smaller id
    rv, rid = rv[order], rid[order]
    qn = np.einsum("ij,ij->i", qv, qv)
    rn = np.einsum("ij,ij->i", rv, rv)
    d2 = qn[:, None] + rn[None, :] - 2.0 * (qv @ rv.T)
    if not own:
        d2[qid[:, None] == rid[None, :]] = np.inf
    n, m = d2.shape
    kk, wide = min(k, m), min(k + 8, m)
    cand = np.argpartition(d2, wide - 1, axis=1)[:, :wide] if wide < m else np.broadcast_to(np.arange(m), (n, m))
    near = np.take_along_axis(d2, cand, axis=1)
    kth = np.partition(near, kk - 1, axis=1)[:, kk - 1]
    margin = 1e-9 * (qn + rn.max()) + 1e-12
    if wide < m:
        crowded = np.flatnonzero(near.max(axis=1) <= kth + margin)
    else:
        crowded = np.zeros(0, np.int64)

    def exact(rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cols = np.sort(cols, axis=1)
        out = np.empty(cols.shape)
        step = max(1, (1 << 22) // max(1, cols.shape[1] * qv.shape[1]))
        for s in range(0, len(rows), step):
            diff = rv[cols[s:s + step]] - qv[rows[s:s + step], None, :]
            out[s:s + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
        if not own:
            out[rid[cols] == qid[rows][:, None]] = np.inf
        best = np.argsort(out, axis=1, kind="stable")[:, :kk]
        return np.take_along_axis(cols, best, axis=1), np.take_along_axis(out, best, axis=1)

    rows = np.arange(n)
    cols, dist = exact(rows, cand)
    for i in crowded:  # near-ties beyond the padding: every value within the margin
        some = np.flatnonzero(d2[i] <= kth[i] + margin[i])[None, :]
        cols[i], dist[i] = (x[0] for x in exact(np.array([i]), some))
    real = np.isfinite(dist)
    return np.repeat(qid, kk).reshape(n, kk)[real], rid[cols][real], dist[real]


def _ring_gap(d: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Smallest possible distance of a query to any vector whose distance to a
    pivot lies in ``[lo, hi]``, from the query's distance ``d`` to that pivot
    (triangle inequality), with a slack for rounding."""
    return np.maximum(np.maximum(lo - d, d - hi), 0.0) - 1e-9 * (d + hi) - 1e-12


def _points(df: DataFrame, id_col: str, vec_col: str, invalid: str) -> tuple[DataFrame, int, int | None]:
    """``(id, v)`` rows that take part, their number and the vectors' length."""
    pts = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    pts = pts.filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    size = pts.agg(F.count_if(~bad).alias("n"), F.count_if(bad).alias("bad"), F.min(F.when(~bad, F.size("v"))).alias("lo"),
                   F.max(F.when(~bad, F.size("v"))).alias("hi")).first()
    if size["bad"] and invalid == "raise":
        raise ValueError(f"{size['bad']} vectors hold NULL or non-finite elements")
    if size["n"] and size["lo"] != size["hi"]:
        raise ValueError(f"vectors of different lengths: {size['lo']} to {size['hi']}")
    return pts.filter(~bad), size["n"], size["lo"]


def _celled(pts: DataFrame, pivots, tasks: int) -> DataFrame:
    """``(id, v, key, cell, dp)``: a digest of the vector, its closest pivot and
    the distance to it."""
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pivots.value
        for b in batches:
            if len(b):
                x = _as_matrix(b["v"]) + 0.0  # no negative zeros: equal vectors have equal bytes
                d = _pairwise(x, p)
                cell = d.argmin(axis=1)
                yield b.assign(key=[hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x],
                               cell=cell.astype("int32"), dp=d[np.arange(len(b)), cell])

    # vector kernels are CPU-bound: an even deal over all tasks, whatever the input's files
    return pts.repartition(tasks, "id").mapInPandas(assign, "id long, v array<double>, key binary, cell int, dp double")


@dataclass
class Rings:
    """The reference vectors of every cell, in blocks by their distance to the
    pivot: blocks ``start[c]`` to ``start[c + 1]`` are cell ``c``'s, with the
    smallest and largest distance of each; ``span``: the run of blocks it is in."""

    start: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    span: np.ndarray

    def home(self, cell: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The block of its cell that a vector at distance ``d`` falls into."""
        out = np.zeros(len(cell), np.int64)
        for c in np.unique(cell):
            at = np.flatnonzero(cell == c)
            lo = self.lo[self.start[c]:self.start[c + 1]]
            out[at] = self.start[c] + np.maximum(np.searchsorted(lo, d[at], side="right") - 1, 0)
        return out

    def within(self, d: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, block)`` of all blocks that may hold something within ``bound``
        of a row, given its distances to all pivots."""
        rows, blocks = [], []
        last = self.start[1:] - 1
        live = np.flatnonzero(last >= self.start[:-1])
        reach = _ring_gap(d[:, live], self.lo[self.start[live]], self.hi[last[live]]) <= bound[:, None]
        for i in np.flatnonzero(reach.any(axis=0)):
            at = np.flatnonzero(reach[:, i])
            span = np.arange(self.start[live[i]], last[live[i]] + 1)
            if len(span) > 1:
                r, b = np.nonzero(_ring_gap(d[at, live[i]][:, None], self.lo[span], self.hi[span]) <= bound[at][:, None])
                at, span = at[r], span[b]
            else:
                span = np.repeat(span, len(at))
            rows.append(at), blocks.append(span)
        none = np.zeros(0, np.int64)
        return (np.concatenate(rows), np.concatenate(blocks)) if rows else (none, none)


def _rings(refs: DataFrame, n_cells: int, rows: int, span: int, scratch: Scratch) -> tuple[DataFrame, Rings]:
    """``refs`` (id, v, cell, dp) with their ``block``, and the blocks, in
    spans of about ``span`` rows."""
    order = ranked(refs.select("id", "v", "cell", "dp"), ["cell", "dp", "id"], scratch, "_rank")
    # one row a cell: where its ranks begin; a row's block follows from its rank inside the cell
    cells = order.groupBy("cell").agg(F.min("_rank").alias("_begin"), F.count(F.lit(1)).alias("_n")).orderBy("cell").collect()
    start, at = np.zeros(n_cells + 1, np.int64), 0
    table = []
    for r in cells:
        table.append((r["cell"], r["_begin"], at))
        start[r["cell"] + 1] = blocks = -(-r["_n"] // rows)
        at += blocks
    start = np.cumsum(start)
    begins = order.sparkSession.createDataFrame(table, "cell int, _begin long, _first long")
    placed = scratch.save(order.join(F.broadcast(begins), "cell").select(
        "id", "v", "dp", (F.col("_first") + F.floor((F.col("_rank") - F.col("_begin")) / F.lit(rows))).cast("int").alias("block")))
    lo, hi, n = np.zeros(at), np.zeros(at), np.zeros(at, np.int64)
    for r in placed.groupBy("block").agg(F.min("dp").alias("lo"), F.max("dp").alias("hi"), F.count(F.lit(1)).alias("n")).collect():
        lo[r["block"]], hi[r["block"]], n[r["block"]] = r["lo"], r["hi"], r["n"]
    return placed, Rings(start, lo, hi, (np.cumsum(n) - n) // span)


def _met(queries: DataFrame, refs: DataFrame, k: int, rows: int) -> DataFrame:
    """The ``k`` nearest of the references of its block for every query (``id``,
    ``v``, ``block``), in units of at most about ``rows`` queries."""
    sent = queries.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias("parts"))
    asked = queries.join(sent, "block").withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
    held = refs.select("id", "v", "block").join(sent, "block") \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def block_knn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        qv, qid = _as_matrix(q["v"]), q["id"].to_numpy(np.int64)
        out = []
        for s in range(0, len(r), 4096):
            part = r.iloc[s:s + 4096]
            ids, partners, dists = _block_k_best(qv, _as_matrix(part["v"]), qid, part["id"].to_numpy(np.int64), k, own=True)
            out.append(pd.DataFrame({"id": ids, "paired": partners, "distance": dists}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "paired": [], "distance": []})

    unit = ["block", "part"]
    return asked.select("id", "v", *unit).groupBy(*unit).cogroup(held.select("id", "v", *unit).groupBy(*unit)) \
        .applyInPandas(block_knn, DISTANCE_SCHEMA)


def _nearer(qv: np.ndarray, qid: np.ndarray, bound: np.ndarray, dp: np.ndarray, rv: np.ndarray, rid: np.ndarray,
            ring: np.ndarray, lo: np.ndarray, hi: np.ndarray, k: int, skip: np.ndarray):
    """The ``k`` nearest references, none beyond its ``bound``, of every query
    (row, partner id, distance).  ``ring``: a reference's ring; ``dp``: the
    queries' distances to the rings' pivots; ``lo``, ``hi``: the rings'; ``skip``:
    a ring (or -1) that a query has already met."""
    bound = bound.copy()
    none = np.zeros(0, np.int64)
    row, partner, dist = none, none, np.zeros(0)
    begins = np.searchsorted(ring, np.arange(len(lo) + 1))
    rn = np.einsum("ij,ij->i", rv, rv)
    qn = np.einsum("ij,ij->i", qv, qv)
    at = 0
    while at < len(lo):  # some rings at once: as many as make a large matrix product
        end = max(at + 1, int(np.searchsorted(begins, begins[at] + 4096, side="right")) - 1)
        reach = _ring_gap(dp[:, at:end], lo[at:end], hi[at:end]) <= bound[:, None]
        reach &= skip[:, None] != np.arange(at, end)
        rows = np.flatnonzero(reach.any(axis=1))
        hit = np.flatnonzero(reach.any(axis=0)) + at
        at = end
        if not len(rows):
            continue
        all_refs = np.concatenate([np.arange(begins[i], begins[i + 1]) for i in hit])
        for s in range(0, len(all_refs), 4096):  # a ring may be larger
            refs = all_refs[s:s + 4096]
            far = bound[rows]
            limit = far * far + 1e-9 * (qn[rows] + rn[refs].max() + np.where(np.isfinite(far), far * far, 0)) + 1e-12
            d2 = qn[rows][:, None] + rn[refs][None, :] - 2.0 * (qv[rows] @ rv[refs].T)
            open_ = np.flatnonzero(~np.isfinite(far))  # no k references seen: its k smallest bound it
            if len(open_) and len(refs) > k:
                kth = np.partition(d2[open_], k - 1, axis=1)[:, k - 1]
                limit[open_] = kth + 2e-9 * (qn[rows][open_] + rn[refs].max()) + 1e-12
            r, c = np.nonzero(d2 <= limit[:, None])
            met = reach[rows[r], ring[refs[c]] - (end - reach.shape[1])]  # no reference of a ring that was skipped
            r, c = rows[r[met]], refs[c[met]]
            if not len(r):
                continue
            d = np.empty(len(r))
            step = max(1, (1 << 22) // qv.shape[1])
            for t in range(0, len(r), step):
                diff = rv[c[t:t + step]] - qv[r[t:t + step]]
                d[t:t + step] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            keep = d <= bound[r]
            row, partner, dist = (np.concatenate(x) for x in ((row, r[keep]), (partner, rid[c[keep]]), (dist, d[keep])))
            order = np.lexsort((partner, dist, row))
            row, partner, dist = row[order], partner[order], dist[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            kth = place == k - 1
            bound[row[kth]] = np.minimum(bound[row[kth]], dist[kth])
            row, partner, dist = row[place < k], partner[place < k], dist[place < k]
    return qid[row], partner, dist


def _met_spans(routed: DataFrame, placed: DataFrame, pivots, rings, k: int, rows: int) -> DataFrame:
    """The ``k`` nearest references of every ``routed`` query (``id``, ``v``,
    ``bound``, ``block`` it has met, ``spans`` to meet), in units of a span and
    at most about ``rows`` queries."""
    spark = placed.sparkSession
    asked = routed.select("id", "v", "bound", "block", F.explode("spans").alias("span"))
    sent = asked.groupBy("span").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).cast("int").alias("parts"))
    # a row a span: the queries' rows are sent once, to their units
    asked = asked.join(F.broadcast(sent), "span").withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
    # a row a block: ``max_blocks`` and the cells at most
    spans = spark.createDataFrame(pd.DataFrame({"block": np.arange(len(rings.value[3])), "span": rings.value[3]}),
                                  "block int, span int")
    held = placed.select("id", "v", "block").join(F.broadcast(spans), "block").join(sent, "span")         .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def span_knn(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"id": np.zeros(0, np.int64), "paired": np.zeros(0, np.int64), "distance": np.zeros(0)})]
        if len(q) and len(r):
            start, lo, hi, span = rings.value
            blocks = np.flatnonzero(span == r["span"].iloc[0])
            first = blocks[0]
            cells, cell = np.unique(np.searchsorted(start, blocks, side="right") - 1, return_inverse=True)
            r = r.sort_values(["block", "id"])
            rv, rid, ring = _as_matrix(r["v"]), r["id"].to_numpy(np.int64), r["block"].to_numpy(np.int64) - first
            q = q.sort_values("block")  # queries of one cell reach much the same rings
            for s in range(0, len(q), 512):
                part = q.iloc[s:s + 512]
                qv = _as_matrix(part["v"])
                ids, partners, dists = _nearer(qv, part["id"].to_numpy(np.int64), part["bound"].to_numpy(np.float64),
                                               _pairwise(qv, pivots.value[cells])[:, cell], rv, rid, ring, lo[blocks],
                                               hi[blocks], k, part["block"].to_numpy(np.int64) - first)
                out.append(pd.DataFrame({"id": ids, "paired": partners, "distance": dists}))
        return pd.concat(out)

    unit = ["span", "part"]
    return asked.select("id", "v", "bound", "block", *unit).groupBy(*unit)         .cogroup(held.select("id", "v", "block", *unit).groupBy(*unit)).applyInPandas(span_knn, DISTANCE_SCHEMA)


def _lists(cells: DataFrame, queries: DataFrame, pivots, k: int, block_rows: int, max_blocks: int, n_refs: int,
           scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(lists, nodes, routed)``: the ``k`` nearest references (of ``cells``) of
    every different vector of ``queries`` (both from :func:`_celled`), as
    ``(id, paired, distance)`` by the node's number; ``nodes`` (id, key); and
    the rows that were sent to further blocks."""
    spark = cells.sparkSession
    # of equal references only the k smallest ids can be among anyone's k nearest
    same = Window.partitionBy("key").orderBy("id")
    refs = cells.withColumn("_r", F.dense_rank().over(same)).filter(F.col("_r") <= k).drop("_r").dropDuplicates(["key", "id"])
    n_cells = len(pivots.value)
    # about two units a shuffle partition, as many parts of the queries as spans, of bounded size
    few = math.ceil(math.sqrt(2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    span = max(block_rows, min(-(-n_refs // few), SPAN_BYTES // (8 * max(1, pivots.value.shape[1]))))
    placed, found = _rings(refs, n_cells, max(block_rows, -(-n_refs // max_blocks)), span, scratch)
    # three numbers a block, ``max_blocks`` and the cells at most; plain arrays, so that workers need no package
    rings = spark.sparkContext.broadcast((found.start, found.lo, found.hi, found.span))
    nodes = scratch.save(queries.groupBy("key").agg(F.first("v").alias("v"), F.first("cell").alias("cell"),
                                                    F.first("dp").alias("dp"))
                         .withColumn("id", F.monotonically_increasing_id()))

    def at_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(block=Rings(*rings.value).home(b["cell"].to_numpy(), b["dp"].to_numpy()).astype("int32"))[["id", "v", "block"]]

    home = scratch.save(nodes.select("id", "v", "cell", "dp").mapInPandas(at_home, "id long, v array<double>, block int"))
    first = scratch.save(_met(home, placed, k, block_rows))
    bound = first.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("bound"))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in range(0, len(b), 4096):
                part = b.iloc[s:s + 4096].reset_index(drop=True)
                d = _pairwise(_as_matrix(part["v"]), pivots.value)
                bound = part["bound"].fillna(np.inf).to_numpy(dtype=float)
                row, block = Rings(*rings.value).within(d, bound)
                other = block != part["block"].to_numpy()[row]
                spans = [[] for _ in range(len(part))]
                for i, x in np.unique(np.stack([row[other], rings.value[3][block[other]]], axis=1), axis=0):
                    spans[i].append(int(x))
                yield part.assign(bound=bound, spans=spans)[["id", "v", "bound", "block", "spans"]]

    # a row a query: what it is sent to is a list
    routed = scratch.save(home.join(bound, "id", "left").select("id", "v", "block", "bound")
                          .mapInPandas(route, "id long, v array<double>, bound double, block int, spans array<int>")
                          .filter(F.size("spans") > 0))
    lists = k_nearest(first.unionAll(_met_spans(routed, placed, pivots, rings, k, span)), k)
    return lists, nodes.select("id", "key"), routed


def _pivots(pts: DataFrame, n: int, n_pivots: int | None):
    """Different vectors of the smallest id hashes (deterministic), broadcast.
    Four times as many are looked at, so that many equal vectors do not stand
    for many pivots."""
    few = max(1, min(n, n_pivots or math.ceil(math.sqrt(n))))
    rows = pts.orderBy(F.xxhash64("id"), "id").limit(4 * few).select("v").collect()
    _, first = np.unique(np.array([r["v"] for r in rows]), axis=0, return_index=True)
    return pts.sparkSession.sparkContext.broadcast(np.array([rows[i]["v"] for i in np.sort(first)[:few]]))


def nearest_vectors(df: DataFrame, k: int, id_col: str = "id", vec_col: str = "vector",
                    n_pivots: int | None = None, block_rows: int = 2048, invalid: str = "raise",
                    scratch: Scratch | None = None, max_blocks: int = 1_000_000) -> DataFrame:
    """Exact k nearest neighbours (Euclidean) of every vector among all
    other vectors: ``(id, paired, distance)``, ``k`` rows per id (fewer
    when there are fewer other vectors), ties to the smaller id.

    See the module notes for the plan.  ``n_pivots`` defaults to the square
    root of the number of vectors.  Rows without an id or a vector take no
    part; repeated rows count once; different vectors of one id are vectors of
    their own, none of which is listed for that id (so its lists can be
    shorter).  A vector with a NULL or non-finite element, or of another
    length than the rest, fails the job; ``invalid='drop'`` leaves vectors
    with such elements out instead.  Runs its own jobs while the plan is built
    (count, pivots, cells, rings); their tables go with ``scratch.release()``,
    or when the driver exits.
    """
    if invalid not in ("raise", "drop"):
        raise ValueError("invalid must be 'raise' or 'drop'")
    spark = df.sparkSession
    scratch = scratch or Scratch(spark)
    pts, n, _ = _points(df, id_col, vec_col, invalid)
    if not n:
        return spark.createDataFrame([], DISTANCE_SCHEMA)
    pivots = _pivots(pts, n, n_pivots)
    cells = scratch.save(_celled(pts, pivots, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    # k + 1: a member finds itself in its vector's list, or k others
    lists, nodes, _ = _lists(cells, cells, pivots, k + 1, block_rows, max_blocks, n, scratch)
    near = _members(lists, nodes, cells)
    others = F.filter("near", lambda x: x["paired"] != F.col("id"))
    return near.select("id", F.explode(F.slice(others, 1, k)).alias("x")).select("id", "x.paired", "x.distance")


def _members(lists: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """``(id, near)``: every row's list (a struct array, nearest first), that of its vector."""
    near = F.array_sort(F.collect_list(F.struct("distance", "paired"))).alias("near")  # k of them
    of = lists.groupBy("id").agg(near).withColumnRenamed("id", "_n").join(nodes.withColumnRenamed("id", "_n"), "_n")
    return rows.select("id", "key").distinct().join(of.select("key", "near"), "key").select("id", "near")


def nearest_between(queries: DataFrame, refs: DataFrame, k: int, query_id: str = "id", query_vec: str = "vector",
                    ref_id: str = "id", ref_vec: str = "vector", n_pivots: int | None = None, block_rows: int = 2048,
                    invalid: str = "raise", scratch: Scratch | None = None, max_blocks: int = 1_000_000) -> DataFrame:
    """Exact k nearest references of every query vector (new rows against a
    table): ``(id, paired, distance)``, ties to the smaller reference id.

    The collections are independent: an equal id on both sides means nothing,
    and a reference equal to a query is its neighbour at distance 0.  Pivots,
    cells and rings are the references'; a query's bound comes from the block
    it falls into.  Rows without an id or vector take no part, repeated rows
    count once, invalid vectors of either side are treated as in
    :func:`nearest_vectors`; no references give no rows.
    """
    if invalid not in ("raise", "drop"):
        raise ValueError("invalid must be 'raise' or 'drop'")
    spark = refs.sparkSession
    scratch = scratch or Scratch(spark)
    pts, n, length = _points(refs, ref_id, ref_vec, invalid)
    asked, m, width = _points(queries, query_id, query_vec, invalid)
    if not n or not m:
        return spark.createDataFrame([], DISTANCE_SCHEMA)
    if length != width:
        raise ValueError(f"queries of length {width}, references of length {length}")
    pivots = _pivots(pts, n, n_pivots)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = scratch.save(_celled(pts, pivots, tasks))
    rows = scratch.save(_celled(asked, pivots, tasks))
    lists, nodes, _ = _lists(cells, rows, pivots, k, block_rows, max_blocks, n, scratch)
    return _members(lists, nodes, rows).select("id", F.explode("near").alias("x")).select("id", "x.paired", "x.distance")
