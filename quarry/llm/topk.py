"""Exact top-k search by inner product over tiles.

Queries and candidate shards become tiles: one row with the ids and the
matrix of up to a few thousand vectors as bytes, of 2 or 4 bytes a number
where that is enough.  Every (query tile, shard tile) pair is one matrix product
with a partial selection, so a task holds two tiles and their scores whatever
the input.  A query tile is sent once to a group of shard tiles, never to all
executors; its top lists merge as a tree, first where they are made, then
within groups of shard tiles, then across them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Products and sums of integers stay exact in doubles below this magnitude.
_EXACT = float(1 << 53)
_TILE = "_tile int, _dim int, _ids binary, _mat binary"
#: Groups of shard tiles: a query tile has a copy for each.  More shard tiles
#: make larger groups, up to so many tiles, and only then more groups.
GROUPS, GROUPED = 128, 64


def usable(vector: Column) -> Column:
    """No null, no null component, no NaN or infinity."""
    v = vector.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & ~bad, F.lit(False))


def quantise(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component as whole doubles (``x`` taken as
    double, so huge components do not overflow here)."""
    return F.transform(vector.cast("array<double>"), lambda x: _floor(F.lit(float(scale)) * x))


def _floor(x: Column) -> Column:
    whole = F.rint(x)
    return F.when(whole > x, whole - 1.0).otherwise(whole)


def _packed(mat) -> bytes:
    """Whole doubles in 2 or 4 bytes each if all of them fit, else as they are."""
    most = np.abs(mat).max() if mat.size else 0
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64
    return mat.astype(kind).tobytes()


def _unpacked(mat: bytes, n: int, dim: int):
    kind = {2: np.int16, 4: np.int32}.get(len(mat) // max(1, n * dim), np.float64)
    return np.frombuffer(mat, kind).reshape(n, dim).astype(np.float64)


def _tiles(rows: DataFrame, tile_rows: int, n: int) -> DataFrame:
    """Rows ``(id, v)`` packed into tiles of about ``tile_rows`` rows of equal
    length; one output row a tile."""
    parts = max(1, math.ceil(n / tile_rows))

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        mat = np.stack([np.asarray(v, dtype=np.float64) for v in pdf["v"]]) if len(pdf) else np.zeros((0, 0))
        return pd.DataFrame({"_tile": [int(key[0])], "_dim": [int(key[1])],
                             "_ids": [pdf["id"].to_numpy(np.int64).tobytes()], "_mat": [_packed(mat)]})

    return rows.withColumn("_tile", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")) \
        .withColumn("_dim", F.size("v")).groupBy("_tile", "_dim").applyInPandas(pack, _TILE)


def tile_best(q_ids, q, c_ids, c, k: int):
    """The ``k`` best candidates of every query of a tile, ties to the smaller
    id, never the query's own id, an id with its best vector only: (query ids,
    candidate ids, scores)."""
    return _tile_best(q_ids, q, c_ids, c, k)[1:]


def _tile_best(q_ids, q, c_ids, c, k: int):
    """:func:`tile_best` with the queries' rows in front."""
    none = (np.zeros(0, np.int64),) * 4
    if not len(q_ids) or not len(c_ids):
        return none
    by_id = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[by_id], c[by_id]
    dim = max(1, q.shape[1])
    if q.size == 0 or np.abs(q).max() * np.abs(c).max() * dim < _EXACT:
        score = q @ c.T
    else:  # beyond a double's whole numbers: Python's integers, exact at any size, kept in a long
        to_int = np.vectorize(int, otypes=[object])
        whole = to_int(q).dot(to_int(c).T)
        score = np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(object)
    first = np.flatnonzero(np.r_[True, c_ids[1:] != c_ids[:-1]])
    if len(first) < len(c_ids):  # one score an id, before any is left out
        score, c_ids = np.maximum.reduceat(score, first, axis=1), c_ids[first]
    out = []
    for i in range(len(q_ids)):
        row = score[i]
        own = np.searchsorted(c_ids, q_ids[i]), np.searchsorted(c_ids, q_ids[i], side="right")
        left = np.concatenate([np.arange(own[0]), np.arange(own[1], len(c_ids))]) if own[0] < own[1] else None
        vals = row if left is None else row[left]
        m = min(k, len(vals))
        if m == 0:
            continue
        if vals.dtype == object:
            best = np.array(sorted(range(len(vals)), key=lambda j: (-vals[j], j))[:m])
        else:
            kth = np.partition(vals, len(vals) - m)[len(vals) - m]
            near = np.flatnonzero(vals >= kth)  # ascending ids, so a stable sort breaks ties to the smaller
            best = near[np.argsort(-vals[near], kind="stable")[:m]]
        picked = best if left is None else left[best]
        out.append((np.full(m, i), np.full(m, q_ids[i]), c_ids[picked],
                    np.array([int(x) for x in vals[best]], dtype=np.int64)))
    if not out:
        return none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _merged(lists: list, k: int):
    """Top lists of the same queries, each query's ``k`` best of all: a query has
    one row of a tile, so its rows are told apart by id and place in the tile."""
    if len(lists) == 1:
        return lists[0][1:]
    row, q_ids, c_ids, score = (np.concatenate(x) for x in zip(*lists, strict=True))
    order = np.lexsort((c_ids, ~score, row))  # ~: descending, without the overflow of a minus
    row = row[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
    keep = order[place < k]
    return q_ids[keep], c_ids[keep], score[keep]


def top_k(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "id", vec_col: str = "vector",
          query_tile: int = 2048, shard_tile: int = 2048, merge: int = 32, scale: int = 256) -> DataFrame:
    """The ``k`` candidates of highest integer inner product for every query:
    ``(query_id, rank, vec_id, score)``, all if there are fewer, ties to the
    smaller id.

    Components are quantised to ``floor(scale * x)``; sums are exact (whole
    numbers beyond 64 bits are held at the ends of a long's range).  Rows with
    a null id, a null vector, or a null or non-finite component take no part.
    A query's own id is never its candidate.  Only vectors of equal length
    are compared.  Rows repeating an id and vector count once; with one id on
    several vectors, each is a candidate and each a query, and an id keeps
    its best score only.  Empty tables give no rows; extra columns are ignored.

    Work is (queries x candidates) / tiles; a query tile travels to every
    group of shard tiles, at most ``GROUPS`` while a group has fewer than
    ``GROUPED`` tiles.  Nothing is broadcast and every unit has a fixed size.
    """
    def rows(df: DataFrame) -> DataFrame:
        v = F.col(f"`{vec_col}`")
        return df.filter(F.col(f"`{id_col}`").isNotNull() & usable(v)) \
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), quantise(v, scale).alias("v"))

    q, c = rows(queries), rows(candidates)
    n_c, n_q = c.count(), q.count()
    shards = _tiles(c.distinct(), shard_tile, n_c)
    blocks = _tiles(q.distinct(), query_tile, n_q)
    # a query tile goes to every group of shard tiles of its length
    n_shards = max(1, math.ceil(n_c / shard_tile))
    per = min(GROUPED, math.ceil(n_shards / GROUPS))
    pairs = blocks.select(F.col("_tile").alias("_qtile"), "_dim", F.col("_ids").alias("_qids"),
                          F.col("_mat").alias("_qmat")) \
        .withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit((n_shards - 1) // per))))
    grouped = shards.withColumn("_to", F.expr(f"_tile div {per}").cast("int"))
    # merge: the copies of query tiles are not in the planner's estimate, and a broadcast holds them all;
    # the left side is streamed, so the rows of a query tile and a group follow each other
    joined = pairs.hint("merge").join(grouped.hint("merge"), ["_to", "_dim"])

    def score(batches):
        held, at = [], None  # lists of one query tile that are not given out yet, and its key

        def given(lists, part):
            a, v, s = _merged(lists, k)
            return pd.DataFrame({"query_id": a, "vec_id": v, "score": s, "_part": np.full(len(a), part)})
        for b in batches:
            for dim, qt, qi, qm, tile, ci, cm in zip(b["_dim"], b["_qtile"], b["_qids"], b["_qmat"], b["_tile"],
                                                     b["_ids"], b["_mat"], strict=True):
                if held and at != (qt, dim, tile // merge):
                    yield given(held, at[2])
                    held = []
                if not held:  # else the same queries as before
                    at, q_ids = (qt, dim, tile // merge), np.frombuffer(qi, np.int64)
                    q_mat = _unpacked(qm, len(q_ids), dim)
                c_ids = np.frombuffer(ci, np.int64)
                held.append(_tile_best(q_ids, q_mat, c_ids, _unpacked(cm, len(c_ids), dim), k))
        if held:
            yield given(held, at[2])

    lists = joined.select("_dim", "_qtile", "_qids", "_qmat", "_tile", "_ids", "_mat") \
        .mapInPandas(score, "query_id long, vec_id long, score long, _part int")

    def best(df: DataFrame, *by: str) -> DataFrame:
        df = df.groupBy(*by, "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id"))
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    return best(best(lists, "query_id", "_part"), "query_id").select("query_id", "rank", "vec_id", "score")
