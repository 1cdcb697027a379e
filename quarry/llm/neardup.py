"""Near-duplicate vectors by NN-descent on a neighbour graph.

Equal vectors are one node.  The graph starts from a forest: each tree sorts
the nodes by random hyperplane signs and takes nearest neighbours inside short
runs.  Then neighbours of neighbours meet (Dong, Moses, Li, WWW 2011): a node's
list and those that list it come together, every pair of them is measured, and
lists keep the best.  A list full of threshold neighbours is saturated and
grows, to a bound.  Connectivity does not depend on lists: wherever nodes meet,
a spanning forest of their threshold pairs is kept apart.  After saturated
lists the search goes on between components only, with lists of their own for
neighbours in other components, until that joins nothing more.  Recall is
audited against brute force for a sample; below the target, more trees and
rounds follow, and at last an exact pass over tiles of all pairs.

Links found by the graph give the components.  Inside a component every pair
is then measured in tiles, so a node's links are counted in full without one
row per pair, however dense the group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder, components
from quarry.llm.topk import usable

_EDGE = "u long, v long, sim double"


def _unit(vectors: list) -> list[bytes]:
    out = []
    for v in vectors:
        x = np.asarray(v, dtype=np.float64)
        x = x / np.abs(x).max()  # no overflow in the square
        out.append((x / np.sqrt(x @ x)).tobytes())
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def _by_length(b: pa.RecordBatch):
    """The batch's rows by vector length (``dim``)."""
    dims = b.column(b.schema.get_field_index("dim")).to_numpy()
    for d in np.unique(dims):
        yield b.filter(pa.array(dims == d))


def unit_vectors(rows: DataFrame) -> DataFrame:
    """``v`` (array) replaced by its direction as bytes of doubles; other columns stay."""
    at = rows.columns.index("v")

    def scan(batches):
        for b in batches:
            new = pa.array(_unit(b.column(at).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([new if i == at else b.column(i) for i in range(b.num_columns)],
                                             b.schema.names)

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("v", T.BinaryType()) if f.name == "v" else f for f in rows.schema.fields])
    return rows.mapInArrow(scan, schema)


def _runs(batches, keys: int, limit: int | None = None):
    """Record batches of whole runs of equal leading ``keys`` columns in sorted
    input, or of ``limit`` rows of a run."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_pylist() for i in range(keys)]
        names = list(zip(*cols, strict=True))
        edges = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
        at = 0
        for end in [*edges, len(names)]:
            if held and names[at] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(at, end - at))
            last = names[at]
            at = end
            while limit and sum(h.num_rows for h in held) >= limit:
                whole = pa.Table.from_batches(held).combine_chunks()
                yield whole.slice(0, limit)
                rest = whole.slice(limit)
                held = rest.to_batches() if rest.num_rows else []
    if held:
        yield pa.Table.from_batches(held)


def _best(sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` best finite entries of every row."""
    n = sim.shape[1]
    if n > k:
        top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    else:
        top = np.broadcast_to(np.arange(n), sim.shape)
    row = np.repeat(np.arange(len(sim)), top.shape[1])
    col = top.ravel()
    ok = np.isfinite(sim[row, col])
    return row[ok], col[ok]


def _spanning(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of a spanning forest of the symmetric matrix ``near``."""
    left = near.any(axis=1)
    rows, cols = [], []
    for start in np.flatnonzero(left):
        queue = [start] if left[start] else []
        left[start] = False
        while queue:
            a = queue.pop()
            new = np.flatnonzero(near[a] & left)
            left[new] = False
            rows.append(np.full(len(new), a))
            cols.append(new)
            queue.extend(new)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(cols)


def _kept(sim: np.ndarray, worst, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` best of every row from ``worst`` on, and of a
    spanning forest of all pairs of at least ``threshold``."""
    a, b = _spanning(sim >= threshold)
    r, c = _best(np.where(sim < worst, -np.inf, sim), k)
    return np.concatenate([r, a]), np.concatenate([c, b])


def _edges(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(sim)], ["u", "v", "sim"])


def forest_edges(nodes: DataFrame, trees: range, leaf: int, k: int, floor: float, threshold: float, n: int,
                 seed: int) -> DataFrame:
    """Directed edges of at least ``floor`` between nodes of different ``c`` from
    runs of ``leaf`` nodes in every tree's order: ``k`` a node and tree, and
    what connects all pairs of ``threshold`` in a run."""
    bits = max(1, min(24, math.ceil(math.log2(max(2, n / leaf)))))

    def code(batches):
        for b in (part for whole in batches for part in _by_length(whole)):
            x = _matrix(b.column(b.schema.get_field_index("v")))
            for t in trees:
                planes = np.random.default_rng([seed, t, x.shape[1]]).standard_normal((x.shape[1], bits + 1))
                p = x @ planes
                sign = ((p[:, :bits] > 0) * (1 << np.arange(bits)[::-1])).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, t, np.int32)), b.column(0), b.column(1), pa.array(sign.astype(np.int64)),
                     pa.array(p[:, bits]), b.column(2), b.column(3), b.column(4)],
                    ["tree", "key", "dim", "code", "place", "nid", "c", "v"])

    schema = "tree int, key string, dim int, code long, place double, nid long, c long, v binary"
    order = ["tree", "key", "dim", "code", "place", "nid"]
    placed = nodes.select("key", "dim", "nid", "c", "v").mapInArrow(code, schema) \
        .repartitionByRange(*order).sortWithinPartitions(*order)

    def near(batches):
        for run in _runs(batches, 3, leaf):
            if run.num_rows < 2:
                continue
            run = run.combine_chunks()
            x = _matrix(run.column("v").combine_chunks())
            ids = run.column("nid").to_numpy()
            of = run.column("c").to_numpy()
            sim = x @ x.T
            sim[of[:, None] == of[None, :]] = -np.inf
            r, c = _kept(sim, floor, k, threshold)
            if len(r):
                yield _edges(ids[r], ids[c], sim[r, c])

    return placed.mapInArrow(near, _EDGE)


def trim(edges: DataFrame, k: int, grow: int, threshold: float) -> DataFrame:
    """Lists of the ``k`` best neighbours; a list saturated by neighbours of
    ``threshold`` keeps ``grow`` times as many of them.  ``old`` tells edges
    that have met before; ``far`` ones, into another component, have a list of
    their own."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.max("old").alias("old"), F.max("far").alias("far"))
    order = Window.partitionBy("u", "far").orderBy(F.col("sim").desc(), F.col("v"))
    rank = F.row_number().over(order)
    return once.withColumn("rank", rank).filter(F.col("rank") <= k * grow) \
        .filter((F.col("rank") <= k) | (F.col("sim") >= threshold)).select("u", "v", "sim", "old", "far")


def descend(nodes: DataFrame, edges: DataFrame, k: int, grow: int, floor: float, threshold: float) -> DataFrame:
    """One round of neighbours of neighbours: directed candidate edges from the
    pairs of different ``c`` that meet at a node, one of them new there, and
    what connects all such pairs of ``threshold``."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim", "old", "far")
    order = Window.partitionBy("u", "far").orderBy(F.col("sim").desc(), F.col("v"))
    back = back.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k * grow).drop("rank")
    both = edges.unionAll(back).groupBy("u", "v").agg(F.min("old").alias("old"))
    # at least one new neighbour must stand at the node, else nothing can meet there
    live = both.groupBy("u").agg(F.min("old").alias("all_old"), F.count(F.lit(1)).alias("m")) \
        .filter((F.col("all_old") == 0) & (F.col("m") > 1)).select("u")
    full = edges.filter(F.col("far") == 1).groupBy("u").agg(F.count(F.lit(1)).alias("m"), F.min("sim").alias("least")) \
        .select(F.col("u").alias("nid"), F.when(F.col("m") >= k, F.col("least")).otherwise(floor).alias("worst"))
    vectors = nodes.select("nid", "c", "v").join(full, "nid", "left").select(
        F.col("nid").alias("v"), F.col("v").alias("x"), F.coalesce("worst", F.lit(floor)).alias("worst"), "c")
    met = both.join(live, "u").join(vectors, "v").select("u", "v", "old", "worst", "c", "x")

    def meet(batches):
        for run in _runs(batches, 1):
            if run.num_rows < 2:
                continue
            run = run.combine_chunks()
            x = _matrix(run.column("x").combine_chunks())
            ids, old = run.column("v").to_numpy(), run.column("old").to_numpy()
            worst, of = run.column("worst").to_numpy(), run.column("c").to_numpy()
            sim = x @ x.T
            sim[(of[:, None] == of[None, :]) | (old[:, None] + old[None, :] == 2)] = -np.inf
            r, c = _kept(sim, np.maximum(floor, worst)[:, None], k, threshold)
            if len(r):
                yield _edges(ids[r], ids[c], sim[r, c])

    return met.repartition("u").sortWithinPartitions("u", "v").mapInArrow(meet, _EDGE)


def audit(nodes: DataFrame, threshold: float, sample: int, small: int = 8) -> list[tuple[int, int]]:
    """``(complete, linked)`` nodes of two bounded samples, against brute force
    over all nodes: of nodes whose component ``c`` has at most ``small`` nodes,
    and of the others.  ``linked`` have a true link; ``complete`` ones have
    every true link inside their component, where every pair is measured
    afterwards.  A node counts once however many links it has, so a dense
    group cannot outweigh isolated pairs."""
    sizes = nodes.groupBy("c").agg((F.count(F.lit(1)) <= small).alias("few"))
    of = nodes.select("nid", "c").join(sizes, "c").select("nid", "few")
    order = [F.xxhash64("nid"), "nid"]
    ids = of.filter("few").orderBy(*order).limit(sample).unionAll(of.filter(~F.col("few")).orderBy(*order).limit(sample))
    few = {r["nid"]: r["few"] for r in ids.collect()}
    some = nodes.join(F.broadcast(ids.select("nid")), "nid").select("key", "dim", "nid", "c", "v").collect()
    groups: dict[tuple, list] = {}
    for r in some:
        groups.setdefault((r["key"], r["dim"]), []).append((r["nid"], r["c"], bytes(r["v"])))
    held = {g: (np.array([i for i, _, _ in x]), np.array([c for _, c, _ in x]),
                np.frombuffer(b"".join(v for _, _, v in x)).reshape(len(x), -1))
            for g, x in groups.items() if g[1]}

    def measure(batches):
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            ids, of = b.column(2).to_numpy(), b.column(3).to_numpy()
            for g in set(keys) & set(held):
                mine = np.array([i for i, x in enumerate(keys) if x == g])
                x = _matrix(b.column(4).take(pa.array(mine)))
                u, c, v = held[g]
                near = (v @ x.T >= threshold) & (u[:, None] != ids[mine][None, :])
                lost = (near & (c[:, None] != of[mine][None, :])).any(axis=1)
                hit = near.any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(u[hit]), pa.array(lost[hit])], ["u", "lost"])

    true = nodes.select("key", "dim", "nid", "c", "v").mapInArrow(measure, "u long, lost boolean") \
        .groupBy("u").agg(F.max("lost").alias("lost")).collect()
    return [(sum(few[r["u"]] == kind and not r["lost"] for r in true), sum(few[r["u"]] == kind for r in true))
            for kind in (True, False)]


def exact_links(nodes: DataFrame, threshold: float, tile: int = 1024) -> DataFrame:
    """``(u, v)``: links that connect all pairs of ``nodes`` of at least
    ``threshold`` in different ``c``, from every pair of tiles: the whole
    search, quadratic in time, with less than two links a node and tile pair."""
    by = ["key", "dim"]
    sizes = nodes.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    cut = nodes.join(sizes, by).withColumn("t", F.pmod(F.xxhash64("nid", F.lit(1)), F.col("tiles")).cast("int")) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    keys = [*by, "lo", "hi"]
    pairs = cut.select(*by, F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"), "nid", "c", "v") \
        .repartition(*keys).sortWithinPartitions(*keys, "nid")

    def measure(batches):
        for run in _runs(batches, 4):
            run = run.combine_chunks()
            x = _matrix(run.column("v").combine_chunks())
            ids, of = run.column("nid").to_numpy(), run.column("c").to_numpy()
            a, b = _spanning((x @ x.T >= threshold) & (of[:, None] != of[None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["u", "v"])

    return pairs.mapInArrow(measure, "u long, v long")


def count_links(members: DataFrame, threshold: float, tile: int = 1024) -> DataFrame:
    """``(nid, links)``: for every member ``(c, nid, m, v)`` of a component the
    vectors of its other members (``m`` each) within ``threshold``.  A large
    component is cut into tiles that meet in pairs."""
    sizes = members.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    cut = members.join(sizes, "c").withColumn("t", F.pmod(F.xxhash64("nid", F.lit(1)), F.col("tiles")).cast("int")) \
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    keys = ["c", "lo", "hi"]
    pairs = cut.select("c", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"), "t", "nid", "m", "v") \
        .repartition(*keys).sortWithinPartitions(*keys, "t", "nid")

    def measure(batches):
        for run in _runs(batches, 3):
            run = run.combine_chunks()
            lo, hi = run.column("lo")[0].as_py(), run.column("hi")[0].as_py()
            x = _matrix(run.column("v").combine_chunks())
            ids, m, t = (run.column(n).to_numpy() for n in ("nid", "m", "t"))
            if lo == hi:
                near = x @ x.T >= threshold
                np.fill_diagonal(near, False)
                total = near @ m
            else:
                a, b = t == lo, t == hi
                near = x[a] @ x[b].T >= threshold
                total = np.zeros(len(ids), np.int64)
                total[a], total[b] = near @ m[b], near.T @ m[a]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total.astype(np.int64))], ["nid", "links"])

    return pairs.mapInArrow(measure, "nid long, links long").groupBy("nid").agg(F.sum("links").alias("links"))


def near_vectors(df: DataFrame, work: WorkFolder, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", threshold: float = 0.98, k: int = 8, grow: int = 4, trees: int = 6,
                 leaf: int = 256, rounds: int = 4, sample: int = 512, recall: float = 0.995, attempts: int = 3,
                 seed: int = 7) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Rows link when their labels are equal and their cosine (doubles) is at
    least ``threshold``.  Null vectors, null labels, null or non-finite
    components and zero vectors link with nothing; so do vectors of different
    lengths, and empty ones.  ``n_links`` counts rows, copies included;
    ``component_id`` is the smallest id reachable.  Repeated rows are vectors
    of their own that link with each other; rows with a null id link, and are
    never ``kept``.  Extra columns are ignored; an empty table gives no rows.

    The graph search is approximate: ``audit`` measures it on ``sample`` nodes
    of small components and as many others, and up to ``attempts`` times more trees are grown
    until ``recall`` (the share of linked nodes with no link lost) is met in
    both and, with full lists, an attempt between components joins nothing.  If
    ``attempts`` do not suffice, all pairs of different components are
    measured in tiles, so the result is then exact.
    """
    work = work.scope()
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("key"),
                     F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    some = usable(F.col("v")) & F.col("key").isNotNull() & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    vectors = unit_vectors(rows.filter(some).withColumn("dim", F.size("v"))) \
        .withColumn("nid", F.xxhash64("key", "dim", "v"))
    vectors = work.save(vectors, "vectors")
    nodes = work.save(vectors.groupBy("key", "dim", "nid").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("rep")), "nodes")
    n = nodes.count()
    floor = -1.0  # lists hold the nearest whatever their cosine: isolated pairs are reached over them
    edges = part = None

    def join_up(links: DataFrame) -> DataFrame:
        """``(node, component)`` by the links so far and new ones."""
        if part is not None:
            links = links.unionAll(part.select(F.col("node").alias("u"), F.col("component").alias("v")))
        return work.save(components(links, work, "u", "v"), "part")

    def placed() -> DataFrame:
        """The nodes with the component so far as ``c``."""
        if part is None:
            return nodes.withColumn("c", F.col("nid"))
        return nodes.join(part.withColumnRenamed("node", "nid"), "nid", "left") \
            .withColumn("c", F.coalesce("component", "nid")).drop("component")

    for attempt in range(attempts):
        at = work.save(placed(), "placed")
        raw = [work.save(forest_edges(at, range(attempt * trees, (attempt + 1) * trees), leaf, k, floor, threshold, n,
                                      seed), "found")]
        new = lambda: raw[-1].withColumns({"old": F.lit(0), "far": F.lit(1)})
        known = new()
        if edges is not None:  # lists stay to walk on; all meet again, now for pairs of different components
            of = at.select("nid", "c")
            known = known.unionAll(
                edges.join(of.toDF("u", "cu"), "u").join(of.toDF("v", "cv"), "v").select(
                    "u", "v", "sim", F.lit(0).alias("old"), (F.col("cu") != F.col("cv")).cast("int").alias("far")))
        nxt = work.save(trim(known, k, grow, threshold), "edges")
        if edges is not None:
            work.drop(edges)
        edges = nxt
        size = edges.count()
        for _ in range(rounds):
            raw.append(work.save(descend(at, edges, k, grow, floor, threshold), "found"))
            nxt = work.save(trim(edges.withColumn("old", F.lit(1)).unionAll(new()), k, grow, threshold), "edges")
            work.drop(edges)
            edges = nxt
            if edges.filter(F.col("old") == 0).count() <= 0.001 * size:
                break
        links = raw[0]
        for r in raw[1:]:
            links = links.unionAll(r)
        links = links.filter(F.col("sim") >= threshold).select("u", "v")
        joined = bool(links.head(1))
        nxt = join_up(links)
        for t in (part, at, *raw):
            if t is not None:
                work.drop(t)
        part = nxt
        if joined and attempt == 0:  # only full lists can hide links of other components
            joined = bool(edges.filter(F.col("sim") >= threshold).groupBy("u").count().filter(F.col("count") >= k).head(1))
        if not joined and all(found >= recall * true for found, true in audit(placed(), threshold, sample, k)):
            break
    else:
        at = work.save(placed(), "placed")
        nxt = join_up(exact_links(at, threshold))
        work.drop(part)
        part = nxt
    members = nodes.join(part.withColumnRenamed("node", "nid"), "nid").select(
        F.col("component").alias("c"), "nid", "m", "v")
    counts = work.save(count_links(members, threshold), "counts")
    ids = nodes.join(part.withColumnRenamed("node", "nid"), "nid", "left") \
        .select("nid", "m", "rep", F.coalesce("component", "nid").alias("c"))
    least = ids.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = work.save(ids.join(least, "c").join(counts, "nid", "left").select(
        "nid", "component_id", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    work.keep(vectors, named)
    known = vectors.select("vec_id", "nid").join(named, "nid").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~some).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionAll(alone).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
