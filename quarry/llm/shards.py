"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points on a ring of hash values; a key
belongs to the arc that ends at the next point clockwise.  Loads are bounded
(Mirrokni, Thorup, Zadimoghaddam, SODA 2018): a key whose shard is full goes
on clockwise to the next shard with room.  Only arc counts reach the driver
(``shards * virtual_nodes`` numbers, a fixed size): the walk around the ring
hands *intervals of an arc's ranks* to shards, and a join puts every key
into its interval.  The rows themselves never leave Spark's columns.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import spread_rank

RING_BITS = 40
RING = 1 << RING_BITS


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """``(position, shard)`` of every virtual node, ascending.  A point depends
    on its shard's number and its own only, so a shard more adds points and
    moves none."""
    return sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:5], "big"), s)
                  for s in range(shards) for v in range(virtual_nodes))


def key_position(*cols: str | Column) -> Column:
    """A key's place on the ring."""
    return F.pmod(F.xxhash64(*cols), F.lit(RING))


def arc_of(position: Column, points: list[tuple[int, int]]) -> Column:
    """Number of the arc (index of the first point at or after ``position``,
    round the ring).  The ring is cut into equal cells, and only the few
    points inside the key's cell are compared with it; both lists are
    literals of a size that the ring fixes."""
    def literal(numbers: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>")

    at = [p for p, _ in points]
    cells = 1 << (2 * len(at) - 1).bit_length()
    width = RING // cells
    first = [bisect.bisect_left(at, c * width) for c in range(cells + 1)]
    most = max(hi - lo for lo, hi in zip(first, first[1:], strict=False))
    start = F.element_at(literal(first), (F.floor(position / F.lit(width)) + 1).cast("int")).cast("int")
    near = F.slice(literal([*at, *[RING] * most]), start + 1, max(1, most))
    return F.pmod(start + F.size(F.filter(near, lambda p: p < position)), F.lit(len(at))).cast("int")


def bounded_walk(counts: list[int], owner: list[int], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """Hand every arc's ranks to shards: ``(arc, from_rank, to_rank, shard)``.

    First each arc gives its own shard what fits (arcs in ring order); what
    overflows goes on clockwise, arc by arc, to the next shards with room.
    """
    if sum(capacity) < sum(counts):
        raise ValueError("the shards have less room than there are keys")
    n = len(counts)
    room = list(capacity)
    out: list[tuple[int, int, int, int]] = []
    rest: list[tuple[int, int]] = []
    for arc in range(n):
        take = min(counts[arc], room[owner[arc]])
        if take:
            out.append((arc, 0, take, owner[arc]))
            room[owner[arc]] -= take
        if take < counts[arc]:
            rest.append((arc, take))
    for arc, at in rest:
        step = arc
        while at < counts[arc]:
            step = (step + 1) % n
            take = min(counts[arc] - at, room[owner[step]])
            if take:
                out.append((arc, at, at + take, owner[step]))
                room[owner[step]] -= take
                at += take
    return sorted(out)


def ring_shards(df: DataFrame, keys: list[str], shards: int = 40, virtual_nodes: int = 64,
                slack: float = 0.0, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Assign every row of ``df`` to a shard; adds ``shard`` and ``slot``.

    ``slack`` 0: capacities are the row counts split as evenly as whole rows
    allow, so shard sizes differ by one at most.  Above 0 every shard may
    hold ``(1 + slack)`` times the mean, and fewer keys move when a shard is
    added.  Slots are gapless from 0 in each shard.  Rows are ordered inside
    an arc by ring position, then ``keys``; repeated rows are equal there, and
    any of them may get either slot.  Null keys hash like any value (all to
    one place), empty tables give no rows, and other columns pass through
    (an input column named like an output is replaced).

    One pass counts the arcs, a second ranks the rows inside them.
    """
    if shards < 1 or virtual_nodes < 1 or slack < 0:
        raise ValueError("shards and virtual_nodes must be at least 1, slack at least 0")
    spark = df.sparkSession
    points = ring_points(shards, virtual_nodes)
    owner = [s for _, s in points]
    kept = df.drop(shard, slot)
    # the row as one value: no column of the input can meet one of the plan
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"),
                       key_position(*[F.col(f"`{k}`") for k in keys]).alias("pos")) \
        .withColumn("arc", arc_of(F.col("pos"), points))
    counts = [0] * len(points)
    for r in rows.groupBy("arc").count().collect():  # at most shards * virtual_nodes rows
        counts[r["arc"]] = r["count"]
    total = sum(counts)
    if slack:
        capacity = [-(-int(total * (1 + slack) + shards) // shards)] * shards
    else:
        capacity = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    spans = []
    for arc, lo, hi, s in bounded_walk(counts, owner, capacity):
        spans.append((arc, lo, hi, s, used[s]))
        used[s] += hi - lo
    table = spark.createDataFrame(spans, "arc int, lo long, hi long, shard int, base long")
    # an arc holds a small share of the keys; its parts by position leave repeated keys the only large ones
    ranked = spread_rank(rows, ["arc"], [F.col("pos"), *[F.col(f"row.`{k}`") for k in keys]],
                         F.pmod(F.col("pos"), F.lit(16)).cast("int"), 16, "rank")
    # the interval table has at most shards * (virtual_nodes + shards) rows, whatever the input
    both = ranked.alias("r").join(F.broadcast(table).alias("t"), (F.col("r.arc") == F.col("t.arc"))
                                  & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    return both.select("row.*", F.col("t.shard").alias(shard),
                       (F.col("t.base") + F.col("rank") - F.col("lo")).alias(slot))
