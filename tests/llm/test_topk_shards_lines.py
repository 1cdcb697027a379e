"""Exact top-k, ring shards, line dedup: brute force and odd inputs."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from quarry.llm import lines, shards, topk
from quarry.llm.common import components, spread_rank
from pyspark.sql import functions as F


def brute_top(queries, rows, k):
    out = []
    good = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    rows = {(i, tuple(v)) for i, v in rows if i is not None and good(v)}
    for q, v in {(i, tuple(v)) for i, v in queries if i is not None and good(v)}:
        a = [math.floor(256 * x) for x in v]
        best = {}
        for i, w in rows:
            if i != q and len(w) == len(v):
                s = sum(x * math.floor(256 * y) for x, y in zip(a, w))
                best[i] = max(best.get(i, s), s)
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n + 1, i, s) for n, (i, s) in enumerate(top)]
    return sorted(out)


def test_top_k_equals_brute_force_with_ties_nulls_and_ragged_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.9]) for _ in range(4)]) for i in range(150)]
    rows += [(200, None), (201, [1.0, None, 0.0, 0.0]), (202, [float("nan")] * 4), (203, [float("inf")] * 4),
             (None, [1.0] * 4), (204, [0.5, 0.5]), (205, [0.25, -1.0]), (7, rows[7][1]), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")) \
        .withColumn("_tile", F.lit(1))
    q = df.filter("vec_id % 50 = 0 or vec_id = 204")
    got = topk.top_k(q, df, 5, "vec_id", "embedding", query_tile=2, shard_tile=16, merge=2)
    queries = [r for r in rows if r[0] is not None and (r[0] % 50 == 0 or r[0] == 204)]
    assert sorted(map(tuple, got.collect())) == brute_top(queries, rows, 5)
    assert topk.top_k(df.limit(0), df, 5, "vec_id", "embedding").count() == 0
    assert topk.top_k(q, df.limit(0), 5, "vec_id", "embedding").count() == 0


def test_an_id_with_many_top_vectors_takes_one_place(spark):
    rows = [(0, [1.0, 0.0])] + [(1, [9.0, float(j)]) for j in range(10)] + [(i, [1.0 / i, 0.0]) for i in range(2, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df.filter("vec_id = 0"), df, 5, "vec_id", "embedding")
    assert sorted(map(tuple, got.collect())) == brute_top(rows[:1], rows, 5)
    assert [r["vec_id"] for r in got.orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_tile_scores_beyond_a_double_are_exact():
    a, b = float(1 << 40), float((1 << 40) + 512)
    q, c = np.array([[a, b]]), np.array([[a, -b], [b, -a], [1.0, 1.0]])
    ids, who, score = topk.tile_best(np.array([9]), q, np.array([1, 2, 3]), c, 3)
    want = sorted(((int(a) * int(x) + int(b) * int(y), i + 1) for i, (x, y) in enumerate(c)), key=lambda x: (-x[0], x[1]))
    limit = 1 << 63
    assert [(int(s), int(w)) for s, w in zip(score, who)] == [(max(-limit, min(limit - 1, s)), w) for s, w in want]


def test_query_tiles_are_merged_with_groups_of_shard_tiles_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUPS", 3)  # ten shard tiles: groups of four
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-4, 4)) for _ in range(3)]) for i in range(160)] + [(4, [300.0, 1.0, 2.0]), (9, [1.0e7, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df.filter("vec_id % 4 = 3"), df, 5, "vec_id", "embedding", query_tile=8, shard_tile=16, merge=3)
    assert sorted(map(tuple, got.collect())) == brute_top([r for r in rows if r[0] % 4 == 3], rows, 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("top,size", [(32767, 2), (32768, 4), ((1 << 31) - 1, 4), (1 << 31, 8)])
def test_tiles_take_as_few_bytes_as_their_numbers_need(top, size):
    mat = np.array([[-float(top), 0.0, 7.0], [1.0, float(top), -2.0]])
    held = topk._packed(mat)
    assert len(held) == 6 * size and (topk._unpacked(held, 2, 3) == mat).all()


def sequential_ring(positions, n_shards, vnodes, capacity):
    """The same rule, key by key over arc counts."""
    points = shards.ring_points(n_shards, vnodes)
    counts = [0] * len(points)
    for p in positions:
        counts[next((i for i, (at, _) in enumerate(points) if at >= p), 0)] += 1
    room = list(capacity)
    left = []
    for arc, (_, s) in enumerate(points):
        take = min(counts[arc], room[s])
        room[s] -= take
        left.append(counts[arc] - take)
    used = [c - r for c, r in zip(capacity, room)]
    for arc, n in enumerate(left):
        step = arc
        while n:
            step = (step + 1) % len(points)
            s = points[step][1]
            take = min(n, capacity[s] - used[s])
            used[s] += take
            n -= take
    return used


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_ring_shards_are_balanced_gapless_and_follow_the_rule(spark, slack):
    rows = [(i, f"t{i}") for i in range(700)] + [(None, "x"), (None, None), (5, "t5"), (5, "t5")]
    df = spark.createDataFrame(rows, "doc_id long, text string") \
        .withColumns({"shard": F.lit("clash"), "rank": F.lit(1), "arc": F.lit(2), "_salt": F.lit(3), "pos": F.lit(4)})
    out = shards.ring_shards(df, ["doc_id"], shards=7, virtual_nodes=8, slack=slack)
    assert set(out.columns) == {"doc_id", "text", "shard", "rank", "arc", "_salt", "pos", "slot"}
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    sizes = Counter(r["shard"] for r in got)
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    n = len(rows)
    capacity = [n // 7 + (s < n % 7) for s in range(7)] if not slack else [-(-int(n * (1 + slack) + 7) // 7)] * 7
    assert all(sizes[s] <= capacity[s] for s in range(7))
    if not slack:
        assert max(sizes.values()) - min(sizes.values()) <= 1
    positions = [r[0] for r in df.select(shards.key_position("doc_id")).collect()]
    assert [sizes[s] for s in range(7)] == sequential_ring(positions, 7, 8, capacity)


def test_ring_moves_few_keys_when_a_shard_is_added(spark):
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    a = {r[0]: r[1] for r in shards.ring_shards(df, ["doc_id"], 10, 64, slack=0.25).select("doc_id", "shard").collect()}
    b = {r[0]: r[1] for r in shards.ring_shards(df, ["doc_id"], 11, 64, slack=0.25).select("doc_id", "shard").collect()}
    assert sum(a[i] != b[i] for i in a) < 0.35 * len(a)
    assert shards.ring_shards(df.limit(0), ["doc_id"]).count() == 0


def brute_lines(rows, ratio, least, copies):
    keys = lambda t: [x.strip(" \t\x0b\x0c\r") for x in t.split("\n")]
    pages, seen = Counter(), Counter()
    for h, t in rows if copies else set(rows):
        pages[h] += 1
        for k in set(keys(t or "")) - {""}:
            seen[h, k] += 1
    cut = {x for x, n in seen.items() if n >= least and n > ratio * pages[x[0]]}
    return sorted(((h, None if t is None else "\n".join(
        x for x, k in zip(t.split("\n"), keys(t)) if (h, k) not in cut)) for h, t in rows), key=repr)


@pytest.mark.parametrize("limit,copies", [(2_000_000, False), (0, False), (2_000_000, True)])
def test_line_dedup_equals_brute_force(spark, work, limit, copies):
    rng = random.Random(5)
    words = ["menu", " menu ", "\tfooter\r", "footer", "a b", "", "  ", "ünïque"]
    rows = [(rng.choice(["h1", "h1", "h2", None]), "\n".join(rng.choice(words + [str(rng.random())])
             for _ in range(rng.randint(0, 6)))) for _ in range(200)]
    rows += [("h1", None), ("h3", ""), ("h3", "menu\nmenu"), ("h4", "x"), ("h4", "x"), ("h4", "x")]
    df = spark.createDataFrame(rows, "host string, text string").withColumns({"_drop": F.lit(1), "line": F.lit(2)})
    out = lines.drop_boilerplate(df, "host", "text", work, ratio=0.3, min_pages=3, broadcast_keys=limit, copies=copies)
    assert out.columns == df.columns
    assert sorted(((r["host"], r["text"]) for r in out.collect()), key=repr) == brute_lines(rows, 0.3, 3, copies)
    assert lines.drop_boilerplate(df.limit(0), "host", "text", work, broadcast_keys=limit).count() == 0


def test_line_dedup_without_copies_counts_a_hosts_texts_once(spark, work):
    copied = "menu\nclean one\nclean two"
    rows = [("h", copied)] * 12 + [("h", f"menu\nown {i}") for i in range(24)]
    rows += [("g", "copied without a menu")] * 40 + [("g", f"menu\nown {i}") for i in range(3)]
    rows += [("g", f"other {i}") for i in range(10)] + [("g", None)] * 20 + [(None, "x"), (None, "x"), (None, "x")]
    df = spark.createDataFrame(rows, "host string, text string")
    out = lines.drop_boilerplate(df, "host", "text", work, ratio=0.08, min_pages=3)
    want = [(h, t and t.removeprefix("menu\n")) for h, t in rows]
    assert sorted(((r["host"], r["text"]) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_line_dedup_plan_has_no_python_and_leaves_texts_in_place(spark, work):
    df = spark.createDataFrame([("h", "a\nb")] * 9, "host string, text string")
    out = lines.drop_boilerplate(df, "host", "text", work)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_spread_rank_is_gapless_in_a_hot_group(spark):
    df = spark.range(1000).select((F.col("id") % 7 == 0).cast("int").alias("g"), "id")
    got = spread_rank(df, ["g"], [F.col("id")], F.pmod(F.xxhash64("id"), F.lit(8)).cast("int"), 8, "r", "n").collect()
    for g in (0, 1):
        ranks = sorted(r["r"] for r in got if r["g"] == g)
        assert ranks == list(range(len(ranks))) and {r["n"] for r in got if r["g"] == g} == {len(ranks)}


def test_components_of_chains_stars_and_loops(spark, work):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 500)]
    edges += [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)]
    edges = [e[::-1] if rng.random() < 0.5 else e for e in edges] * 2
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long"), work).collect()
    assert sorted(map(tuple, got)) == sorted((x, find(x)) for x in nodes)
    assert components(spark.createDataFrame([], "a long, b long"), work).count() == 0
