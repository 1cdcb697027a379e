"""Jaccard join, near vectors and the pipeline against brute force."""

import importlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import jaccard, neardup
from quarry.llm.common import WorkFolder

W = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(t, k=5):
    w = [x.lower() for x in W.findall((t or "").encode())]
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def closure(items, linked):
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def texts(seed=1, groups=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6)))
    out = ["", None, " \n\t", "one", "One", "a b c d", "A B  c\td", "a b c d e", "a b c d e", "a b c d e f"]
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([12, 60, 120]))]
        out.append(" ".join(base))
        for _ in range(rng.randint(1, 6)):  # near copies, some beyond the threshold
            near = list(base)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = word()
            out.append(rng.choice([" ", "\n"]).join(near) + rng.choice(["", " " + word()]))
    shared = " ".join(word() for _ in range(55))  # one passage in many texts
    out += [" ".join(word() for _ in range(60)) + " " + shared for _ in range(10)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "sketch_bits": 4, "leaders": 1}])
def test_jaccard_join_equals_brute_force(spark, work, options):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"cls": F.lit(1), "n": F.lit("x"), "a": F.lit(2)})
    sets = [shingles(t) for _, t in rows]
    root = closure(sets, lambda x, y: bool(x and y) and 100 * len(x & y) >= 80 * len(x | y))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           jaccard.near_duplicates(df, work, **options).collect()}
    assert got == {i: (len(sets[i]), root[i]) for i in range(len(rows))}


def test_jaccard_chain_of_near_copies_is_one_component(spark, work):
    words = [f"w{i}" for i in range(400)]
    rows = [(900 - s, " ".join(words[s:s + 100])) for s in range(0, 300, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(df, work).collect()
    assert {r["component_id"] for r in got} == {min(i for i, _ in rows)}


def test_long_texts_are_read_whole_over_slices():
    rng = random.Random(3)
    t = " ".join("".join(rng.choice("xyz") for _ in range(rng.randint(1, 4))) for _ in range(4000))
    import pyarrow as pa

    real = jaccard._word_parts
    small = {}
    for row, s in jaccard.shingle_sets(pa.array([t, "q", t])):
        small[row] = s
    jaccard._word_parts = lambda c: real(c, 300)
    try:
        cut = dict(jaccard.shingle_sets(pa.array([t, "q", t])))
    finally:
        jaccard._word_parts = real
    assert all((small[i] == cut[i]).all() for i in range(3)) and len(small[0]) == len(shingles(t))


def test_sketch_bits_never_exceed_the_difference():
    rng = np.random.default_rng(5)
    for n, m in ((10, 400), (300, 310), (3000, 2500), (1, 1), (1600, 2000), (2100, 2000)):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * max(n, m), dtype=np.uint64) * np.uint64(2))
        a, b = np.sort(rng.choice(pool, n, False)), np.sort(rng.choice(pool, m, False))
        for bits in (6, 10, 12):
            turned = np.bitwise_count((jaccard.parity(a, bits) ^ jaccard.parity(b, bits)).view(np.uint64)).sum()
            assert turned <= len(np.setxor1d(a, b))


def test_large_sets_beside_the_threshold_equal_brute_force(spark, work):
    """Sets whose large sketches have one size, and sizes on either side of a power of two."""
    rng = random.Random(9)
    rows = []
    for size in (1700, 2049, 2060):
        base = [f"w{rng.randrange(10**9)}" for _ in range(size)]
        for i in range(6):
            near = list(base) + [f"x{rng.randrange(10**9)}" for _ in range(rng.choice([0, 60]))]
            for _ in range(rng.choice([0, 3, 34, 38, 40, 44, 60])):  # about 40 single edits reach the threshold
                near[rng.randrange(len(near))] = f"y{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(near)))
    sets = [shingles(t) for _, t in rows]
    root = closure(sets, lambda x, y: 100 * len(x & y) >= 80 * len(x | y))
    got = {r["doc_id"]: r["component_id"] for r in
           jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), work).collect()}
    assert [got[i] for i in range(len(rows))] == root and 1 < len(set(root)) < len(rows)


class Counting(WorkFolder):
    """Counts the rows of the pairs it saves."""

    pairs = 0

    def save(self, df, name="table"):
        out = super().save(df, name)
        if name == "pairs":
            Counting.pairs += out.count()
        return out

    def scope(self):
        return Counting(self.spark, self.path)


@pytest.mark.parametrize("edits", [4, 1])
def test_pairs_grow_with_the_rows_just_under_and_over_the_threshold(spark, edits):
    """200 words with four random edits each: hardly any links; with one: all of them."""
    for m in (100, 200, 400):
        rng = random.Random(m)
        base = [f"w{i}" for i in range(200)]
        rows = []
        for i in range(m):
            near = list(base)
            for j in rng.sample(range(200), edits):
                near[j] = f"e{i}x{j}"
            rows.append((i, " ".join(near)))
        folder = Counting(spark)
        Counting.pairs = 0
        out = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), folder).collect()
        assert len(out) == m and Counting.pairs <= 8 * m
        if m == 100 or edits == 1:
            sets = [shingles(t) for _, t in rows]
            root = closure(sets, lambda x, y: 100 * len(x & y) >= 80 * len(x | y)) if m == 100 else [0] * m
            assert [r["component_id"] for r in sorted(out, key=lambda r: r["doc_id"])] == root
        folder.release()


def test_drop_near_duplicates_keeps_one_of_each(spark, work):
    body = " ".join(f"w{i}" for i in range(40))
    rows = [(5, body, 1), (3, body, 2), (3, body, 3), (None, body, 4), (8, body + " more", 5), (9, "other text of its own here", 6),
            (9, "", 7), (9, None, 8), (9, "", 9), (2, "x", 10), (2, "y", 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int").withColumns({"row": F.lit(1), "component": F.lit(2)})
    for limit in (10, 0):
        out = jaccard.drop_near_duplicates(df, work, broadcast_rows=limit)
        assert out.columns == df.columns
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        assert sorted(got, key=repr) == sorted([(3, body), (9, rows[5][1]), (9, ""), (9, None), (9, ""), (2, "x"), (2, "y")], key=repr)
    assert jaccard.drop_near_duplicates(df.limit(0), work).count() == 0


def vectors(seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(25):
        base = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((base + 0.12 * rng.standard_normal(16) * rng.random(), int(rng.integers(0, 2))))
    dense = rng.standard_normal(16)  # one group with more members than a list or a run holds
    rows += [(dense + 0.03 * rng.standard_normal(16), 1) for _ in range(150)]
    rows += [(rng.standard_normal(16), 1) for _ in range(100)]
    out = [(i, v.tolist(), lab) for i, (v, lab) in enumerate(rows)]
    n = len(out)
    out += [(n, None, 1), (n + 1, [0.0] * 16, 1), (n + 2, [float("nan")] * 16, 1), (n + 3, [1.0, None] + [0.0] * 14, 1),
            (n + 4, out[0][1], None), (n + 5, out[0][1], out[0][2]), (n + 6, out[0][1], out[0][2]), (n + 7, [], 1),
            (n + 8, [1.0, 2.0], 1), (n + 9, [2.0, 4.0], 1), (n + 10, [1e300] * 16, 0), (n + 11, [2e-300] * 16, 0)]
    return out


def test_near_vectors_equal_brute_force(spark, work):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"v": F.lit(1), "nid": F.lit(2)})

    def unit(r):
        v = r[1]
        if v is None or r[2] is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / max(map(abs, v))
        return x / np.linalg.norm(x)

    units = [unit(r) for r in rows]
    linked = lambda i, j: (units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
                           and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= 0.98)
    n = len(rows)
    near = [[i != j and linked(i, j) for j in range(n)] for i in range(n)]
    root = closure(list(range(n)), linked)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           neardup.near_vectors(df, work, leaf=32, k=4).collect()}
    assert got == {i: (sum(near[i]), root[i], root[i] == i) for i in range(n)}
    assert neardup.near_vectors(df.limit(0), work).count() == 0


def links_by_hand(rows, threshold=0.98):
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    root = closure(list(range(len(rows))), lambda i, j: near[i, j])
    return {rows[i][0]: (int(near[i].sum()), rows[root[i]][0]) for i in range(len(rows))}


def near_by_search(spark, work, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neardup.near_vectors(df, work, **options).collect()}


def tight_groups(size, noise, seed=4):
    """Two groups tighter than the links that join them."""
    rng = np.random.default_rng(seed)
    a, b = np.linalg.qr(rng.standard_normal((16, 2)))[0].T
    angle = np.arccos(0.9825)
    out = []
    for g, centre in enumerate((a, np.cos(angle) * a + np.sin(angle) * b)):
        out += [(g * size + i, (centre + noise * rng.standard_normal(16)).tolist(), 1) for i in range(size)]
    return out


@pytest.mark.parametrize("leaf", [256, 32])
def test_links_between_groups_larger_than_a_list_are_found(spark, work, leaf):
    rows = tight_groups(60, 0.002)
    want = links_by_hand(rows)
    assert {c for _, c in want.values()} == {0} and min(n for n, _ in want.values()) > 59
    assert near_by_search(spark, work, rows, leaf=leaf) == want


def test_a_search_that_misses_its_recall_ends_in_an_exact_pass(spark, work):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(40):
        v = rng.standard_normal(16)
        rows += [(2 * i, v.tolist(), 1), (2 * i + 1, (v + 0.02 * rng.standard_normal(16)).tolist(), 1)]
    assert near_by_search(spark, work, rows, trees=1, leaf=2, rounds=0, attempts=1) == links_by_hand(rows)


def test_audit_sees_a_missed_pair_beside_a_dense_group(spark):
    rng = np.random.default_rng(6)
    units = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    dense = units(rng.standard_normal(16) + 0.01 * rng.standard_normal((300, 16)))
    pairs = units(np.repeat(rng.standard_normal((10, 16)), 2, axis=0) + 0.01 * rng.standard_normal((20, 16)))
    rows = [("1", 16, i, 0, x.tobytes()) for i, x in enumerate(dense)]
    rows += [("1", 16, 1000 + i, 1000 + i - (i % 2 if i < 14 else 0), x.tobytes()) for i, x in enumerate(pairs)]
    df = spark.createDataFrame(rows, "key string, dim int, nid long, c long, v binary")
    assert neardup.audit(df, 0.98, 400) == [(14, 20), (300, 300)]  # three of ten pairs are apart


def test_links_of_a_large_component_are_counted_over_tiles(spark, work):
    rng = np.random.default_rng(0)
    v = rng.standard_normal((60, 8)) * 0.1 + 1
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(i % 2, i, 1 + i % 3, v[i].tobytes()) for i in range(60)]
    df = spark.createDataFrame(rows, "c long, nid long, m long, v binary")
    got = {r["nid"]: r["links"] for r in neardup.count_links(df, 0.99, tile=7).collect()}
    m = np.array([r[2] for r in rows])
    for i in range(60):
        near = [j for j in range(60) if j != i and j % 2 == i % 2 and v[i] @ v[j] >= 0.99]
        assert got[i] == m[near].sum()


def test_pipeline_stages_chain_and_keep_their_promises(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, "en", None, None), (10_002, "", "en", "s", 0), (10_003, "", None, "s", 0)], docs.schema)
    cur = docs.unionAll(extra).cache()
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "pii", "packing"]
    for name, stage in pipeline.STAGES:
        out = stage(spark, cur, sf)
        if name != "packing":
            assert out.columns == docs.columns
            out = out.cache()
            ids = {r["doc_id"] for r in out.select("doc_id").collect()}
            assert {10_001, 10_002, 10_003} <= ids  # nothing clean goes
            if name in ("line_dedup", "pii"):
                assert out.count() == cur.count()
            if name == "near_duplicates":
                left = [(r["doc_id"], shingles(r["text"])) for r in out.collect()]
                assert not any(100 * len(x & y) >= 80 * len(x | y) for i, (_, x) in enumerate(left) for _, y in left[:i] if x and y)
        else:
            assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == ids
        cur = out


def test_pipeline_keeps_one_copy_of_a_text_with_a_third_of_its_source(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    body = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) for i in range(4))
    rows = [(i, "menu of the site\n" + body, "en", "s", 1) for i in range(15)]
    rows += [(100 + i, "menu of the site\n" + " ".join(f"own{i}x{j}" for j in range(20)), "en", "s", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, schema)
    stages = dict(pipeline.STAGES)
    out = stages["near_duplicates"](spark, stages["line_dedup"](spark, docs, sf), sf).collect()
    assert [r["doc_id"] for r in out if r["text"] == body] == [0] and len(out) == 31
