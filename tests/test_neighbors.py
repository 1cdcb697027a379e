"""kNN: top-k with ties, vote ties, id lookup, evaluation, and the exact
pivot-cell neighbour search against numpy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import neighbors as nb


def test_k_nearest_ties_and_short_lists(spark):
    d = spark.createDataFrame([(0, 5, 1.0), (0, 3, 1.0), (0, 9, 0.5), (0, 7, 2.0), (1, 0, 3.0)],
                              "id long, paired long, distance double")
    got = {}
    for r in nb.k_nearest(d, 3).collect():
        got.setdefault(r.id, []).append((r.distance, r.paired))
    assert sorted(got[0]) == [(0.5, 9), (1.0, 3), (1.0, 5)]
    assert nb.k_nearest(d, 2).filter("id = 0").orderBy("distance", "paired").collect()[1].paired == 3
    assert got[1] == [(3.0, 0)]  # fewer than k partners is fine


def test_vote_tie_goes_to_smallest_label_and_lookup_by_id(spark):
    big = 8589934592
    labels = spark.createDataFrame([(0, 5.0), (7, 6.0), (big, 5.0), (3, 6.0)], "id long, label double")
    neigh = spark.createDataFrame([(0, 7), (0, big), (7, 0), (7, 3), (big, 3), (big, 7)],
                                  "id long, paired long")
    got = {r.id: (r.predicted, r.actual) for r in nb.knn_classify(neigh, labels).collect()}
    # id 7: one vote each for 5.0 and 6.0 -> 5.0
    assert got == {0: (5.0, 5.0), 7: (5.0, 6.0), big: (6.0, 5.0)}


def test_confusion_and_accuracy_agree(spark):
    preds = spark.createDataFrame([(1, 3, 3), (2, 4, 3), (3, 4, 4), (4, 8, 8)],
                                  "id long, predicted int, actual int")
    cm = nb.confusion_matrix(preds).collect()
    assert sum(r.n for r in cm) == 4
    diag = sum(r.n for r in cm if r.predicted == r.actual)
    assert nb.accuracy(preds).first().accuracy == pytest.approx(diag / 4)


def _brute(ids, vecs, k):
    d = np.sqrt(((vecs[:, None, :] - vecs[None, :, :]) ** 2).sum(-1))
    out = {}
    for i, qi in enumerate(ids):
        cand = sorted((d[i, j], ids[j]) for j in range(len(ids)) if j != i)
        out[qi] = [p for _, p in cand[:k]]
    return out


def _check(spark, ids, vecs, k, **kw):
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vecs)],
                               "id long, vector array<double>")
    got = {}
    for r in nb.nearest_vectors(df, k, **kw).collect():
        got.setdefault(r.id, []).append((r.distance, r.paired))
    got = {i: [p for _, p in sorted(v)] for i, v in got.items()}
    assert got == _brute(ids, vecs, k)


def test_exact_on_random_vectors(spark):
    rng = np.random.default_rng(1)
    vecs = rng.normal(size=(300, 16))
    _check(spark, list(range(300)), vecs, 5, n_pivots=12, block_rows=40)


def test_exact_on_clustered_vectors_with_duplicates(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(scale=20, size=(6, 8))
    vecs = np.concatenate([c + rng.normal(size=(50, 8)) for c in centers])
    vecs[10] = vecs[11] = vecs[12]                 # exact ties
    ids = list(rng.permutation(10_000)[:300] * 3 + 7)   # sparse, unordered ids
    _check(spark, ids, vecs, 4, n_pivots=18, block_rows=25)


def test_exact_when_one_cell_holds_most_points(spark):
    rng = np.random.default_rng(3)
    vecs = np.concatenate([rng.normal(scale=0.01, size=(200, 4)), rng.normal(scale=50, size=(20, 4))])
    _check(spark, list(range(220)), vecs, 3, n_pivots=8, block_rows=16)


def test_default_pivots_and_float_input(spark):
    rng = np.random.default_rng(4)
    vecs = rng.normal(size=(60, 5)).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                               "id long, vector array<float>")
    out = nb.nearest_vectors(df, 2)
    assert out.groupBy("id").count().filter(F.col("count") != 2).count() == 0


def test_end_to_end_from_distance_records(spark, tmp_path):
    """The original input path: a labelled CSV with a numeric schema, a row
    id per row, and a text file of [id,paired,distance] records that refer
    to those ids (looked up by id, never by position)."""
    from quarry.sources import read_csv, read_distance_records

    (tmp_path / "wine.csv").write_text("alcohol,quality\n9.4,5\n9.8,5\n10.0,6\n11.2,6\n")
    wine = read_csv(spark, str(tmp_path / "wine.csv"), schema="alcohol double, quality double")
    labels = nb.with_row_id(wine).select("id", "alcohol", F.col("quality").alias("label"))
    ids = [r.id for r in labels.orderBy("alcohol").collect()]
    recs = [f"({ids[i]}, [{ids[i]},{ids[j]},{abs(i - j) + 0.1 * j}])"
            for i in range(4) for j in range(4) if i != j]
    (tmp_path / "dist.txt").write_text("\n".join(recs) + "\n")
    near = nb.k_nearest(read_distance_records(spark, str(tmp_path / "dist.txt")), 1)
    pred = nb.knn_classify(near, labels.select("id", "label"))
    got = {r.id: (r.predicted, r.actual) for r in pred.collect()}
    # nearest of row0 is row1 (5), row1 -> row0 (5), row2 -> row1 (5), row3 -> row2 (6)
    assert got == {ids[0]: (5.0, 5.0), ids[1]: (5.0, 5.0), ids[2]: (5.0, 6.0), ids[3]: (6.0, 6.0)}
    assert nb.accuracy(pred).first().accuracy == 0.75
    cm = {(r.predicted, r.actual): r.n for r in nb.confusion_matrix(pred).collect()}
    assert cm == {(5.0, 5.0): 2, (5.0, 6.0): 1, (6.0, 6.0): 1}


def test_row_ids_unique(spark):
    df = spark.range(1000).repartition(7)
    ids = nb.with_row_id(df, "rid").select("rid")
    assert ids.distinct().count() == 1000


def test_ring_gaps_prune_separated_clusters_and_stay_safe(spark):
    """Clustered vectors are sent to no other cluster's cell; the gap never
    exceeds the true distance."""
    rng = np.random.default_rng(11)
    centers = rng.normal(scale=100, size=(8, 6))
    vecs = np.concatenate([c + rng.normal(size=(40, 6)) for c in centers])
    d = np.sqrt(((vecs[:, None, :] - centers[None, :, :]) ** 2).sum(-1))
    cell = d.argmin(1)
    near = np.sqrt(((vecs[:, None, :] - vecs[None, :, :]) ** 2).sum(-1))
    bound = np.sort(near, axis=1)[:, 5]
    sent = 0
    for c in range(8):
        dc = np.sort(d[cell == c, c])
        for ring in np.array_split(dc, 4):
            inside = (cell == c) & (d[:, c] >= ring[0]) & (d[:, c] <= ring[-1])
            gap = nb._ring_gap(d[:, c], ring[0], ring[-1])
            assert (gap <= near[:, inside].min(axis=1)).all()
            sent += (gap[cell != c] <= bound[cell != c]).sum()
    assert sent == 0
    _check(spark, list(range(len(vecs))), vecs, 5, n_pivots=16, block_rows=30)


def test_equal_vectors_are_one_node_and_work_grows_with_the_rows(spark):
    """Half of all vectors equal, the rest on a line (where a bound shrinks as
    fast as the rings): the rows sent to further rings stay a few a vector
    however many there are, and lists stay exact."""
    for n in (500, 1000, 2000):
        rng = np.random.default_rng(8)
        line = rng.uniform(1, 1000, size=(n // 2, 1)) * np.array([[1.0, 2.0, -1.0, 0.5]])
        vecs = np.concatenate([np.zeros((n // 2, 4)), line])
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id long, vector array<double>")
        pts, count, _ = nb._points(df, "id", "vector", "raise")
        scratch = nb.Scratch(spark)
        pivots = nb._pivots(pts, count, None)
        cells = scratch.save(nb._celled(pts, pivots, 8))
        lists, nodes, routed = nb._lists(cells, cells, pivots, 4, 16, 1000, count, scratch)
        assert nodes.count() == n // 2 + 1
        assert routed.count() <= 4 * (n // 2 + 1)
        scratch.release()
    ids = list(range(200))
    vecs = np.concatenate([np.zeros((100, 3)), np.random.default_rng(9).normal(size=(100, 3))])
    _check(spark, ids, vecs, 5, n_pivots=6, block_rows=10)
    _check(spark, ids, vecs, 5, n_pivots=6, block_rows=10, max_blocks=4)


def test_repeated_rows_and_ids_with_two_vectors(spark):
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [3.0, 0.0]), (4, [7.0, 0.0]), (2, [1.0, -0.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = sorted((r["id"], r["paired"], r["distance"]) for r in nb.nearest_vectors(df, 2, n_pivots=2, block_rows=2).collect())
    assert got == [(1, 2, 1.0), (1, 3, 3.0), (2, 1, 1.0), (2, 3, 2.0), (3, 1, 3.0), (3, 2, 2.0), (4, 2, 6.0), (4, 3, 4.0)]
    two = spark.createDataFrame(rows + [(1, [7.0, 1.0])], "id long, vector array<double>")
    of_four = sorted((r["distance"], r["paired"]) for r in nb.nearest_vectors(two, 2).filter("id = 4").collect())
    assert of_four == [(1.0, 1), (4.0, 3)]
    assert nb.nearest_vectors(two, 3).filter("id = paired").count() == 0


@pytest.mark.parametrize("options", [{}, {"n_pivots": 5, "block_rows": 7}, {"n_pivots": 1, "block_rows": 16}])
def test_queries_against_another_table_equal_brute_force(spark, options):
    rng = np.random.default_rng(12)
    refs = np.concatenate([rng.normal(size=(150, 4)), np.ones((60, 4)), rng.normal(scale=30, size=(30, 4))])
    refs = refs[rng.permutation(len(refs))]
    asked = np.concatenate([rng.normal(size=(40, 4)), refs[:10], np.ones((25, 4)), np.full((1, 4), 500.0)])
    r = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(refs)], "rid long, rv array<double>, id int")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "qid long, qv array<double>")
    got = {}
    for x in nb.nearest_between(q, r, 6, "qid", "qv", "rid", "rv", **options).collect():
        got.setdefault(x["id"], []).append((x["distance"], x["paired"]))
    for i, v in enumerate(asked):
        d = np.sqrt(((refs - v) ** 2).sum(-1))
        want = sorted(zip(d, range(len(refs))))[:6]
        assert [p for _, p in sorted(got[i])] == [p for _, p in want]
        assert np.allclose([x for x, _ in sorted(got[i])], [x for x, _ in want])


def test_queries_against_few_or_no_references(spark):
    q = spark.createDataFrame([(1, [0.0]), (2, [9.0]), (None, [1.0]), (3, None)], "id long, vector array<double>")
    r = spark.createDataFrame([(1, [0.0]), (7, [4.0])], "id long, vector array<double>")
    got = sorted(map(tuple, nb.nearest_between(q, r, 5).collect()))
    assert got == [(1, 1, 0.0), (1, 7, 4.0), (2, 1, 9.0), (2, 7, 5.0)]  # an equal id means nothing
    assert nb.nearest_between(q, r.limit(0), 5).count() == 0 and nb.nearest_between(q.limit(0), r, 5).count() == 0
    with pytest.raises(ValueError, match="length"):
        nb.nearest_between(spark.createDataFrame([(1, [0.0, 1.0])], q.schema), r, 1)


def test_votes_for_rows_without_a_label(spark):
    near = spark.createDataFrame([(100, 1), (100, 2), (200, 3), (200, 1)], "id long, paired long")
    labels = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id long, label string")
    assert {r["id"]: r["predicted"] for r in nb.knn_vote(near, labels).collect()} == {100: "a", 200: "a"}


def test_ids_whose_hashes_are_all_large_still_have_pivots(spark):
    rng = np.random.default_rng(5)
    ids = list(range(20500, 21000))
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in ids], "id long, vector array<double>")
    assert nb.nearest_vectors(df, 3).count() == 1500
    assert nb.nearest_vectors(df, 3, n_pivots=1).count() == 1500


def test_invalid_vectors_raise_or_are_left_out(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    rows[3] = (3, [float("nan"), 0.0, 0.0])
    rows[4] = (4, [1.0, None, 0.0])
    rows[5] = (5, [float("inf"), 0.0, 0.0])
    rows += [(90, None), (None, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    with pytest.raises(ValueError, match="3 vectors"):
        nb.nearest_vectors(df, 3)
    out = nb.nearest_vectors(df, 3, n_pivots=37, invalid="drop").groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in out} == {i: 3 for i in range(40) if i not in (3, 4, 5)}
    with pytest.raises(ValueError, match="lengths"):
        nb.nearest_vectors(spark.createDataFrame([(1, [0.0]), (2, [0.0, 1.0])], df.schema), 1)


def test_many_equal_distances_go_to_the_smallest_ids():
    q = np.zeros((2, 3))
    ref = np.concatenate([np.ones((60, 3)), np.full((5, 3), 2.0)])
    ids = np.arange(100, 165)[::-1]
    a, b, d = nb._block_k_best(q, ref, np.array([1, 2]), ids, 4)
    want = sorted(ids[:60])[:4]
    assert a.tolist() == [1] * 4 + [2] * 4 and b.tolist() == [*want, *want] and np.allclose(d, 3 ** 0.5)


def test_row_index_follows_file_order_whatever_the_split_packing(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text("a\nb\n")
    (tmp_path / "part-1.csv").write_text("".join(f"{i:06d}\n" for i in range(5000)))
    df = spark.read.schema("v string").csv(str(tmp_path))
    got = [r.v for r in nb.with_row_index(df).orderBy("id").collect()]
    assert got == ["a", "b"] + [f"{i:06d}" for i in range(5000)]
    ids = [r.id for r in nb.with_row_index(spark.range(100, numPartitions=5).toDF("v")).collect()]
    assert sorted(ids) == list(range(100))


def test_k_nearest_ignores_missing_distances(spark):
    d = spark.createDataFrame([(0, 1, None), (0, 2, 5.0), (0, 3, 7.0)], "id long, paired long, distance double")
    assert [r.paired for r in nb.k_nearest(d, 1).collect()] == [2]


def test_fewer_vectors_than_k_and_empty_input(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [5.0, 0.0])], "id long, vector array<double>")
    got = {}
    for r in nb.nearest_vectors(df, 5).collect():
        got.setdefault(r.id, []).append(r.paired)
    assert {i: sorted(v) for i, v in got.items()} == {1: [2, 3], 2: [1, 3], 3: [1, 2]}
    empty = spark.createDataFrame([], "id long, vector array<double>")
    assert nb.nearest_vectors(empty, 3).count() == 0


@pytest.mark.parametrize("options", [{}, {"span_bytes": 2048}])
def test_queries_are_not_copied_to_every_ring(spark, monkeypatch, options):
    from quarry.operators.common import Scratch

    class Counting(Scratch):
        rows = 0

        def save(self, df):
            out = super().save(df)
            self.rows += out.count()
            return out

    if options:
        monkeypatch.setattr(nb, "SPAN_BYTES", options["span_bytes"])
    rnd = np.random.default_rng(11)
    n = 300
    vecs = rnd.normal(size=(n, 24))  # in many dimensions no ring is out of reach
    vecs[:40] = np.round(vecs[:40])
    vecs[40:60] = vecs[:20]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, vector array<double>")
    scratch = Counting(spark)
    got = {}
    for r in nb.nearest_vectors(df, 5, n_pivots=30, block_rows=8, scratch=scratch).collect():
        got.setdefault(r["id"], []).append((r["distance"], r["paired"]))
    for i in range(n):
        d = np.sqrt(((vecs - vecs[i]) ** 2).sum(axis=1))
        want = sorted((d[j], j) for j in range(n) if j != i)[:5]
        assert sorted(got[i])[0][0] == pytest.approx(want[0][0]) and [j for _, j in sorted(got[i])] == [j for _, j in want]
    assert scratch.rows <= 12 * n  # cells, ranks, rings, nodes, home rings, first candidates (6 each at most), routed
