"""One key holding a third of all rows: results stay exact, and the plans
combine the hot key before any shuffle (partial aggregate, partial window
limit) instead of sending its raw rows to one task."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import neighbors as nb
from quarry.operators import stats as st
from quarry.operators import text as tx


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_describe_by_hot_value(spark):
    rows = [("hot", i % 7, float(i % 13)) for i in range(3000)] + \
           [(f"v{i % 50}", i % 7, float(i % 11)) for i in range(6000)]
    df = spark.createDataFrame(rows, "a string, b int, x double").repartition(9)
    out = st.describe_by(df, ["a", "b"], ["x"])
    got = {(r.dim, r.value): (r.n, r.mean_x) for r in out.collect()}
    hot = [r for r in rows if r[0] == "hot"]
    assert got[("a", "hot")][0] == len(hot)
    assert got[("a", "hot")][1] == pytest.approx(sum(r[2] for r in hot) / len(hot))
    assert "partial_avg" in _plan(out)


def test_list_dice_hot_conversation(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(40)]
    rows = [(0, rnd.choice("LR"), rnd.choice(vocab)) for _ in range(3000)]  # a third: one group
    rows += [(g, rnd.choice("LR"), rnd.choice(vocab)) for g in range(1, 300) for _ in range(20)]
    toks = spark.createDataFrame(rows, "g long, side string, word string").repartition(7)
    got = {r.g: (r.n_left, r.n_right, r.common) for r in tx.list_dice(toks, "g", "side", "L", "R").collect()}
    left = [w for g, s, w in rows if g == 0 and s == "L"]
    right = {w for g, s, w in rows if g == 0 and s == "R"}
    assert got[0] == (len(left), sum(1 for g, s, w in rows if g == 0 and s == "R"),
                      sum(1 for w in left if w in right))
    plan = _plan(tx.list_dice(toks, "g", "side", "L", "R"))
    assert "partial_sum" in plan and "collect_list" not in plan


def test_dice_join_third_of_documents_are_copies(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(80)]
    base = set(rnd.sample(vocab, 30))
    sets = {d: set(base) for d in range(60)}                        # 60 copies
    sets.update({d: set(rnd.sample(vocab, rnd.randint(10, 30))) for d in range(60, 180)})
    rows = [(d, w) for d, ws in sets.items() for w in ws]
    words = spark.createDataFrame(rows, "doc long, word string").repartition(6)
    got = {(r.doc_a, r.doc_b): r.overlap for r in tx.dice_join(words, "doc", threshold=0.5, k=30).collect()}
    want = {(a, b): len(sets[a] & sets[b]) for a, b in itertools.combinations(sorted(sets), 2)
            if 2.0 * len(sets[a] & sets[b]) / 60.0 >= 0.5}
    assert got == want
    assert sum(1 for a, b in got if a < 60 and b < 60) == 60 * 59 // 2


def test_k_nearest_hot_id(spark):
    rnd = random.Random(9)
    rows = [(0, j, rnd.random()) for j in range(1, 3001)]                 # one id: a third
    rows += [(i, j, rnd.random()) for i in range(1, 301) for j in range(20)]
    d = spark.createDataFrame(rows, "id long, paired long, distance double").repartition(8)
    near = nb.k_nearest(d, 3)
    got = sorted((r.distance, r.paired) for r in near.filter("id = 0").collect())
    assert got == sorted((x, j) for i, j, x in rows if i == 0)[:3]
    plan = _plan(near)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_word_counts_hot_word(spark):
    docs = spark.createDataFrame([(i, "the " * 300 + f"w{i}") for i in range(40)], "doc long, text string")
    out = tx.word_counts(docs, "doc", "text")
    assert out.filter(F.col("word") == "the").agg(F.sum("n")).first()[0] == 40 * 300
    assert "partial_count" in _plan(out)
