"""Property tests: operators against small pure-Python models on
generated inputs."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st_

from quarry.functions.text import tokens
from quarry.operators import relational as rel
from quarry.operators import text as tx

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
words = st_.lists(st_.sampled_from(["a", "b", "c", "d", "e"]), max_size=8)


def _dice_lists(w1, w2):
    """2 * (left tokens whose word occurs on the right) / (n + m)."""
    n, m = len(w1), len(w2)
    common = sum(1 for w in w1 if w in w2)
    return None if n + m == 0 else 2.0 * common / (n + m)


@SETTINGS
@given(st_.lists(st_.tuples(words, words), min_size=1, max_size=5))
def test_list_dice_matches_model(spark, groups):
    rows = [(g, "L", w) for g, (left, _) in enumerate(groups) for w in left]
    rows += [(g, "R", w) for g, (_, right) in enumerate(groups) for w in right]
    rows += [(g, "L", None) for g in range(len(groups))]  # every group appears
    df = spark.createDataFrame(rows, "g long, side string, word string")
    got = {r.g: r.dice for r in tx.list_dice(df, "g", "side", "L", "R").collect()}
    for g, (left, right) in enumerate(groups):
        want = _dice_lists(left, right)
        assert (got[g] is None and want is None) or abs(got[g] - want) < 1e-12


@SETTINGS
@given(st_.lists(st_.tuples(st_.integers(0, 5), st_.integers(0, 3)), max_size=40), st_.sampled_from([1, 3, 7]))
def test_group_count_having_independent_of_partitioning(spark, rows, parts):
    df = spark.createDataFrame(rows or [(0, 0)], "k int, v int").repartition(parts)
    got = sorted(tuple(r) for r in rel.group_count_having(df, ["k"], 1).collect())
    counts = {}
    for k, _ in (rows or [(0, 0)]):
        counts[k] = counts.get(k, 0) + 1
    assert got == sorted((k, n) for k, n in counts.items() if n > 1)


@SETTINGS
@given(st_.text(alphabet="ab .,\n", max_size=30))
def test_keep_empty_tokens_match_line_split(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(tokens("t", keep_empty=True).alias("a")).first().a
    want = []
    for line in re.split(r"\r\n|\n|\r", re.sub(r"(\r\n|\n|\r)$", "", text)):
        if line == "":
            want.append("")
            continue
        parts = re.split(r"[^A-Za-z0-9_]", line)
        while parts and parts[-1] == "":
            parts.pop()
        want.extend(parts)
    assert got == want
