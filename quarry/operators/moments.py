"""Grouped statistics that can be merged: means, variances and covariances as state.

:func:`moment_state` reduces rows to one row a group: ``n``, a mean and the sum
of squared deviations (``m2_``) for every measure, and the sum of products of
deviations (``c_``) for every pair.  States of different parts (files, days)
are tables like any other; :func:`merge_states` adds them up exactly as if all
rows had been read at once (Chan, Golub, LeVeque 1979), so a new part needs no
rescan of the old ones.  :func:`moment_results` turns a state into means,
population standard deviations and Pearson coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Cols = Sequence[str]


def _pairs(measures: Cols) -> list[tuple[str, str]]:
    return list(combinations(measures, 2))


def moment_state(df: DataFrame, by: Cols, measures: Cols) -> DataFrame:
    """``(by, n, mean_<m>, m2_<m>, c_<a>_<b>)`` of the rows that have every
    measure; a row without one counts for none.  One partial aggregate."""
    whole = df.select(*by, *[F.col(m).cast("double").alias(m) for m in measures]).dropna(subset=list(measures))
    n = F.count(F.lit(1))
    aggs = [n.alias("n")]
    for m in measures:
        aggs += [F.avg(m).alias(f"mean_{m}"), (F.var_pop(m) * n).alias(f"m2_{m}")]
    aggs += [(F.covar_pop(a, b) * n).alias(f"c_{a}_{b}") for a, b in _pairs(measures)]
    return whole.groupBy(*by).agg(*aggs)


def merge_states(states: DataFrame | Sequence[DataFrame], by: Cols, measures: Cols) -> DataFrame:
    """The state of all parts together, from any number of states (a table
    holding several states of a group, or a list of tables).

    Means first, then deviations of the parts' means from them: no difference
    of large sums is taken, so the result is that of one pass to rounding.
    ``by`` needs a column (a constant one for a single group)."""
    if not by:
        raise ValueError("merge_states needs a column to group by")
    if not isinstance(states, DataFrame):
        first, *rest = states
        for s in rest:
            first = first.unionByName(s)
        states = first
    total = F.sum("n")
    means = states.groupBy(*by).agg(total.alias("_n"), *[
        (F.sum(F.col("n") * F.col(f"mean_{m}")) / total).alias(f"_{m}") for m in measures])
    same = None
    for k in by:
        one = F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}"))
        same = one if same is None else same & one
    far = {m: F.col(f"mean_{m}") - F.col(f"_{m}") for m in measures}
    aggs = [F.sum("n").alias("n")]
    for m in measures:
        aggs += [F.first(f"_{m}").alias(f"mean_{m}"), F.sum(F.col(f"m2_{m}") + F.col("n") * far[m] * far[m]).alias(f"m2_{m}")]
    aggs += [F.sum(F.col(f"c_{a}_{b}") + F.col("n") * far[a] * far[b]).alias(f"c_{a}_{b}") for a, b in _pairs(measures)]
    return states.alias("s").join(means.alias("t"), same).groupBy(*[F.col(f"s.{k}").alias(k) for k in by]).agg(*aggs)


def moment_results(state: DataFrame, by: Cols, measures: Cols) -> DataFrame:
    """``(by, n, mean_<m>, std_<m>, corr_<a>_<b>)``: population standard
    deviations; a coefficient is NULL where a side is constant."""
    out = [*by, "n"]
    for m in measures:
        out += [f"mean_{m}", F.sqrt(F.greatest(F.lit(0.0), F.col(f"m2_{m}") / F.col("n"))).alias(f"std_{m}")]
    out += [F.try_divide(F.col(f"c_{a}_{b}"), F.sqrt(F.col(f"m2_{a}")) * F.sqrt(F.col(f"m2_{b}"))).alias(f"corr_{a}_{b}")
            for a, b in _pairs(measures)]
    return state.select(*out)
