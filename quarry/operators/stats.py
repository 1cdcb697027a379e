"""Grouped statistics.

All statistics here are algebraic aggregates (count, sum, sum of
products...), so Spark runs them as a map-side partial aggregate plus a
final merge: the shuffle carries one small state per group and task, never
the raw values, and a group holding a large share of the rows costs no more
than any other.  Nothing is buffered per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quarry.functions.stats import pearson, safe_ratio

Cols = Sequence[str]


def _spellings(keyword: str) -> list[str]:
    # Fixed value: a keyword matches in its capitalised and its lower-case
    # spelling ("Rum" or "rum"), as a substring.
    return [keyword[:1].upper() + keyword[1:], keyword.lower()]


def keyword_match(text_cols: Cols, keyword: str | Sequence[str], case_insensitive: bool = False,
                  whole_word: bool = False) -> Column:
    """True when any of ``text_cols`` contains the keyword.

    ``keyword`` is a word (matched in its capitalised and lower-case
    spellings) or an explicit list of spellings.  ``case_insensitive``
    matches any case; ``whole_word`` requires word boundaries (so 'Drum'
    no longer matches 'rum')."""
    spellings = _spellings(keyword) if isinstance(keyword, str) else list(keyword)
    cond = F.lit(False)
    for c in text_cols:
        col = F.col(c)
        for s in spellings:
            if whole_word or case_insensitive:
                flags = "(?i)" if case_insensitive else ""
                body = _regex_escape(s)
                pat = f"{flags}\\b{body}\\b" if whole_word else f"{flags}{body}"
                cond = cond | F.coalesce(col.rlike(pat), F.lit(False))
            else:
                cond = cond | F.coalesce(col.contains(s), F.lit(False))
    return cond


def _regex_escape(s: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in s)


def keyword_counts(df: DataFrame, group: str | Column, text_cols: Cols,
                   keywords: Mapping[str, str | Sequence[str]], weight: str | None = None,
                   **match_opts) -> DataFrame:
    """Per group: number of rows mentioning each keyword (a row can count
    for several keywords).  Groups with no mention at all are left out, the
    way a group appears only when some row emitted a keyword for it.

    ``weight``: a column holding how many rows each input row stands for
    (for input that was already counted per key); default 1.

    Output: ``group`` plus one ``n_<name>`` column per keyword."""
    flags = {name: keyword_match(text_cols, kw, **match_opts) for name, kw in keywords.items()}
    any_hit = F.lit(False)
    for cond in flags.values():
        any_hit = any_hit | cond
    w = F.col(weight) if weight else F.lit(1)
    aggs = [F.sum(F.when(cond, w).otherwise(0)).cast("long").alias(f"n_{name}")
            for name, cond in flags.items()]
    group_col = F.col(group) if isinstance(group, str) else group
    return df.filter(any_hit).groupBy(group_col).agg(*aggs)


def correlation(df: DataFrame, x: str, y: str, name: str = "pearson") -> DataFrame:
    """One row: Pearson r of ``x`` and ``y`` over all rows (NULL when a side
    is constant), plus the number of rows ``n``."""
    return df.agg(pearson(x, y).alias(name), F.count(F.lit(1)).alias("n"))


def keyword_correlation(df: DataFrame, group: str, text_cols: Cols, x_keyword: str,
                        y_keyword: str, **match_opts) -> DataFrame:
    """Count rows mentioning each of two keywords per group, then one
    Pearson r over the groups that mention either."""
    counts = keyword_counts(df, group, text_cols, {"x": x_keyword, "y": y_keyword}, **match_opts)
    return correlation(counts, "n_x", "n_y").withColumnRenamed("n", "n_groups")


def long_by_dims(df: DataFrame, dims: Cols, keep: Cols, dim_name: str = "dim",
                 value_name: str = "value") -> DataFrame:
    """One row per (input row, dimension): ``dim`` holds the dimension's
    name and ``value`` its value as text, so values of different dimensions
    never merge.  Runs inside the map stage (an Expand), before any
    shuffle."""
    cast = df.select(*keep, *[F.col(d).cast("string").alias(d) for d in dims])
    return cast.unpivot(ids=list(keep), values=list(dims), variableColumnName=dim_name,
                        valueColumnName=value_name)


def _grouped(long: DataFrame, measures: Cols, aggs: list, bad_groups: str) -> DataFrame:
    if bad_groups not in ("keep", "drop"):
        raise ValueError("bad_groups must be 'keep' or 'drop'")
    if bad_groups == "keep":
        return long.groupBy("dim", "value").agg(*aggs)
    complete = F.lit(True)
    for m in measures:
        complete = complete & F.col(m).isNotNull()
    out = long.groupBy("dim", "value").agg(*aggs, F.bool_and(complete).alias("_complete"))
    return out.filter(F.col("_complete")).drop("_complete")


def describe_by(df: DataFrame, dims: Cols, measures: Cols, bad_groups: str = "keep") -> DataFrame:
    """For each value of each dimension, mean and population standard
    deviation (divides by n) of every measure.

    A NULL measure (e.g. a score that did not parse in lenient cleaning)
    is skipped by the statistics (``bad_groups='keep'``), or removes its
    whole group (``'drop'``, as the original jobs did).

    Output: ``dim, value, n, mean_<m>, std_<m>...``."""
    long = long_by_dims(df, dims, measures)
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        aggs += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    return _grouped(long, measures, aggs, bad_groups)


def corr_by(df: DataFrame, dims: Cols, x: str, y: str, name: str = "pearson",
            bad_groups: str = "keep") -> DataFrame:
    """C14: Pearson r of ``x`` and ``y`` for each value of each dimension
    (NULL for a group with a constant side or a single row).
    ``bad_groups`` as in :func:`describe_by`."""
    long = long_by_dims(df, dims, [x, y])
    aggs = [pearson(x, y).alias(name), F.count(F.lit(1)).alias("n")]
    return _grouped(long, [x, y], aggs, bad_groups)


def per_capita(facts: DataFrame, fact_key: str, amount: str, population: DataFrame,
               pop_key: str, pop_value: str, key_name: str = "key", on_zero: str = "null",
               unique_population: bool = True, scale: int | None = 2) -> DataFrame:
    """C11: total ``amount`` per key and total / population, keeping keys
    found on only one side (full outer join).

    Facts are summed per key *before* the join, so the join sees one row
    per key.  A key with population but no facts has total 0 and ratio 0;
    a key with facts but no population has ratio NULL (``on_zero=
    'infinity'`` gives +inf instead).  ``unique_population`` fails the job
    when a key has two population rows; otherwise the largest is used.
    ``scale``: sum ``amount`` as an exact decimal with this many places
    (order-independent), ``None`` for a plain double sum.

    Output: ``key, total, population, per_head``.
    """
    value = F.col(amount).cast(DecimalType(38, scale) if scale is not None else "double")
    totals = facts.groupBy(F.col(fact_key).alias(key_name)).agg(
        F.sum(value).cast("double").alias("total"))
    pop_agg = F.max(pop_value)
    if unique_population:
        pop_agg = F.when(F.count(F.lit(1)) > 1,
                         F.raise_error(F.lit("duplicate population key"))).otherwise(pop_agg)
    pops = population.groupBy(F.col(pop_key).alias(key_name)).agg(pop_agg.cast("long").alias("population"))
    joined = totals.join(pops, on=key_name, how="full_outer")
    total = F.coalesce(F.col("total"), F.lit(0.0))
    return joined.select(
        key_name,
        total.alias("total"),
        "population",
        F.when(F.col("population").isNull(), safe_ratio(total, F.lit(0), on_zero))
         .otherwise(safe_ratio(total, F.col("population"), on_zero)).alias("per_head"),
    )
