"""Rejected rows and their numbers without a second pass over the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quarry.operators.common import Scratch


def _bad_counts(required: Sequence[str]) -> list:
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    return [F.count(F.lit(1)).alias("rows"), F.count_if(~whole).alias("rejected"),
            *[F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in required]]


def counted(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, Observation]:
    """The rows that have every ``required`` column, and an observation that
    holds ``rows``, ``rejected`` and ``no_<column>`` once any job has read the
    result through: counts beside the result, from its own pass."""
    seen = Observation()
    good = df.observe(seen, *_bad_counts(required))
    for c in required:
        good = good.filter(F.col(c).isNotNull())
    return good, seen


def split_once(df: DataFrame, required: Sequence[str], scratch: Scratch) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``(good, rejects, counts)``: the source is read once and written to
    ``scratch`` with each row's verdict; both frames read that table, pruned to
    their part, and the counts come from the writing itself."""
    good = F.lit(True)
    for c in required:
        good = good & F.col(c).isNotNull()
    seen = Observation()
    table = scratch.save(df.withColumn("_good", good).observe(seen, *_bad_counts(required)), partition_by="_good")
    return table.filter(F.col("_good")).drop("_good"), table.filter(~F.col("_good")).drop("_good"), \
        {k: v or 0 for k, v in seen.get.items()}
