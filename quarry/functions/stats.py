"""Guarded arithmetic and statistics expressions.

Spark 4 runs in ANSI mode: ``x / 0`` raises and ``corr`` over a constant
column raises DIVIDE_BY_ZERO.  These helpers return NULL instead, so one
degenerate group never fails a whole job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column, on_zero: str = "null") -> Column:
    """``num / den``; NULL when ``den`` is 0 or NULL.

    ``on_zero='infinity'`` gives the IEEE value of the division instead
    (``+inf``/``-inf``, NaN for 0/0) as double arithmetic without ANSI
    checks would.
    """
    n, d = _col(num).cast("double"), _col(den).cast("double")
    ratio = F.try_divide(n, d)
    if on_zero == "null":
        return ratio
    if on_zero == "infinity":
        inf = F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf"))) \
            .otherwise(F.lit(float("nan")))
        return F.when(d == 0, inf).otherwise(ratio)
    raise ValueError(f"on_zero must be 'null' or 'infinity', not {on_zero!r}")


def pearson(x: str | Column, y: str | Column) -> Column:
    """Aggregate: Pearson correlation of ``x`` and ``y``; NULL when either
    side has zero variance or there are fewer than two rows.

    Built from ``covar_pop`` and ``stddev_pop``: both are algebraic
    (constant-size partial state), so Spark computes them with a partial
    aggregate on the map side and merges the moments after the shuffle.
    """
    xc, yc = _col(x).cast("double"), _col(y).cast("double")
    return F.try_divide(F.covar_pop(xc, yc), F.stddev_pop(xc) * F.stddev_pop(yc))
