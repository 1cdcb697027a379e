"""Relational operators: filters, semi/inner joins, grouped counts and sums
with HAVING, date ranges, union-distinct, top-n.

Every function is ``DataFrame(s) + column names -> DataFrame`` and lazy.
Predicates are plain column comparisons (no function wrapped around the
column), so Catalyst pushes them into the Parquet scan; joins carry no
hints, so the planner (and AQE at run time, from the real shuffle sizes)
chooses between broadcast-hash and sort-merge joins.

Where a fact table is joined to a dimension only to be grouped again, the
fact is aggregated on the join key first ("eager aggregation"): the join
then sees one row per key instead of one per fact row, and a key that
holds a large share of the facts is collapsed by the map-side partial
aggregate before any shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quarry.functions.clean import format_date

Cols = Sequence[str]


def _as_date(d: str | _dt.date) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d)


def day_between(c: str | Column, lo: str | _dt.date, hi: str | _dt.date) -> Column:
    """Inclusive day range ``lo <= day(c) <= hi`` for a date or timestamp
    column, written as two bare comparisons so it prunes Parquet row groups:
    ``c >= lo and c < hi + 1 day``."""
    col = F.col(c) if isinstance(c, str) else c
    lo_d, hi_d = _as_date(lo), _as_date(hi)
    return (col >= F.lit(lo_d)) & (col < F.lit(hi_d + _dt.timedelta(days=1)))


def on_day(c: str | Column, day: str | _dt.date) -> Column:
    return day_between(c, day, day)


def money_sum(c: str | Column, scale: int = 2, precision: int = 18) -> Column:
    """Sum of a money column as an exact decimal, returned as double.

    Decimal addition is associative, so the result does not depend on how
    the rows are split into tasks or the order partial sums are merged."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(DecimalType(precision, scale))).cast("double")


def filter_sort_project(df: DataFrame, condition: Column, columns: Sequence[str | Column],
                        order_by: Sequence[Column]) -> DataFrame:
    """Rows matching ``condition``, projected to ``columns`` and sorted
    by ``order_by`` (sort on the typed column, not on text)."""
    return df.filter(condition).select(*columns).orderBy(*order_by)


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str]]],
              how: str = "inner") -> DataFrame:
    """``fact`` joined to each ``(dimension, key)`` in order, on
    same-named key columns.  Put the most selective dimension first: the
    joins run in the given order.  No hints -- the planner and AQE pick
    broadcast or sort-merge for each join from the sizes."""
    out = fact
    for dim, key in dims:
        out = out.join(dim, on=key, how=how)
    return out


def semi_join_on_day(entities: DataFrame, events: DataFrame, entity_key: str, event_key: str,
                     event_day: str, day: str | _dt.date, columns: Sequence[str],
                     order_by: Sequence[str | Column]) -> DataFrame:
    """Entities that have at least one event on ``day``; one row per
    entity however many events it has.

    A ``left_semi`` join: the event side is filtered in its scan and only
    its key column is shuffled (or broadcast when AQE measures it small).
    """
    keys = events.filter(on_day(event_day, day)).select(F.col(event_key).alias(entity_key))
    return entities.join(keys, on=entity_key, how="left_semi").select(*columns).orderBy(*order_by)


def group_count_having(df: DataFrame, keys: Cols, min_exclusive: int | None = None,
                       count_name: str = "n") -> DataFrame:
    """A1/A2 + F6: rows per group, optionally only groups with more than
    ``min_exclusive`` rows."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    if min_exclusive is not None:
        out = out.filter(F.col(count_name) > min_exclusive)
    return out


def aggregate_through(facts: DataFrame, value: str | None, hops: Sequence[tuple[str, DataFrame, Sequence[str]]],
                      name: str, min_exclusive: int | None = None) -> DataFrame:
    """A1/A2/A4 + F6 over a chain of lookups, aggregated before every join.

    ``facts`` are counted (``value=None``) or summed per the first hop's key;
    each hop ``(key, lookup, columns)`` joins one row per key with ``lookup``
    and aggregates again by ``columns``.  A hot key is combined map-side and
    never meets a join with more than one row.  Decimal sums are exact in any
    order.  ``min_exclusive`` keeps groups with more (HAVING).  Facts without
    a partner in a lookup are dropped, as by the inner joins."""
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    out = facts.groupBy(hops[0][0]).agg(agg.alias(name))
    for key, lookup, columns in hops:
        out = out.join(lookup.select(key, *[c for c in columns if c != key]), on=key) \
            .groupBy(*columns).agg(F.sum(name).alias(name))
    return out if min_exclusive is None else out.filter(F.col(name) > min_exclusive)


def repeat_days(events: DataFrame, people: DataFrame, event_person: str, person_key: str,
                event_day: str, name_cols: Cols, lo: str | _dt.date, hi: str | _dt.date,
                min_exclusive: int = 1, day_name: str = "day") -> DataFrame:
    """Days in ``[lo, hi]`` on which some person (identified by
    ``name_cols``, so namesakes merge) has more than ``min_exclusive``
    events.  Returns ``day`` (date) and ``day_text`` (``03-Oct-2007``).

    Plan: events are filtered by the range in the scan, counted per
    (day, person key) before the join, joined to people for the names,
    re-summed per (day, name) and reduced to distinct days.
    """
    per_key = (events.filter(day_between(event_day, lo, hi))
               .groupBy(F.col(event_day).cast("date").alias(day_name), F.col(event_person).alias(person_key))
               .agg(F.count(F.lit(1)).alias("_n")))
    per_name = (per_key.join(people.select(person_key, *name_cols), on=person_key)
                .groupBy(day_name, *name_cols).agg(F.sum("_n").alias("_n"))
                .filter(F.col("_n") > min_exclusive))
    days = per_name.select(day_name).distinct()
    return days.select(day_name, format_date(day_name).alias(f"{day_name}_text")).orderBy(day_name)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SQL UNION (UNION ALL then DISTINCT) of frames with equal columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def sum_by(df: DataFrame, keys: Cols, value: str | Column, name: str, scale: int | None = 2) -> DataFrame:
    """A4: sum of ``value`` per group; exact decimal when ``scale`` is set."""
    agg = money_sum(value, scale) if scale is not None else F.sum(value)
    return df.groupBy(*keys).agg(agg.alias(name))


def total(df: DataFrame, value: str | Column, name: str, scale: int | None = 2) -> DataFrame:
    """A5: one-row global sum; NULL for an empty input (no error)."""
    agg = money_sum(value, scale) if scale is not None else F.sum(value)
    return df.agg(agg.alias(name))


def top_n(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in ``order_by``; give a total order (add the
    keys as tie-breakers) for a deterministic answer.  Planned as
    ``TakeOrderedAndProject``: each task keeps its own n best, and one
    final task (the driver, when collected) merges n rows per input
    partition -- never the whole input."""
    return df.orderBy(*order_by).limit(n)
