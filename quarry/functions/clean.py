"""Cleaning as column expressions.

The inputs this library was modelled on are CSV files whose header names
carry blanks, whose text values are wrapped in single quotes, whose ids may
have a leading blank and whose dates look like ``3-Oct-2007``.  Each helper
below returns a ``Column`` so the cleaning stays inside whole-stage codegen
and Catalyst can still push filters past it.

Strict vs lenient: with ``strict=True`` a bad value fails the job (the original
behaviour), whatever the session's ANSI mode; with ``strict=False`` it becomes
NULL, which :func:`split_bad_rows` can route to a reject frame.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the day-month-year text layout of the source dates,
# e.g. "3-Oct-2007" (parsing) and "03-Oct-2007" (formatting).
DATE_PARSE_PATTERN = "d-MMM-yyyy"
DATE_FORMAT_PATTERN = "dd-MMM-yyyy"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_raise(value: Column, raw: Column, what: str) -> Column:
    """``value``, failing the job where ``raw`` has a value that gave none."""
    return F.when(raw.isNotNull() & value.isNull(), F.raise_error(F.concat(F.lit(f"not {what}: "), raw.cast("string")))) \
        .otherwise(value)


def column_names(df: DataFrame, drop_chars: str = "'") -> DataFrame:
    """Trim every column name and remove ``drop_chars`` from it."""
    table = str.maketrans("", "", drop_chars)
    return df.toDF(*[name.strip().translate(table) for name in df.columns])


def unquote(c: str | Column, quote: str = "'", strict: bool = False) -> Column:
    """Text between the first and the last ``quote`` character.

    ``O'HARA`` wrapped as ``'O'HARA'`` stays ``O'HARA`` (greedy match).
    A value without two quotes gives NULL, or raises when ``strict``.
    """
    col = _col(c)
    q = quote.replace("\\", "\\\\")
    pattern = f"(?s)^[^{q}]*{q}(.*){q}[^{q}]*$"
    has_quotes = col.rlike(pattern)
    value = F.regexp_extract(col, pattern, 1)
    if strict:
        return F.when(col.isNull(), F.lit(None)).when(has_quotes, value).otherwise(
            F.raise_error(F.concat(F.lit("value without quotes: "), col)))
    return F.when(has_quotes, value)


def to_int(c: str | Column, strip: str = "", strict: bool = False,
           dtype: str = "int") -> Column:
    """Trim, remove the characters in ``strip`` (e.g. ``", "`` for
    ``"1,234 567"``) and cast to an integer type."""
    col = F.trim(_col(c))
    if strip:
        col = F.regexp_replace(col, "[" + "".join("\\" + ch for ch in strip) + "]", "")
    value = col.try_cast(dtype)
    return or_raise(value, _col(c), "an integer") if strict else value


def to_double(c: str | Column, strict: bool = False) -> Column:
    value = F.trim(_col(c)).try_cast("double")
    return or_raise(value, _col(c), "a number") if strict else value


def strip_chars(c: str | Column, chars: str = '"') -> Column:
    """Remove every occurrence of each character in ``chars``."""
    return F.translate(_col(c), chars, "")


def normalize_key(c: str | Column, suffix: str | None = " County") -> Column:
    """Join-key normalisation: drop single quotes, an optional suffix such as
    `` County``, blanks and tabs.  ``O'BRIEN`` and ``OBRIEN County`` both
    become ``OBRIEN``."""
    col = F.replace(_col(c), F.lit("'"), F.lit(""))
    if suffix:
        col = F.replace(col, F.lit(suffix), F.lit(""))
    return F.regexp_replace(col, "[ \t]", "")


def to_date(c: str | Column, pattern: str = DATE_PARSE_PATTERN, strict: bool = False) -> Column:
    """Parse ``3-Oct-2007`` style text (blanks around it ignored)."""
    value = F.try_to_date(F.trim(_col(c)), pattern)
    return or_raise(value, _col(c), f"a date like {pattern}") if strict else value


def format_date(c: str | Column, pattern: str = DATE_FORMAT_PATTERN) -> Column:
    """Date to ``03-Oct-2007`` text."""
    return F.date_format(_col(c), pattern)


def split_bad_rows(df: DataFrame, required: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows whose cleaned ``required`` columns are all non-NULL,
    and the rest.  Both are lazy filters over the same plan."""
    cond = F.lit(True)
    for name in required:
        cond = cond & F.col(name).isNotNull()
    return df.filter(cond), df.filter(~cond)
