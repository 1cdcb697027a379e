"""Readers.

All readers return lazy DataFrames; none infers types (an extra pass over the
data): without a declared schema a CSV's columns are strings named by its
header.  None goes through an RDD.  Parquet tables get column pruning and filter pushdown from Catalyst.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.clean import split_bad_rows
from quarry.sources.records import json_objects, scan_json_records  # noqa: F401
from quarry.sources.sinks import read_ordered, write_ordered, write_table  # noqa: F401

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, ``{sf_dir}/{name}.parquet``."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _with_corrupt(schema: StructType | str, column: str) -> StructType | str:
    """``schema`` plus a string column for unparsable records."""
    if isinstance(schema, StructType):
        return schema if column in schema.names else StructType(schema.fields).add(column, "string")
    names = [part.strip().split()[0].strip("`") for part in schema.split(",") if part.strip()]
    return schema if column in names else f"{schema}, `{column}` string"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             header: bool = True, sep: str = ",", quote: str = '"',
             mode: str = "PERMISSIVE", corrupt_column: str | None = None,
             **options) -> DataFrame:
    """Delimited text.  ``header=True`` skips the first line of each file
    (so a header row never becomes data); with a ``schema`` the columns get
    their names and types by position.  ``sep='\\t'`` reads tab separated
    key/value output of earlier jobs, always the whole folder.

    ``mode`` is Spark's: PERMISSIVE (bad fields become NULL, the raw line
    goes to ``corrupt_column`` if given), DROPMALFORMED or FAILFAST.
    """
    reader = spark.read.options(header=header, sep=sep, quote=quote, mode=mode, **options)
    if schema is not None:
        if corrupt_column:
            schema = _with_corrupt(schema, corrupt_column)
        reader = reader.schema(schema)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def read_fields(spark: SparkSession, path: str | Sequence[str], sep: str = ",",
                column: str = "fields", quote: str | None = None) -> DataFrame:
    """Header-less delimited lines as one array column of raw fields, for
    files whose rows do not share one layout and are addressed by position
    (see :func:`field`), with the line itself as ``line``.

    Without ``quote`` the split is literal.  With it, a separator between
    quotes stays inside its field, the quotes go, and a doubled quote is one.
    """
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    if quote is None:
        fields = F.split(F.col("value"), pattern)
    else:
        q = "\\" + quote if not quote.isalnum() else quote
        one = rf"(?:^|{pattern})({q}(?:[^{q}]|{q}{q})*{q}(?=$|{pattern})|(?:(?!{pattern}).)*)"
        raw = F.regexp_extract_all(F.col("value"), F.lit(one), F.lit(1))
        fields = F.transform(raw, lambda x: F.when(
            x.startswith(quote) & x.endswith(quote) & (F.length(x) > 1),
            F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit(quote * 2), F.lit(quote))).otherwise(x))
    return spark.read.text(path).select(fields.alias(column), F.col("value").alias("line"))


def field(fields: str, position: int):
    """Column: the field at ``position`` of an array of fields, 0-based from
    the start, or counted from the end when negative (-1 is the last);
    NULL when the row is shorter."""
    idx = position + 1 if position >= 0 else position
    return F.try_element_at(F.col(fields), F.lit(idx))


def read_json_records(spark: SparkSession, path: str | Sequence[str], schema: StructType | str,
                      member: str | None = None, multi_line: bool = True,
                      corrupt_column: str | None = None) -> DataFrame:
    """JSON documents (multi-line by default) as rows of ``schema``.

    ``member``: keep only objects that have this member (non-NULL), the way
    a record reader that recognises records by one member does.  A file
    that holds a top-level array yields one row per element.  Broken
    records go to ``corrupt_column`` when given, else become all-NULL rows
    that the ``member`` filter removes.  A multi-line file is one task's;
    ``scan_json_records`` reads files of any size by many.
    """
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = _with_corrupt(schema, corrupt_column)
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    df = reader.schema(schema).json(path)
    if member:
        df = df.filter(F.col(member).isNotNull())
    return df


def base_name(path: str) -> Column:
    """The decoded file name at the end of a path column (``my%20file.txt`` is
    ``my file.txt``); a plus sign is itself."""
    last = F.element_at(F.split(F.col(path), "/"), -1)
    return F.url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))


def read_documents(spark: SparkSession, paths: str | Sequence[str], whole_text: bool = True,
                   doc_column: str = "doc", text_column: str = "text", path_column: str = "path") -> DataFrame:
    """Text files: their full path (what identifies a document: two folders
    may hold files of one name), base name and text.

    ``whole_text=True``: one row per file (``wholetext``), so a document is
    never cut at a split boundary -- and one task holds a whole file.
    ``False``: one row per line, for files of any size.
    """
    df = spark.read.text(paths, wholetext=whole_text)
    return df.select(F.col("_metadata.file_path").alias(path_column), F.col("value").alias(text_column)) \
        .select(path_column, base_name(path_column).alias(doc_column), text_column)


def read_distance_records(spark: SparkSession, path: str | Sequence[str],
                          strict: bool = True) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Lines holding ``[id,paired,distance]`` (anything around the brackets
    is ignored) as ``(id long, paired long, distance double)``.

    A line without such a record fails the job; with ``strict=False`` the
    result is ``(records, rejects)``, the rejects being the other lines.
    """
    raw = spark.read.text(path)
    parts = F.split(F.regexp_extract("value", r"\[([^\]]*)\]", 1), ",")
    typed = raw.select(
        F.col("value").alias("line"),
        F.trim(F.try_element_at(parts, F.lit(1))).try_cast("long").alias("id"),
        F.trim(F.try_element_at(parts, F.lit(2))).try_cast("long").alias("paired"),
        F.trim(F.try_element_at(parts, F.lit(3))).try_cast("double").alias("distance"))
    if strict:
        whole = F.col("id").isNotNull() & F.col("paired").isNotNull() & F.col("distance").isNotNull()
        fail = F.raise_error(F.concat(F.lit("not a distance record: "), F.col("line"))).cast("long")
        return typed.select(F.when(whole, F.col("id")).otherwise(fail).alias("id"), "paired", "distance")
    good, bad = split_bad_rows(typed, ["id", "paired", "distance"])
    return good.select("id", "paired", "distance"), bad.select("line")


def json_field(json_text: str, path: str, dtype: str = "string"):
    """Column: the member at JSON ``path`` (``$.k``) of a JSON text column,
    cast to ``dtype`` (NULL when absent or not castable)."""
    return F.get_json_object(F.col(json_text), path).try_cast(dtype)


def json_members(df: DataFrame, json_text: str, *keep: str, key: str = "key", value: str = "value") -> DataFrame:
    """P21 for all members, none known beforehand: one row per member of the
    JSON object in ``json_text``, ``(keep, key, value)``; a value that is an
    object or an array is its JSON text, a JSON null is NULL.  Rows without an
    object (NULL, broken text, an empty object) give none.  No shuffle."""
    members = F.from_json(F.col(json_text), "map<string,string>")
    return df.select(*keep, F.explode(members).alias(key, value))
