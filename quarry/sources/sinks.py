"""Sinks.

Written by the executors, one file per partition; the driver never sees
the rows.  The default mode refuses to overwrite an existing folder, the
way the original jobs failed when their output folder existed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_table(df: DataFrame, path: str, format: str = "parquet", mode: str = "errorifexists",
                partition_by: list[str] | None = None) -> None:
    """Write ``df`` to ``path``.

    ``format``: ``parquet`` (default), ``csv``, ``tsv`` (``key \\t value``
    lines, no header) or ``text`` (one string column, or all columns joined
    by tabs).
    """
    writer_df = df
    if format == "text" and len(df.columns) != 1:
        writer_df = df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns])
                              .alias("value"))
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "parquet":
        writer.parquet(path)
    elif format == "csv":
        writer.option("header", True).csv(path)
    elif format == "tsv":
        writer.option("sep", "\t").option("header", False).csv(path)
    elif format == "text":
        writer.text(path)
    else:
        raise ValueError(f"unknown format {format!r}")


def write_ordered(df: DataFrame, path: str, order: list[str | Column], files: int, format: str = "parquet",
                  mode: str = "errorifexists") -> None:
    """``df`` in ``order`` over up to ``files`` files that, read in the
    order of their names, are sorted as a whole; no task sorts all rows.

    Rows are ranged over the files by a sample of ``order`` and sorted inside
    each.  Rows equal in ``order`` go to one file: a hot value needs a further
    column in ``order`` to be split over several.
    """
    write_table(df.repartitionByRange(files, *order).sortWithinPartitions(*order), path, format, mode)


def read_ordered(spark: SparkSession, path: str, schema: StructType | str, format: str = "parquet",
                 position: str = "position") -> DataFrame:
    """A folder of :func:`write_ordered` with every row's ``position`` (from 0)
    in the order it was written: by file name, then by place in the file."""
    from quarry.operators.neighbors import with_row_index

    reader = spark.read.schema(schema)
    df = reader.option("sep", "\t").csv(path) if format == "tsv" else reader.format(format).load(path)
    return with_row_index(df, position)
