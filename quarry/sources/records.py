"""JSON objects of files of any size, read by many tasks.

``multiLine`` JSON makes a file one task.  Here a file is read as text whose
lines end at ``}``, which Spark cuts into splits like any other text; whether a
brace stands inside a quoted string, and how deep it is, follows from what
stands before it, and is carried over by prefix sums: a split is cut into chunks
of ``CHUNK`` pieces, each chunk is summed up to a few numbers, and one row a chunk
passes them on.  Chunks are dealt over all tasks, whatever the sizes of files and
splits.  Objects that lie in one chunk are put together where its rows are; only
the two at its borders meet those of the next chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Pieces (texts up to a closing brace) that are numbered together.
CHUNK = 1 << 16

_CHUNK = ["_file", "_start", "_chunk"]


def _outside(text: Column, inside: bool) -> Column:
    """What of a piece (without escapes) stands outside quoted strings, if it
    begins outside of one or ``inside``."""
    if inside:
        text = F.regexp_replace(text, '^[^"]*("|$)', "")
    return F.regexp_replace(text, '"[^"]*("|$)', "")


def _braces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))


def json_objects(spark: SparkSession, path: str | Sequence[str], column: str = "value") -> DataFrame:
    """The text of every outermost JSON object of the files, one a row:
    ``(file, value)``, whatever stands between objects (an array's brackets and
    commas, line breaks, nothing).

    Braces and quotes inside strings, escaped quotes and nested objects are
    read as JSON has them.  An object cut off by the end of its file is left
    out.  Files must be well-formed up to their end: an unpaired quote turns the
    rest of its file inside out.  Compressed files are one task each.
    """
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").alias("_text"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_at")) \
        .withColumn("_chunk", F.floor(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(CHUNK)))
    # a piece never begins within an escape: a backslash before a brace is itself escaped
    plain = F.regexp_replace("_text", r"(?s)\\.", "")
    marks = raw.select(
        *_CHUNK, "_size", "_at", (F.octet_length("_text") + 1).alias("_bytes"),
        (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).alias("_quotes"),
        _braces(_outside(plain, False)).alias("_open0"), _braces(_outside(plain, True)).alias("_open1"))
    rows = Window.partitionBy(*_CHUNK).orderBy("_at")
    earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
    chunks = Window.partitionBy("_file").orderBy("_start", "_chunk")  # one row a chunk
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)

    def base(df: DataFrame, *sums: Column) -> DataFrame:
        """One row a chunk: what all chunks before it of its file sum up to."""
        names = [f"_s{i}" for i in range(len(sums))]
        one = df.groupBy(*_CHUNK).agg(*[s.alias(n) for s, n in zip(sums, names, strict=True)])
        return one.select(*_CHUNK, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_b{i}") for i, n in enumerate(names)])

    def stated(df: DataFrame, quotes: DataFrame) -> DataFrame:
        """Every piece's opening braces, and whether its own brace (if it has one) closes."""
        # the sums first: their order is the join's, too, so rows are sorted once
        known = df.withColumn("_inner", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0))).join(quotes, _CHUNK) \
            .withColumn("_ended", F.col("_full") | (F.struct("_start", "_at") != F.col("_end"))).drop("_full", "_end")
        start = (F.col("_b0") + F.col("_inner")) % 2 == 1
        end = (F.when(start, 1).otherwise(0) + F.col("_quotes")) % 2 == 1
        return known.withColumn("_net", F.when(start, F.col("_open1")).otherwise(F.col("_open0"))
                                - F.when(F.col("_ended") & ~end, 1).otherwise(0)) \
            .withColumn("_closes", F.col("_ended") & ~end).drop("_b0", "_inner")

    def deep(df: DataFrame, depth: DataFrame) -> DataFrame:
        """Whether an outermost object ends with the piece."""
        inner = df.withColumn("_inner", F.sum("_net").over(rows.rowsBetween(Window.unboundedPreceding, 0)))
        return inner.join(depth, _CHUNK) \
            .withColumn("_last", F.col("_closes") & (F.col("_b0") + F.col("_inner") == 0)).drop("_b0", "_inner")

    # the last piece of a file ends with a brace only if the pieces and their braces fill the file
    whole = marks.groupBy("_file").agg((F.sum("_bytes") == F.max("_size")).alias("_full"),
                                       F.max(F.struct("_start", "_at")).alias("_end"))

    quotes = base(marks, F.sum("_quotes")).join(whole, "_file")  # rows of chunks, not of pieces
    pieces = stated(marks, quotes)
    depth = base(pieces, F.sum("_net"))
    ends = base(deep(pieces, depth), F.count_if("_last"))

    full = raw.select("*", *[c.alias(n) for c, n in (
        (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit(""))), "_quotes"),
        (_braces(_outside(plain, False)), "_open0"), (_braces(_outside(plain, True)), "_open1"))])
    numbered = deep(stated(full, quotes), depth).join(ends, _CHUNK) \
        .withColumn("_object", F.col("_b0") + F.coalesce(F.sum(F.col("_last").cast("long")).over(earlier), F.lit(0)))
    text = F.concat("_text", F.when(F.col("_ended"), "}").otherwise(""))

    def put_together(df: DataFrame, by: list[str], order: list[str], part: Column) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(*order, part.alias("_part"))))
        return df.groupBy(*by).agg(F.array_join(F.transform(parts, lambda x: x["_part"]), "").alias("_whole"),
                                   F.max("_last").alias("_last"), F.min("_b0").alias("_b0"))

    inside = put_together(numbered, [*_CHUNK, "_object"], ["_at"], text)
    # an object that may go on over the border: a chunk's first, and one that has not ended there
    border = (F.col("_object") == F.col("_b0")) | ~F.col("_last")
    crossing = put_together(inside.filter(border), ["_file", "_object"], ["_start", "_chunk"], F.col("_whole"))
    done = inside.filter(~border).select("_file", "_whole").unionAll(crossing.filter("_last").select("_file", "_whole"))
    return done.select(F.col("_file").alias("file"), F.regexp_replace("_whole", r"^[^{]*", "").alias(column))


def scan_json_records(spark: SparkSession, path: str | Sequence[str], schema: StructType | str, member: str | None = None,
                      corrupt_column: str | None = None) -> DataFrame:
    """S5 for files of any size: the files' outermost objects as rows of
    ``schema``, like ``read_json_records`` but read by many tasks.

    ``member``: keep only objects that have this member (not NULL).  An object
    that is no JSON gives NULLs, and its text in ``corrupt_column`` if given."""
    options = {"mode": "PERMISSIVE"}
    if corrupt_column:
        schema = schema if isinstance(schema, str) else schema.toDDL()
        schema, options["columnNameOfCorruptRecord"] = f"{schema}, `{corrupt_column}` string", corrupt_column
    out = json_objects(spark, path).select(F.from_json("value", schema, options).alias("r")).select("r.*")
    return out.filter(F.col(member).isNotNull()) if member else out
