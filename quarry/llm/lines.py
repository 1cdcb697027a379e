"""Line dedup by site-relative frequency, in Spark's own functions only.

A line that stands on a large share of one host's pages is boilerplate of
that site (menus, notices, footers), however rare it is elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WorkFolder

#: What is trimmed from a line's ends before it is compared: ASCII white space.
_EDGES = " \t\x0b\x0c\r"


def line_keys(text: Column) -> Column:
    """64-bit hashes of the trimmed lines of a text, in order; null for blank
    lines.  (A wrong cut needs a line to hash like one of its host's few
    boilerplate lines: about 2**-55 a line.)"""
    def key(x: Column) -> Column:
        line = F.btrim(x, F.lit(_EDGES))
        return F.when(line != "", F.xxhash64(line))
    return F.transform(F.split(text, "\n"), key)


def boilerplate_lines(pages: DataFrame, host: str, text: str, ratio: float = 0.1,
                      min_pages: int = 3, copies: bool = False) -> DataFrame:
    """``(_host, keys)``: each host's lines that stand on more than ``ratio`` of
    its pages, and on ``min_pages`` at least.  A page is a different text of
    the host: all its rows with the same text are one, for lines and for page
    totals (``copies=True``: every row is a page of its own).

    A page counts a line once (repeats inside it are removed before the
    shuffle) and only fixed-width keys travel, counted per task first.  A host
    has at most (mean lines a page) / ``ratio`` such lines, so the list is
    bounded however many pages the host has.
    """
    spans = pages.select(F.col(f"`{host}`").alias("_host"),
                         F.array_distinct(line_keys(F.col(f"`{text}`"))).alias("_keys"))
    if not copies:  # one row a host and text; tasks fold their own copies before the shuffle
        spans = pages.select(F.col(f"`{host}`").alias("_host"), F.xxhash64(F.col(f"`{text}`")).alias("_text"),
                             F.array_distinct(line_keys(F.col(f"`{text}`"))).alias("_keys")) \
            .groupBy("_host", "_text").agg(F.first("_keys").alias("_keys"))
    totals = spans.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    counts = spans.select("_host", F.explode("_keys").alias("_key")).filter(F.col("_key").isNotNull()) \
        .groupBy("_host", "_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_pages)
    return counts.join(totals, counts["_host"].eqNullSafe(totals["_host"])) \
        .filter(F.col("_n") > F.lit(ratio) * F.col("_pages")) \
        .groupBy(counts["_host"].alias("_host")).agg(F.collect_list("_key").alias("_drop"))


def drop_boilerplate(pages: DataFrame, host: str, text: str, work: WorkFolder, ratio: float = 0.1,
                     min_pages: int = 3, dropped: str | None = None, broadcast_keys: int = 2_000_000,
                     salts: int = 32, copies: bool = False) -> DataFrame:
    """``pages`` with boilerplate lines cut out of ``text``; every row stays.

    Lines are what stands between newline characters, compared without the
    white space around them; a line goes if it stands on more than ``ratio``
    of the host's pages (and on ``min_pages`` at least).  Blank lines are kept
    and never counted.  Null texts stay null and count as pages without
    lines; empty texts stay empty; a text of boilerplate only becomes empty.
    A null host is a host of its own.  A host's rows of equal text are one
    page, so that a text does not become boilerplate of its host by being
    copied (``copies=True``: each is one).  Long texts are read whole; columns
    named like an intermediate are kept as they are; no rows give no rows.

    ``min_pages`` is part of the law: two pages that share a line may be two
    versions of one text, from three on it is a habit of the site.
    ``dropped`` names an optional column with the number of lines cut.

    The lists are written once and their keys counted: up to
    ``broadcast_keys`` (16 MB) every task gets them and the texts stay where
    they are.  Beyond that texts and lists are joined by host and a salt, so a
    host with a third of all pages is still ``salts`` parts.
    """
    drop = work.save(boilerplate_lines(pages, host, text, ratio, min_pages, copies), "boilerplate")
    keys = drop.agg(F.sum(F.size("_drop"))).first()[0] or 0
    names = pages.columns
    if keys <= broadcast_keys:
        same = F.col(f"p.`{host}`").eqNullSafe(F.col("d._host"))
        p = pages.alias("p").join(F.broadcast(drop).alias("d"), same, "left")
    else:
        part = drop.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64(F.col(f"p.`{text}`")), F.lit(salts)).cast("int")
        p = pages.alias("p").join(part.alias("d"), F.col(f"p.`{host}`").eqNullSafe(F.col("d._host"))
                                  & (salt == F.col("d._salt")), "left")
    lines = F.split(F.col(f"p.`{text}`"), "\n")
    keyed = F.arrays_zip(lines.alias("line"), line_keys(F.col(f"p.`{text}`")).alias("key"))
    kept = F.filter(keyed, lambda x: x["key"].isNull() | ~F.array_contains(F.col("d._drop"), x["key"]))
    cleaned = F.when(F.col("d._drop").isNull(), F.col(f"p.`{text}`")) \
        .otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"))
    out = [cleaned.alias(c) if c == text else F.col(f"p.`{c}`") for c in names if c != dropped]
    if dropped:
        out.append(F.when(F.col("d._drop").isNull() | F.col(f"p.`{text}`").isNull(), F.lit(0))
                   .otherwise(F.size(lines) - F.size(kept)).cast("long").alias(dropped))
    return p.select(*out)
