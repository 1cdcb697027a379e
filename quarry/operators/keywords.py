"""Rows that mention keywords, for many keywords at once.

One pattern finds them all in one pass: the keywords as a trie, matched by a
look-ahead at every position, so a text is read once however many keywords
there are.  At a position the longest keyword matches; others that match there
begin it, and are added from a table of beginnings.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.stats import _regex_escape, _spellings

Keywords = Sequence[str] | Mapping[str, str | Sequence[str]]


def _by_spelling(keywords: Keywords) -> dict[str, list[str]]:
    """Keyword names by spelling.  A name alone is spelled as in
    ``keyword_match``: capitalised and in lower case."""
    pairs = keywords.items() if isinstance(keywords, Mapping) else [(k, k) for k in keywords]
    out: dict[str, list[str]] = {}
    for name, spelled in pairs:
        for s in dict.fromkeys(_spellings(spelled) if isinstance(spelled, str) else spelled):
            if s and name not in out.setdefault(s, []):
                out[s].append(name)
    return out


def trie_pattern(words: Sequence[str]) -> str:
    """A regular expression that matches the longest of ``words`` at a place."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def write(node: dict) -> str:
        ways = [_regex_escape(c) + write(node[c]) for c in sorted(node) if c]
        if not ways:
            return ""
        body = ways[0] if len(ways) == 1 and "" not in node else f"(?:{'|'.join(ways)})"
        return body + "?" if "" in node else body
    return write(root)


def mentioned(text_cols: Sequence[str], keywords: Keywords) -> Column:
    """Array of the names of all keywords that any of ``text_cols`` contains
    (as a substring), each once.  The plan does not grow with the keywords."""
    spelled = _by_spelling(keywords)
    if not spelled:
        return F.array().cast("array<string>")
    # what else matches where a spelling does: the spellings that begin it
    starts = {s: sorted({name for i in range(1, len(s) + 1) for name in spelled.get(s[:i], [])}) for s in spelled}
    names = F.from_json(F.lit(json.dumps(starts)), "map<string,array<string>>")
    found = F.concat(*[F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(f"(?=({trie_pattern(list(spelled))}))"), F.lit(1))
                       for c in text_cols])
    return F.array_distinct(F.flatten(F.transform(F.array_distinct(found), lambda s: F.element_at(names, s))))


def keyword_group_counts(df: DataFrame, group: str, text_cols: Sequence[str], keywords: Keywords) -> DataFrame:
    """F7, A7 for many keywords: ``(group, keyword, n)``, the number of the
    group's rows that mention a keyword; a row counts for several.  Only counts
    are shuffled, combined before."""
    return df.select(group, F.explode(mentioned(text_cols, keywords)).alias("keyword")) \
        .groupBy(group, "keyword").agg(F.count(F.lit(1)).alias("n"))


def keyword_correlations(counts: DataFrame, group: str, keywords: Sequence[str], name: str = "pearson") -> DataFrame:
    """A12 for all pairs of ``keywords``: ``(x, y, n_groups, pearson)`` with ``x``
    before ``y`` in the list, over the groups that mention either (as
    ``keyword_correlation`` has it for one pair; NULL where a side is constant).

    Sums of a keyword and of products of two are taken over the groups of
    ``counts`` (the Gram matrix); a group without a keyword adds nothing, so
    pairs that no group shares need no row.  The pairs themselves come from
    the list: ``len(keywords)`` squared over two."""
    spark = counts.sparkSession
    number = spark.createDataFrame([(k, i) for i, k in enumerate(keywords)], "keyword string, i int")
    c = counts.join(number, "keyword").select(F.col(group).alias("g"), "i", "n")
    one = c.groupBy("i").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"), F.count(F.lit(1)).alias("m"))
    both = c.alias("a").join(c.alias("b"), (F.col("a.g") == F.col("b.g")) & (F.col("a.i") < F.col("b.i"))) \
        .groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")) \
        .agg(F.sum(F.col("a.n") * F.col("b.n")).alias("p"), F.count(F.lit(1)).alias("shared"))
    pairs = number.select("i", F.col("keyword").alias("x")) \
        .withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(len(keywords) - 1)))).filter(F.col("j") > F.col("i")) \
        .join(number.select(F.col("i").alias("j"), F.col("keyword").alias("y")), "j")
    full = pairs.join(both, ["i", "j"], "left") \
        .join(one.toDF("i", "sx", "qx", "mx"), "i", "left").join(one.toDF("j", "sy", "qy", "my"), "j", "left") \
        .na.fill(0, ["p", "shared", "sx", "qx", "mx", "sy", "qy", "my"])
    n = F.col("mx") + F.col("my") - F.col("shared")

    def spread(q: str, s: str) -> Column:
        return F.sqrt((n * F.col(q) - F.col(s) * F.col(s)).cast("double"))  # whole numbers up to here
    r = F.try_divide((n * F.col("p") - F.col("sx") * F.col("sy")).cast("double"), spread("qx", "sx") * spread("qy", "sy"))
    return full.select("x", "y", n.alias("n_groups"), r.alias(name))
