"""The statistics, similarity and kNN jobs (C11-C17) on their original file
layouts.

* invoices: header-less delimited lines; the county is the third field,
  the two descriptive texts are the fourth and third fields from the end,
  the sale amount is the last field;
* counties: a multi-line JSON document whose records have an ``id`` member
  and text ``county`` / ``population`` members;
* scores: a CSV with a header row; fields 0, 1 and 3 are grouping
  attributes, 5, 6 and 7 are the three scores (possibly quoted);
* documents: text files, one row per line with the file's path and name;
* labels: a CSV with a header row whose last field is the class; the
  distance file holds ``[id,paired,distance]`` records whose ids are row
  positions in the labels file.

Each function reads with the library's sources and runs the library's
operators; every result is a lazy DataFrame (the kNN functions run the
small jobs they need to pick positions first).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.clean import normalize_key, or_raise, split_bad_rows, strip_chars, to_double, to_int
from quarry.operators import neighbors as nb
from quarry.operators import stats as st
from quarry.operators import text as tx
from quarry.operators.common import Scratch
from quarry.operators.rejects import split_once
from quarry.sources import (base_name, field, read_csv, read_distance_records, read_documents, read_fields,
                            read_json_records)

# Positions and keywords of the original jobs.
COUNTY_FIELD, SALE_FROM_END, TEXT_FROM_END = 2, 1, (4, 3)
SCORE_ATTRIBUTES, SCORE_FIELDS = (0, 1, 3), (5, 6, 7)
KEYWORD_X, KEYWORD_Y = "rum", "vodka"
TOP_K = 100


def _invoices(spark: SparkSession, path: str) -> DataFrame:
    """Each row's own fields, quote-aware (a quoted comma stays inside its
    field); positions from the end are that row's.  ``sales`` is NULL where
    the amount does not parse or the row is too short; ``line`` is the row."""
    rows = read_fields(spark, path, quote='"')
    return rows.select(
        field("fields", COUNTY_FIELD).alias("county"),
        F.coalesce(field("fields", -TEXT_FROM_END[0]), F.lit("")).alias("text1"),
        F.coalesce(field("fields", -TEXT_FROM_END[1]), F.lit("")).alias("text2"),
        to_double(field("fields", -SALE_FROM_END)).alias("sales"), "line")


def sales_per_head(spark: SparkSession, invoices: str, counties: str, on_zero: str = "null",
                   strict: bool = True) -> DataFrame | tuple[DataFrame, DataFrame]:
    """C11: total sales and sales per head of each county, counties found
    in only one of the two sources kept (full outer).  Keys are normalised
    on both sides (quotes, blanks; the `` County`` suffix on the JSON side).

    An amount or a population that is not a number fails the job.  With
    ``strict=False`` the result is ``(result, rejects)``: the rows that have
    one are left out and returned as ``(source, line)``."""
    inv = _invoices(spark, invoices)
    raw = read_json_records(spark, counties, "id string, county string, population string", member="id")
    heads = raw.select("county", to_int("population", strip=", ").alias("population"),
                       F.to_json(F.struct("id", "county", "population")).alias("line"))
    if strict:
        inv = inv.withColumn("sales", or_raise(F.col("sales"), F.col("line"), "an invoice with an amount"))
        heads = heads.withColumn("population", or_raise(F.col("population"), F.col("line"), "a county with a population"))
    inv, bad_inv = split_bad_rows(inv, ["county", "sales"])
    heads, bad_heads = split_bad_rows(heads, ["county", "population"])
    out = st.per_capita(inv.select(normalize_key("county", suffix=None).alias("county"), "sales"), "county", "sales",
                        heads.select(normalize_key("county").alias("county"), "population"), "county", "population",
                        key_name="county", on_zero=on_zero)
    if strict:
        return out
    rejects = bad_inv.select(F.lit("invoices").alias("source"), "line") \
        .unionAll(bad_heads.select(F.lit("counties"), "line"))
    return out, rejects


def keyword_correlation(spark: SparkSession, invoices: str, x_keyword: str = KEYWORD_X,
                        y_keyword: str = KEYWORD_Y, **match_opts) -> DataFrame:
    """Rows mentioning each keyword per county, Pearson r over the
    counties that mention either.  Amounts are not read."""
    return st.keyword_correlation(_invoices(spark, invoices), "county", ["text1", "text2"],
                                  x_keyword, y_keyword, **match_opts)


def _safe(name: str) -> str:
    return re.sub(r"\W+", "_", name).strip("_") or "col"


def _scores(spark: SparkSession, path: str, used: Sequence[int] = SCORE_FIELDS) -> tuple[DataFrame, list[str], list[str]]:
    """Typed scores: the attribute columns keep their header names (made
    identifier-safe), the scores at the positions ``used`` become ints with
    quotes removed, NULL where they are none; ``line`` is the row as read."""
    df = read_csv(spark, path, header=True)
    cols = df.columns
    dims = [cols[i] for i in SCORE_ATTRIBUTES]
    measures = [cols[i] for i in used]
    typed = df.select(*[F.col(f"`{d}`").alias(_safe(d)) for d in dims],
                      *[to_int(strip_chars(F.col(f"`{m}`"))).alias(_safe(m)) for m in measures],
                      F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in cols]).alias("line"))
    return typed, [_safe(d) for d in dims], [_safe(m) for m in measures]


#: What the score jobs do with a row whose score is no number.
BAD_SCORES = ("original", "raise", "reject", "skip")


def _score_job(typed: DataFrame, measures: list[str], raising: list[str], bad: str, statistics, scratch: Scratch | None):
    if bad not in BAD_SCORES:
        raise ValueError(f"bad must be one of {BAD_SCORES}")
    strict = {"original": raising, "raise": measures}.get(bad, [])
    typed = typed.withColumns({m: or_raise(F.col(m), F.col("line"), f"a row with a {m}") for m in strict})
    if bad == "reject":
        good, rejects, counts = split_once(typed, measures, scratch or Scratch(typed.sparkSession))
        return statistics(good, "keep"), rejects.select("line"), counts
    return statistics(typed, "keep" if bad == "skip" else "drop")


def score_statistics(spark: SparkSession, path: str, bad: str = "original", scratch: Scratch | None = None):
    """Mean and population std dev of the three scores for each value of
    the three attributes.  ``dim`` names the attribute by its header (made
    identifier-safe, e.g. ``race_ethnicity``); the columns are
    ``mean_<score>`` / ``std_<score>``.

    ``bad`` says what a score that is no number does: ``original`` as in the
    original job (the first score's drops the row's groups, another one's fails
    the job), ``raise`` fails the job for any, ``skip`` leaves the value out of
    its statistics.  With ``reject`` the result is ``(statistics, rejects,
    counts)``: rows with a bad score are left out whole and returned as
    ``line``, and how many rows there were, were rejected and had no such score;
    the file is read once, into ``scratch``."""
    typed, dims, measures = _scores(spark, path)
    return _score_job(typed, measures, measures[1:], bad, lambda df, groups: st.describe_by(df, dims, measures, groups), scratch)


def score_correlation(spark: SparkSession, path: str, bad: str = "original", scratch: Scratch | None = None):
    """C14: Pearson r of the first and the third score for each value of the
    three attributes; the second score is not read.  ``bad`` as in
    :func:`score_statistics`; ``original`` drops the groups of a row with a bad
    score, whichever it is, as the original job did."""
    typed, dims, measures = _scores(spark, path, SCORE_FIELDS[::2])
    return _score_job(typed, measures, [], bad, lambda df, groups: st.corr_by(df, dims, *measures, bad_groups=groups), scratch)


def document_similarity(spark: SparkSession, paths: str | Sequence[str], threshold: float,
                        k: int = TOP_K, keep_empty: bool = True, denominator: str = "fixed") -> DataFrame:
    """Pairs of files whose Dice coefficient over their ``k`` most
    frequent words reaches ``threshold`` (denominator ``2k`` by default):
    ``doc_a, doc_b, overlap, dice, path_a, path_b``, the first two being the
    base names.  Files are told apart by their full path.
    ``keep_empty=True`` counts the empty tokens a line-wise split yields, as
    originally.  Pairs with no common word are never produced."""
    docs = read_documents(spark, paths, whole_text=False)
    counts = tx.word_counts(docs, "path", "text", keep_empty=keep_empty)
    pairs = tx.dice_join(tx.top_words(counts, "path", k=k), "path", threshold=threshold, k=k,
                         denominator=denominator, doc_a="path_a", doc_b="path_b")
    return pairs.select(base_name("path_a").alias("doc_a"), base_name("path_b").alias("doc_b"), "overlap", "dice",
                        "path_a", "path_b")


def knn_predictions(spark: SparkSession, labels_csv: str, distances: str, k: int) -> DataFrame:
    """C17: predicted and actual class of every labelled row from the k
    nearest rows in the distance file (ids = row positions in the labels
    file), by id; vote ties go to the smallest class.  A class that is not a
    number and a line without a distance record fail the job."""
    labels = read_csv(spark, labels_csv, header=True)
    label_col = labels.columns[-1]
    indexed = nb.with_row_index(labels.select(to_double(F.col(f"`{label_col}`"), strict=True).alias("label")))
    near = nb.k_nearest(read_distance_records(spark, distances), k)
    return nb.knn_classify(near, indexed).orderBy("id")


def knn_evaluation(spark: SparkSession, labels_csv: str, distances: str, k: int) -> tuple[DataFrame, DataFrame]:
    """C17: (confusion matrix, accuracy) of :func:`knn_predictions`."""
    pred = knn_predictions(spark, labels_csv, distances, k)
    return nb.confusion_matrix(pred), nb.accuracy(pred)
