"""Statistics jobs (C11-C14) on the driver's tables.

Roles: counties = nations, invoices = orders (sales) and customers
(heads), scores = lineitem rows with their flags and line number as the
grouping attributes, the keyword rows = lineitem items with their part's
name and type as the descriptive text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from quarry.functions.clean import normalize_key
from quarry.functions.text import split_words
from quarry.operators import keywords as kw
from quarry.operators import moments
from quarry.operators import stats as st
from quarry.sources import table

# The query parameters.
ATTRIBUTES = ["l_returnflag", "l_linestatus", "l_linenumber"]
MEASURES = ["l_quantity", "l_discount", "l_tax"]
CORR_X, CORR_Y = "l_quantity", "l_extendedprice"
KEYWORD_X, KEYWORD_Y = "ring", "gear"
DIGITS = 6


def sales_per_head(spark: SparkSession, sf: str) -> DataFrame:
    """C11: order value per nation of the customer, and value per customer
    head; nations keyed by their normalised name on both sides, full outer.

    Order value is summed per customer key before the customer join."""
    nation = table(spark, sf, "nation").select("n_nationkey", normalize_key("n_name").alias("nation"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_customer = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.sum(F.col("o_totalprice").cast(DecimalType(18, 2))).alias("amount"))
    per_nation = per_customer.join(customer, on="c_custkey") \
        .groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("amount").alias("amount")) \
        .join(nation, on="n_nationkey")
    heads = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")) \
        .agg(F.count(F.lit(1)).alias("heads")).join(nation, on="n_nationkey")
    return st.per_capita(per_nation, "nation", "amount", heads, "nation", "heads", key_name="nation")


def stats_by_attribute(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and population std dev of quantity, discount and tax for
    each value of return flag, line status and line number."""
    out = st.describe_by(table(spark, sf, "lineitem"), ATTRIBUTES, MEASURES)
    return out.select("dim", "value", "n", *[F.round(c, DIGITS).alias(c) for c in out.columns[3:]])


def keyword_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier nation, the number of items whose part name or
    type mentions 'ring' and 'gear'; Pearson r over the nations that
    mention either (nations with neither are not in the sample).

    Items are counted per supplier before the supplier/nation lookup."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    items = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").join(part, on="l_partkey")
    per_supplier = st.keyword_counts(items, "l_suppkey", ["p_name", "p_type"],
                                     {"x": KEYWORD_X, "y": KEYWORD_Y})
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    per_nation = per_supplier.join(supplier, on="l_suppkey").groupBy("s_nationkey") \
        .agg(F.sum("n_x").alias("n_x"), F.sum("n_y").alias("n_y"))
    r = st.correlation(per_nation, "n_x", "n_y")
    return r.select(F.round("pearson", DIGITS).alias("pearson"), F.col("n").alias("n_groups"))


def corr_by_attribute(spark: SparkSession, sf: str) -> DataFrame:
    """C14: Pearson r of quantity and extended price for each value of the
    three attributes."""
    out = st.corr_by(table(spark, sf, "lineitem"), ATTRIBUTES, CORR_X, CORR_Y)
    return out.select("dim", "value", F.round("pearson", DIGITS).alias("pearson"), "n")


def merged_moments(spark: SparkSession, sf: str) -> DataFrame:
    """A9-A14 from parts: the state of every ship year's line items on its own,
    merged over the years for each return flag and line status."""
    keys, measures = ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount"]
    items = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("part"), *keys, *measures)
    state = moments.merge_states(moments.moment_state(items, ["part", *keys], measures), keys, measures)
    out = moments.moment_results(state, keys, measures)
    return out.select(*keys, "n", *[F.round(c, DIGITS).alias(c) for c in out.columns[3:]])


#: Fixed value: how many keywords are looked for.
N_KEYWORDS = 200


def _keywords(spark: SparkSession, sf: str) -> list[str]:
    """The words of three letters and more that most benchmark items hold."""
    words = table(spark, sf, "benchmark").select("item_id", F.explode(split_words("text")).alias("word")) \
        .filter(F.length("word") >= 3).distinct()
    top = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "word").limit(N_KEYWORDS)
    return [r["word"] for r in top.orderBy("word").collect()]


def keyword_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """F7, A7, A12 for 200 keywords at once: documents of a source that contain
    each, and Pearson r of every pair of keywords over the sources."""
    words = _keywords(spark, sf)
    counts = kw.keyword_group_counts(table(spark, sf, "documents"), "source", ["text"], {w: [w] for w in words})
    out = kw.keyword_correlations(counts, "source", words)
    return out.select("x", "y", "n_groups", F.round("pearson", DIGITS).alias("pearson"))


QUERIES = {
    "merged_moments": merged_moments,
    "keyword_pairs": keyword_pairs,
    "sales_per_head": sales_per_head,
    "stats_by_attribute": stats_by_attribute,
    "keyword_correlation": keyword_correlation,
    "corr_by_attribute": corr_by_attribute,
}

_NORM = "regexp_replace(replace(replace(n.n_name, '''', ''), ' County', ''), '[ \t]', '', 'g')"


def _long(cols: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS dim, CAST({a} AS VARCHAR) AS value, {cols} FROM lineitem" for a in ATTRIBUTES)


def _match(word: str) -> str:
    cap = word[:1].upper() + word[1:]
    return "(" + " OR ".join(f"contains({c}, '{s}')" for c in ("p_name", "p_type")
                             for s in (cap, word)) + ")"


ORACLE = {
    "sales_per_head": f"""
        WITH s AS (SELECT {_NORM} AS nation, SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total
                   FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
                   JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1),
             p AS (SELECT {_NORM} AS nation, COUNT(*) AS population
                   FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1)
        SELECT COALESCE(s.nation, p.nation) AS nation,
               CAST(COALESCE(s.total, 0) AS DOUBLE) AS total,
               p.population,
               CAST(COALESCE(s.total, 0) AS DOUBLE) / NULLIF(p.population, 0) AS per_head
        FROM s FULL OUTER JOIN p ON s.nation = p.nation""",
    "stats_by_attribute": f"""
        SELECT dim, value, COUNT(*) AS n,
               {", ".join(f"round(avg({m}), {DIGITS}) AS mean_{m}, round(stddev_pop({m}), {DIGITS}) AS std_{m}"
                          for m in MEASURES)}
        FROM ({_long(", ".join(MEASURES))}) t GROUP BY dim, value""",
    "keyword_correlation": f"""
        WITH j AS (SELECT s.s_nationkey AS g, p.p_name, p.p_type
                   FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
                   JOIN supplier s ON s.s_suppkey = l.l_suppkey),
             c AS (SELECT g, SUM(CASE WHEN {_match(KEYWORD_X)} THEN 1 ELSE 0 END) AS x,
                             SUM(CASE WHEN {_match(KEYWORD_Y)} THEN 1 ELSE 0 END) AS y
                   FROM j WHERE {_match(KEYWORD_X)} OR {_match(KEYWORD_Y)} GROUP BY g)
        SELECT round(covar_pop(x, y) / NULLIF(stddev_pop(x) * stddev_pop(y), 0), {DIGITS}) AS pearson,
               COUNT(*) AS n_groups FROM c""",
    "corr_by_attribute": f"""
        SELECT dim, value,
               round(covar_pop({CORR_X}, {CORR_Y}) / NULLIF(stddev_pop({CORR_X}) * stddev_pop({CORR_Y}), 0),
                     {DIGITS}) AS pearson,
               COUNT(*) AS n
        FROM ({_long(f"{CORR_X}, {CORR_Y}")}) t GROUP BY dim, value""",
    "merged_moments": f"""
        SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
               {", ".join(f"round(avg({m}), {DIGITS}) AS mean_{m}, round(stddev_pop({m}), {DIGITS}) AS std_{m}"
                          for m in ("l_quantity", "l_extendedprice", "l_discount"))},
               {", ".join(f"round(corr({a}, {b}), {DIGITS}) AS corr_{a}_{b}" for a, b in (
                   ("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount")))}
        FROM lineitem GROUP BY 1, 2""",
    "keyword_pairs": rf"""
        WITH b AS (SELECT DISTINCT item_id, word
                   FROM (SELECT item_id, unnest(regexp_split_to_array(text, '\W')) AS word FROM benchmark) t
                   WHERE length(word) >= 3),
             k AS (SELECT word FROM (SELECT word, COUNT(*) AS n FROM b GROUP BY word) t ORDER BY n DESC, word LIMIT {N_KEYWORDS}),
             c AS (SELECT source, word, COUNT(*) AS n FROM documents JOIN k ON contains(text, word) GROUP BY 1, 2),
             p AS (SELECT a.word AS x, b.word AS y FROM k a JOIN k b ON a.word < b.word),
             g AS (SELECT x, y, source, SUM(CASE WHEN word = x THEN n ELSE 0 END) AS nx,
                          SUM(CASE WHEN word = y THEN n ELSE 0 END) AS ny
                   FROM p JOIN c ON word = x OR word = y GROUP BY 1, 2, 3),
             r AS (SELECT x, y, COUNT(*) AS n, SUM(nx) AS sx, SUM(ny) AS sy, SUM(nx * nx) AS qx, SUM(ny * ny) AS qy,
                          SUM(nx * ny) AS pxy FROM g GROUP BY 1, 2)
        SELECT p.x, p.y, COALESCE(n, 0) AS n_groups, round(CAST(n * pxy - sx * sy AS DOUBLE)
                 / NULLIF(sqrt(CAST(n * qx - sx * sx AS DOUBLE)) * sqrt(CAST(n * qy - sy * sy AS DOUBLE)), 0), {DIGITS}) AS pearson
        FROM p LEFT JOIN r ON r.x = p.x AND r.y = p.y""",
}
