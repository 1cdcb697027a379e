"""Source-level and cleaning operators on the driver's tables.

The cleaning queries make text in the original files' layouts from table
columns (quoted names, ``3-Oct-2007`` dates, amounts with blanks and commas)
and read it back with the library's expressions; the file queries write tables
in the layouts of the original files and read these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import clean
from quarry.operators import stats as st
from quarry.operators.common import Scratch
from quarry.operators.neighbors import with_row_index
from quarry.operators.rejects import split_once
from quarry.sources import json_field as _json_field
from quarry.sources import (field, json_members, read_csv, read_distance_records, read_documents, read_fields,
                            read_json_records, read_ordered, scan_json_records, table, write_ordered, write_table)


def json_field(spark: SparkSession, sf: str) -> DataFrame:
    """Member ``k`` of the JSON text in ``events.props``, as int."""
    return table(spark, sf, "events").select("event_id", _json_field("props", "$.k", "int").alias("k"))


def clean_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Quoted day-month-year texts back to dates, and formatted."""
    text = F.concat(F.lit(" '"), F.date_format("o_orderdate", "d-MMM-yyyy"), F.lit("'"))
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("quoted"))
    day = clean.to_date(clean.unquote("quoted"))
    return rows.select("o_orderkey", day.alias("day"), clean.format_date(day).alias("day_text"))


def clean_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers from padded, comma-grouped and double-quoted texts."""
    rows = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit(" "), F.format_number(F.col("p_partkey") * 1000, 0), F.lit(" ")).alias("grouped"),
        F.concat(F.lit('"'), F.col("p_size").cast("string"), F.lit('"')).alias("quoted"),
        F.concat(F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit(" ")).alias("price"))
    return rows.select("p_partkey", clean.to_int("grouped", strip=", ", dtype="long").alias("grouped"),
                       clean.to_int(clean.strip_chars("quoted")).alias("size"), clean.to_double("price").alias("price"))


def bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """events whose ``props`` member ``k`` is an even number, and the
    rejected rest, split by one condition; how many of each a type."""
    k = clean.to_int(_json_field("props", "$.k"))
    rows = table(spark, sf, "events").select("event_type", F.when(k % 2 == 0, k).alias("k"))
    good, bad = clean.split_bad_rows(rows, ["k"])
    both = good.select("event_type", F.lit(1).alias("g")).unionAll(bad.select("event_type", F.lit(0).alias("g")))
    return both.groupBy("event_type").agg(F.sum("g").alias("n_good"), F.sum(1 - F.col("g")).alias("n_bad"))


def one_sided_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Characters of each document per quality label, full outer over
    keys that really are one-sided (documents without a label, and labels
    keyed by another name); keys normalised."""
    docs = table(spark, sf, "documents").select(
        clean.normalize_key(F.concat(F.lit("doc "), F.col("doc_id").cast("string"), F.lit(" County"))).alias("key"), "n_chars")
    labels = table(spark, sf, "labels").select(
        clean.normalize_key(F.concat(F.when(F.col("quality") == 1, F.lit("'doc' ")).otherwise(F.lit("low ")),
                                     F.col("doc_id").cast("string")), suffix=None).alias("key"),
        (F.col("quality") + 1).alias("weight"))
    return st.per_capita(docs, "key", "n_chars", labels, "key", "weight", key_name="key", scale=0)


def all_json_members(spark: SparkSession, sf: str) -> DataFrame:
    """Every member of ``events.props``, keys not known beforehand."""
    return json_members(table(spark, sf, "events"), "props", "event_id")


def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """The events as multi-line JSON objects (nested ones, braces and quotes
    inside strings), written to files and scanned by many tasks."""
    path = Scratch(spark).child()
    note = F.concat(F.lit("} {\""), F.col("event_type"), F.lit("\\"))
    rows = table(spark, sf, "events").select("event_id", "value", note.alias("note"), F.struct(
        F.col("user_id").alias("user"), F.struct(F.col("event_type").alias("type")).alias("of")).alias("who"))
    text = F.replace(F.to_json(F.struct("event_id", "value", "note", "who")), F.lit(",\"who"), F.lit(",\n  \"who"))
    write_table(rows.select(F.concat(text, F.lit(",")).alias("value")), path, "text")
    back = scan_json_records(spark, path, "event_id long, value double, note string, "
                                          "who struct<user: long, of: struct<type: string>>", member="event_id")
    return back.select("event_id", "value", "note", F.col("who.user").alias("user_id"), F.col("who.of.type").alias("event_type"))


def ordered_export(spark: SparkSession, sf: str) -> DataFrame:
    """Orders sorted by status (three values) and key over many files,
    read back in the files' order; a row's position is its rank."""
    path, order = Scratch(spark).child(), ["o_orderstatus", "o_orderkey"]
    write_ordered(table(spark, sf, "orders").select(*order, "o_totalprice"), path, order, files=50, format="tsv")
    return read_ordered(spark, path, "o_orderstatus string, o_orderkey long, o_totalprice double", "tsv")


def csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as a CSV with blanks and quotes in
    its header names, read by name, cleaned, and by a declared schema."""
    path = Scratch(spark).child()
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias(" Id"), F.concat(
        F.lit("'"), F.col("c_name"), F.lit("'")).alias(" 'Name'"), F.col("c_acctbal").alias("Balance "))
    write_table(rows, path, "csv")
    named = clean.column_names(read_csv(spark, path)).select(
        clean.to_int("Id", dtype="long").alias("id"), clean.unquote("Name").alias("name"))
    typed = read_csv(spark, path, schema="id long, quoted string, balance double")
    return named.join(typed, "id").select("id", "name", "balance")


def positional_files(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines of differing length, addressed from both ends, and
    tab-separated key/value output read as a folder."""
    scratch = Scratch(spark)
    lines, pairs = scratch.child(), scratch.child()
    orders = table(spark, sf, "orders")
    extra = F.when(F.col("o_orderkey") % 3 == 0, F.lit('"a, b",')).otherwise(F.lit(""))
    write_table(orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(","), extra, F.col("o_orderstatus"), F.lit(","),
                                       F.col("o_totalprice").cast("string")).alias("value")), lines, "text")
    write_table(orders.select("o_orderkey", "o_custkey"), pairs, "tsv")
    fields = read_fields(spark, lines, quote='"').select(
        field("fields", 0).cast("long").alias("o_orderkey"), field("fields", -2).alias("status"),
        field("fields", -1).cast("double").alias("price"), F.size("fields").alias("n_fields"))
    return fields.join(read_csv(spark, pairs, schema="o_orderkey long, o_custkey long", header=False, sep="\t"), "o_orderkey")


def document_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as text files, a folder a source, read back line by
    line with the file they come from; lines and characters a source."""
    path = Scratch(spark).child()
    docs = table(spark, sf, "documents").filter(F.col("text").isNotNull())
    docs.select("source", F.regexp_replace("text", "[\r\n]+", " ").alias("value")).write.partitionBy("source").text(path)
    back = read_documents(spark, path, whole_text=False)
    of = F.regexp_extract("path", "source=([^/]*)/", 1)
    return back.withColumn("source", of).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("text")).alias("n_chars"),
        F.bool_and(F.col("doc").endswith(".txt")).alias("named"))


def distance_file(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys and customers as bracketed records, read back, and
    rows numbered without gaps; sorted by the number."""
    path = Scratch(spark).child()
    rows = table(spark, sf, "orders").select(F.concat(
        F.lit("(x, ["), F.col("o_orderkey").cast("string"), F.lit(", "), F.col("o_custkey").cast("string"), F.lit(" ,"),
        F.col("o_totalprice").cast("string"), F.lit("])")).alias("value"))
    write_table(rows, path, "text")
    back = with_row_index(read_distance_records(spark, path), "position")
    return back.agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("first"), F.max("position").alias("last"),
                    F.count_distinct("position").alias("positions"), F.sum("id").alias("ids"), F.sum("paired").alias("paired"),
                    F.round(F.sum(F.col("distance").cast("decimal(18,2)")), 2).cast("double").alias("distance"))


def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    """events without an even member ``k`` or without a value of 50 or
    more, split in one pass; both parts and the counts that came with it."""
    events = table(spark, sf, "events")
    k = clean.to_int(_json_field("props", "$.k"))
    rows = events.select("event_type", F.when(k % 2 == 0, k).alias("k"), F.when(F.col("value") >= 50, F.col("value")).alias("high"))
    good, rejects, counts = split_once(rows, ["k", "high"], Scratch(spark))
    said = F.create_map(*[x for n in ("rows", "rejected", "no_k", "no_high") for x in (F.lit(n), F.lit(counts[n]).cast("long"))])
    parts = good.select(F.lit("good").alias("part"), "event_type").unionAll(rejects.select(F.lit("rejects"), "event_type"))
    return parts.groupBy("part", "event_type").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "event_type", "n", said["rows"].alias("rows"), said["rejected"].alias("rejected"),
        said["no_k"].alias("no_k"), said["no_high"].alias("no_high"))


QUERIES = {"json_field": json_field, "clean_dates": clean_dates, "clean_numbers": clean_numbers, "bad_rows": bad_rows,
           "one_sided_ratio": one_sided_ratio, "all_json_members": all_json_members, "json_records": json_records,
           "ordered_export": ordered_export, "csv_files": csv_files, "positional_files": positional_files,
           "document_files": document_files, "distance_file": distance_file, "reject_counts": reject_counts}

ORACLE = {
    "json_field": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "clean_dates": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(CAST(o_orderdate AS DATE), '%d-%b-%Y') AS day_text
        FROM orders""",
    "clean_numbers": """
        SELECT p_partkey, CAST(p_partkey * 1000 AS BIGINT) AS grouped, CAST(p_size AS INTEGER) AS size,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM part""",
    "bad_rows": """
        SELECT event_type, COUNT(*) FILTER (WHERE k % 2 = 0) AS n_good,
               COUNT(*) FILTER (WHERE k IS NULL OR k % 2 <> 0) AS n_bad
        FROM (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) t
        GROUP BY event_type""",
    "one_sided_ratio": """
        WITH s AS (SELECT 'doc' || doc_id AS key, SUM(n_chars) AS total FROM documents GROUP BY 1),
             p AS (SELECT CASE WHEN quality = 1 THEN 'doc' ELSE 'low' END || doc_id AS key, quality + 1 AS population
                   FROM labels)
        SELECT COALESCE(s.key, p.key) AS key, CAST(COALESCE(s.total, 0) AS DOUBLE) AS total,
               CAST(p.population AS BIGINT) AS population,
               CAST(COALESCE(s.total, 0) AS DOUBLE) / NULLIF(p.population, 0) AS per_head
        FROM s FULL OUTER JOIN p ON s.key = p.key""",
    "all_json_members": """
        SELECT event_id, k AS key, json_extract_string(props, '$."' || k || '"') AS value
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events WHERE props IS NOT NULL) t""",
    "json_records": r"""
        SELECT event_id, value, '} {"' || event_type || '\' AS note, user_id, event_type FROM events""",
    "ordered_export": """
        SELECT o_orderstatus, o_orderkey, o_totalprice,
               row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1 AS position FROM orders""",
    "csv_files": "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer",
    "positional_files": """
        SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price,
               CAST(CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 3 END AS INTEGER) AS n_fields, o_custkey FROM orders""",
    "document_files": r"""
        SELECT source, COUNT(*) AS n_lines, CAST(SUM(length(regexp_replace(text, '[\r\n]+', ' ', 'g'))) AS BIGINT) AS n_chars,
               TRUE AS named FROM documents WHERE text IS NOT NULL GROUP BY source""",
    "distance_file": """
        SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS first, COUNT(*) - 1 AS last, COUNT(*) AS positions,
               CAST(SUM(o_orderkey) AS BIGINT) AS ids, CAST(SUM(o_custkey) AS BIGINT) AS paired,
               CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS distance FROM orders""",
    "reject_counts": """
        WITH e AS (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value FROM events),
             f AS (SELECT event_type, coalesce(k % 2 = 0, FALSE) AS has_k, coalesce(value >= 50, FALSE) AS has_high FROM e),
             t AS (SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE NOT (has_k AND has_high)) AS rejected,
                          COUNT(*) FILTER (WHERE NOT has_k) AS no_k, COUNT(*) FILTER (WHERE NOT has_high) AS no_high FROM f)
        SELECT CASE WHEN has_k AND has_high THEN 'good' ELSE 'rejects' END AS part, event_type, COUNT(*) AS n,
               MIN(rows) AS rows, MIN(rejected) AS rejected, MIN(no_k) AS no_k, MIN(no_high) AS no_high
        FROM f, t GROUP BY 1, 2""",
}
