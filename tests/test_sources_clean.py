"""Readers, sinks and cleaning on small invented files (FIXTURES.md B)."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quarry.functions import clean
from quarry.sources import (json_field, read_csv, read_distance_records, read_documents,
                            read_json_records, write_table)
from tests.conftest import write

CUSTOMERS = """Id, LastName, FirstName
1, 'SMITH', 'ANN'
 2, 'SMITH', 'ANN'
3, 'O'HARA', 'BO'
4, NOQUOTE, 'X'
"""

RECEIPTS = """RecieptNumber, Date, CustomerId
10, '3-Oct-2007', 1
11, '03-OCT-2007', 1
12, '31-Oct-2007', 2
"""


def test_header_names_cleaned(spark, tmp_dir):
    df = read_csv(spark, write(os.path.join(tmp_dir, "c.csv"), CUSTOMERS))
    assert df.columns == ["Id", " LastName", " FirstName"]
    assert clean.column_names(df).columns == ["Id", "LastName", "FirstName"]


def test_unquote_and_ints(spark, tmp_dir):
    schema = "Id string, LastName string, FirstName string"
    df = read_csv(spark, write(os.path.join(tmp_dir, "c.csv"), CUSTOMERS), schema=schema)
    out = df.select(clean.to_int("Id").alias("id"), clean.unquote("LastName").alias("last")) \
        .orderBy("id").collect()
    assert [(r.id, r.last) for r in out] == [(1, "SMITH"), (2, "SMITH"), (3, "O'HARA"), (4, None)]


def test_unquote_strict_raises(spark, tmp_dir):
    schema = "Id string, LastName string, FirstName string"
    df = read_csv(spark, write(os.path.join(tmp_dir, "c.csv"), CUSTOMERS), schema=schema)
    with pytest.raises(PySparkException):
        df.select(clean.unquote("LastName", strict=True)).collect()


def test_split_bad_rows(spark, tmp_dir):
    schema = "Id string, LastName string, FirstName string"
    df = read_csv(spark, write(os.path.join(tmp_dir, "c.csv"), CUSTOMERS), schema=schema) \
        .select(clean.to_int("Id").alias("id"), clean.unquote("LastName").alias("last"))
    good, bad = clean.split_bad_rows(df, ["id", "last"])
    assert good.count() == 3 and bad.count() == 1


def test_int_strict_vs_lenient(spark):
    df = spark.createDataFrame([(" 7",), ("x",)], "s string")
    assert [r[0] for r in df.select(clean.to_int("s")).collect()] == [7, None]
    with pytest.raises(PySparkException):
        df.select(clean.to_int("s", strict=True)).collect()


def test_population_number(spark):
    df = spark.createDataFrame([("1,234 567",), ("1,234 ",)], "s string")
    assert [r[0] for r in df.select(clean.to_int("s", strip=", ")).collect()] == [1234567, 1234]


def test_dates_parse_and_format(spark, tmp_dir):
    schema = "r string, d string, c string"
    df = read_csv(spark, write(os.path.join(tmp_dir, "r.csv"), RECEIPTS), schema=schema)
    out = df.select(clean.to_date(clean.unquote("d")).alias("d")) \
        .select("d", clean.format_date("d").alias("t")).collect()
    assert [r.d for r in out] == [dt.date(2007, 10, 3), dt.date(2007, 10, 3), dt.date(2007, 10, 31)]
    assert [r.t for r in out] == ["03-Oct-2007", "03-Oct-2007", "31-Oct-2007"]


def test_normalize_key(spark):
    df = spark.createDataFrame([("O'BRIEN",), ("OBRIEN County",), ("Palo\tAlto County",)], "c string")
    assert [r[0] for r in df.select(clean.normalize_key("c")).collect()] == ["OBRIEN", "OBRIEN", "PaloAlto"]


def test_strip_double_quotes(spark):
    df = spark.createDataFrame([('"72"',)], "s string")
    assert df.select(clean.strip_chars("s")).first()[0] == "72"


def test_csv_quoted_comma_is_one_field(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "i.csv"), 'a,b,"Polk, IA",x,y,12.5\n')
    df = read_csv(spark, p, header=False,
                  schema="c0 string, c1 string, county string, t1 string, t2 string, sales double")
    r = df.first()
    assert r.county == "Polk, IA" and r.sales == 12.5


def test_tsv_key_value(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "part-r-00000"), "Polk\t3\t4\nStory\t1\t0\n")
    df = read_csv(spark, tmp_dir, header=False, sep="\t", schema="k string, a int, b int")
    assert sorted(tuple(r) for r in df.collect()) == [("Polk", 3, 4), ("Story", 1, 0)]


def test_multiline_json_records(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "c.json"), """[
      {"id": "1", "county": "OBRIEN County", "population": "1,234 "},
      {"county": "NoId County", "population": "5"},
      {"id": "3", "county": "Polk County",
       "population": "9"}
    ]""")
    df = read_json_records(spark, p, "id string, county string, population string", member="id")
    assert sorted(r.county for r in df.collect()) == ["OBRIEN County", "Polk County"]


def test_documents_with_file_name(spark, tmp_dir):
    a = write(os.path.join(tmp_dir, "a.txt"), "one two\nthree\n")
    b = write(os.path.join(tmp_dir, "b.txt"), "four\n")
    df = read_documents(spark, [a, b])
    got = {r.doc: r.text for r in df.collect()}
    assert got == {"a.txt": "one two\nthree\n", "b.txt": "four\n"}


def test_documents_are_told_apart_by_path(spark, tmp_path):
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.txt").write_text("one two three")
    (tmp_path / "my file+1.txt").write_text("four")
    df = read_documents(spark, [str(tmp_path / "x"), str(tmp_path / "y"), str(tmp_path / "my file+1.txt")])
    got = df.collect()
    assert sorted(r.doc for r in got) == ["my file+1.txt", "same.txt", "same.txt"] and len({r.path for r in got}) == 3


def test_distance_records(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "d.txt"), "(0, [0,1,0.5])\n[1, 7, 2.25]\nnoise\n[1,2]\n")
    records, rejects = read_distance_records(spark, p, strict=False)
    assert sorted(tuple(r) for r in records.collect()) == [(0, 1, 0.5), (1, 7, 2.25)]
    assert sorted(r.line for r in rejects.collect()) == ["[1,2]", "noise"]
    with pytest.raises(Exception, match="not a distance record"):
        read_distance_records(spark, p).collect()


def test_json_field(spark):
    df = spark.createDataFrame([('{"k": 69}',), ('{"j": 1}',), ("broken",)], "p string")
    assert [r[0] for r in df.select(json_field("p", "$.k", "int")).collect()] == [69, None, None]


def test_sinks_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = os.path.join(tmp_dir, "out")
    write_table(df, out, format="tsv")
    back = read_csv(spark, out, header=False, sep="\t", schema="k string, v int")
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1), ("b", 2)]
    with pytest.raises(Exception):
        write_table(df, out, format="tsv")  # refuses to overwrite
    write_table(df, os.path.join(tmp_dir, "txt"), format="text")
    lines = sorted(r.value for r in spark.read.text(os.path.join(tmp_dir, "txt")).collect())
    assert lines == ["a\t1", "b\t2"]
    write_table(df, os.path.join(tmp_dir, "pq"))
    assert spark.read.parquet(os.path.join(tmp_dir, "pq")).count() == 2


def test_lenient_date(spark):
    df = spark.createDataFrame([("3-Oct-2007",), ("garbage",)], "s string")
    assert [r[0] for r in df.select(clean.to_date("s")).collect()] == [dt.date(2007, 10, 3), None]
    assert df.select(F.lit(1)).count() == 2


def test_json_bad_record_skipped_or_kept(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "lines.json"),
              '{"id": "1", "county": "A County", "population": "5"}\n{"id": 2, broken\n'
              '{"county": "NoId", "population": "7"}\n')
    schema = "id string, county string, population string"
    good = read_json_records(spark, p, schema, member="id", multi_line=False)
    assert [r.county for r in good.collect()] == ["A County"]
    raw = read_json_records(spark, p, schema, multi_line=False, corrupt_column="_bad")
    bad = [r._bad for r in raw.collect() if r._bad is not None]
    assert bad == ['{"id": 2, broken']


def test_csv_corrupt_rows(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "s.csv"), "gender,math\nfemale,72\nmale,abc\n")
    df = read_csv(spark, p, schema="gender string, math int", corrupt_column="_bad")
    rows = {r.gender: (r.math, r._bad) for r in df.collect()}
    assert rows == {"female": (72, None), "male": (None, "male,abc")}
    with pytest.raises(Exception):
        read_csv(spark, p, schema="gender string, math int", mode="FAILFAST").collect()


def test_fields_by_position_from_either_end(spark, tmp_dir):
    from quarry.sources import field, read_fields

    p = write(os.path.join(tmp_dir, "invoices.txt"), "1,x,Polk,a,Spiced Rum,750ml,12.5\n2,y,Story,Vodka,1L,3\n")
    df = read_fields(spark, p)
    out = df.select(field("fields", 2).alias("county"), field("fields", -3).alias("t"),
                    field("fields", -1).cast("double").alias("sales"), field("fields", 40).alias("none"))
    assert [tuple(r) for r in out.collect()] == [("Polk", "Spiced Rum", 12.5, None), ("Story", "Vodka", 3.0, None)]


def test_to_double_strict_and_lenient(spark):
    df = spark.createDataFrame([(" 4.99",), ("n/a",)], "s string")
    assert [r[0] for r in df.select(clean.to_double("s")).collect()] == [4.99, None]
    with pytest.raises(PySparkException):
        df.select(clean.to_double("s", strict=True)).collect()
