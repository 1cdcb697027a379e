"""Every registered query against its DuckDB SQL on sf0.01, the way the
driver's correctness gate compares them (row count, column names,
order-insensitive values)."""

import pytest

import __spark_entry__ as entry
from quarry.plans import ORACLE, QUERIES
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_oracle_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF01, con)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    first = df.schema
    assert df.count() > 0 and entry.entry(spark).schema == first
    assert SF001 in entry.SMOKE_DIR


def test_column_types_match_oracle(spark, con):
    names = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
             "StringType()": "VARCHAR", "DateType()": "DATE", "BooleanType()": "BOOLEAN"}
    for name, query in QUERIES.items():
        df = query(spark, SF01)
        spark_types = {f.name: names.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
        rel = con.sql(ORACLE[name])
        duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        assert spark_types == duck_types, name
