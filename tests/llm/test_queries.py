"""The registered queries: SQL where it can express them, schemas of the others."""

import pytest

import __spark_entry__ as entry
from quarry.llm.queries import ORACLE, QUERIES
from tests.conftest import SF01
from tests.oracle_compare import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    res = compare(spark, name, QUERIES[name], ORACLE[name], SF01, duck(SF01))
    assert res["status"] == "ok", res


def test_entry_has_one_query_of_each_operator_and_the_pipeline():
    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(ORACLE) <= set(entry.oracle_sql())
