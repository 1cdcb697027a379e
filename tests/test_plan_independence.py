"""Results do not depend on the physical plan Spark picks or on ANSI mode:
every registered query is compared with its oracle again with broadcasts
disabled (all sort-merge joins), AQE off, an odd number of shuffle
partitions and ANSI mode off (the default suite runs with it on)."""

import pytest

from quarry.plans import ORACLE, QUERIES
from tests.conftest import SF01
from tests.oracle_compare import compare, duck

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.shuffle.partitions": "13",
    "spark.sql.ansi.enabled": "false",
}


@pytest.fixture(scope="module")
def cluster_like(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result_with_sort_merge_joins_and_no_aqe(cluster_like, con, name):
    res = compare(cluster_like, name, QUERIES[name], ORACLE[name], SF01, con)
    assert res["status"] == "ok", res
