"""The training-data queries against their DuckDB SQL on the smallest tables; those without SQL return rows."""

import os

import pytest
from oracle_check import compare, duck

import corpus_pipeline
from covisit_spark.llm import oracle, queries
from covisit_spark.session import get_spark

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
ALL = queries.queries() | {"pipeline": corpus_pipeline.run}


@pytest.fixture(scope="module")
def spark():
    return get_spark(master="local[4]", shuffle_partitions=4)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, SF, name, ALL[name], oracle.oracle_sql().get(name), con)
    assert r["status"] in ("ok", "rows-only"), r
    assert r["rows"] > 0
