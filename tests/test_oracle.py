"""Every catalogued query against its DuckDB oracle on the smallest tables."""

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as E
from covisit_spark.plans import catalog, oracle

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, catalog.queries()[name], oracle.oracle_sql().get(name), con)
    assert r["status"] in ("ok", "rows-only"), r


def test_every_query_but_learned_scores_has_oracle():
    learned = {"ranker_scores", "ranker_sweep", "feature_importance", "ranker_lambdarank"}
    assert set(catalog.queries()) - set(oracle.oracle_sql()) == learned


def test_entry_registers_the_catalogue():
    assert set(catalog.queries()) <= set(E.queries())
    assert {k: v for k, v in E.oracle_sql().items() if k in oracle.oracle_sql()} == oracle.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"session", "type", "aid", "rank"}
    assert df.count() > 0
