"""Every registered query next to its SQL oracle, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from crmtide.workload import load_queries, model_queries
from tools.check_oracle import TABLES, bag

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="supplied tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


OWN = model_queries.QUERIES | load_queries.QUERIES


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    result = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert bag(df.collect(), df.columns) == bag(result.fetchall(), names)


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert "pipeline_health_status" in df.columns and df.count() == 67
