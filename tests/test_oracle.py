"""Every query against its SQL, over the same tables."""

import glob
import os

import duckdb
import pytest
from conftest import SF_DIR

from __spark_entry__ import entry
from rivulet.plans.catalog import QUERIES
from rivulet.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(ORACLE[name])
    assert sorted(result.columns) == sorted(relation.columns)
    expected = _canonical(relation.fetchall(), relation.columns)
    assert _canonical([tuple(r) for r in result.collect()], result.columns) == expected
    assert expected
    plan = result._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
