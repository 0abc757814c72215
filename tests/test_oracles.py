"""Every query against its SQL over the same tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans.oracles import ORACLES
from tidemark.plans.registry import QUERIES

# Python in the data path, or joins without keys
SLOW = r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoopJoin"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(canonical(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    assert not re.search(SLOW, result._jdf.queryExecution().executedPlan().toString())
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    cursor = duck.execute(ORACLES[name])
    expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1])
    different = [(a, b) for a, b in zip(got[1], expected[1]) if a != b]
    assert not different, different[:5]
    assert expected[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    assert not re.search(SLOW, result._jdf.queryExecution().executedPlan().toString())
    assert result.count() > 0


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
