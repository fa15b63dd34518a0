"""Every query against its SQL, on the smallest tables."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract
from tremorline.plans.oracles import ORACLES
from tremorline.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("events", "customer", "nation"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def _comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value.isoformat() if isinstance(value, datetime) else repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_comparable(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    result = contract.queries()[name](spark, SMALL)
    relation = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(relation.columns)
    assert _rows(result.columns, result.collect()) == _rows(relation.columns, relation.fetchall())


@pytest.mark.parametrize("name", ["normalize_features", "plan_windows", "count_by_hour"])
def test_result_does_not_depend_on_the_session_zone(spark, duck, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        result = contract.queries()[name](spark, SMALL)
        rows = _rows(result.columns, result.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    relation = duck.sql(ORACLES[name])
    assert rows == _rows(relation.columns, relation.fetchall())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["state", "city", "date", "hour", "count"]
    assert result.count() == 970
