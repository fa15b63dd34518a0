"""Last write wins, and views merged into their previous version."""

import pytest
from helpers import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tremorline.operators.upsert import latest_by_key, merge_view

LOG = "timestamp INT, year STRING, month STRING, id STRING, _doc_seq BIGINT, _position INT"


def _log(spark, rows):
    return spark.createDataFrame([(t, "2010", "04", i, d, p) for t, i, d, p in rows], LOG)


def _want(rows):
    newest = {}
    for t, i, d, p in rows:
        if t not in newest or (d, p) > newest[t][1:]:
            newest[t] = (i, d, p)
    return sorted(((t, *value) for t, value in newest.items()), key=repr)


_COLUMNS = ["timestamp", "id", "_doc_seq", "_position"]

_ROWS = st.lists(
    st.tuples(st.integers(0, 6), st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=60
).map(
    # One source position holds one event.
    lambda keys: [(t, f"{t}-{d}-{p}", d, p) for t, d, p in keys]
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(_ROWS, st.randoms(use_true_random=False))
def test_matches_brute_force_in_any_order_and_under_replay(spark, rows, random):
    shuffled = rows + rows
    random.shuffle(shuffled)
    assert rows_of(latest_by_key(_log(spark, rows)), *_COLUMNS) == _want(rows)
    assert rows_of(latest_by_key(_log(spark, shuffled)), *_COLUMNS) == _want(rows)


def test_own_keys(spark):
    log = _log(spark, [(1, "a", 1, 0), (1, "b", 1, 1), (1, "a", 2, 0)])
    got = rows_of(latest_by_key(log, ["timestamp", "year", "month", "id"]), "id", "_doc_seq")
    assert got == [("a", 2), ("b", 1)]


def test_key_that_holds_a_third_of_the_log(spark):
    log = spark.range(90_000).selectExpr(
        "CAST(IF(id % 3 = 0, 0, id) AS INT) AS timestamp",
        "'2010' AS year",
        "'04' AS month",
        "CAST(id AS STRING) AS id",
        "id AS _doc_seq",
        "0 AS _position",
    )
    latest = latest_by_key(log)
    assert latest.count() == 60_001
    assert latest.where("timestamp = 0").select("id").collect()[0][0] == "89997"


VIEW = "state STRING, count INT"


def test_merge_keeps_vanished_groups(spark):
    old = spark.createDataFrame([("A", 1), ("B", 2), (None, 9)], VIEW)
    new = spark.createDataFrame([("B", 1), ("C", 3)], VIEW)
    merged = rows_of(merge_view(old, new, ["state"], "count"))
    assert merged == [("A", 1), ("B", 1), ("C", 3), (None, 9)]
    assert rows_of(merge_view(old, new, ["state"], "count", "replace")) == [("B", 1), ("C", 3)]
    assert rows_of(merge_view(None, new, ["state"], "count")) == [("B", 1), ("C", 3)]
    assert merge_view(old, new, ["state"], "count").schema["count"].dataType.typeName() == "integer"
    with pytest.raises(ValueError):
        merge_view(old, new, ["state"], "count", "append")
