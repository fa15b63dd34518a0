"""Log, base, views and lookups on disk."""

import pytest
from helpers import DAY, HOUR, T0, document, feature, landing, rows_of
from pyspark.sql import functions as F

from tremorline.operators.documents import decode_documents, explode_features
from tremorline.operators.normalize import normalize_features
from tremorline.operators.serving import (
    lookup_day_averages,
    lookup_hour_counts,
    lookup_raw_month,
)
from tremorline.operators.upsert import latest_by_key
from tremorline.operators.views import (
    DAY_AVERAGE_SQL,
    HOUR_COUNT_SQL,
    avg_magnitude_by_day,
    count_by_hour,
    filter_state,
    register_raw,
    run_sql,
)
from tremorline.plans.jobs import refresh_day_averages, refresh_hour_counts
from tremorline.schemas import (
    DAY_AVERAGE_SCHEMA,
    HOUR_COUNT_SCHEMA,
    RAW_COLUMNS,
    RAW_KEY,
)
from tremorline.sources.tables import (
    append_raw,
    compact_raw,
    months_of,
    read_raw,
    read_view,
    scan_raw,
)


def _raw(spark, *documents):
    return normalize_features(explode_features(decode_documents(landing(spark, *documents))))


FIRST = document(
    feature("a", T0, "1km N of A, X", 1.0),
    feature("b", T0, "1km N of B, X", 2.0),  # same millisecond: replaces a
    feature("c", T0 + HOUR, "B, X", None),
    feature("d", T0 + 40 * DAY, "C, Y", 4.0),
)
SECOND = document(feature("e", T0 + HOUR, "A, X", 3.0), feature("f", T0 + 2 * HOUR, "B, X", 6.0))


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def test_months_keep_their_zero(spark, folder):
    append_raw(_raw(spark, FIRST), folder("log"))
    raw = read_raw(spark, folder("log"))
    assert sorted(months_of(raw)) == ["2010-04", "2010-05"]
    compact_raw(spark, folder("log"), folder("base"))
    assert sorted(months_of(read_raw(spark, folder("base")))) == ["2010-04", "2010-05"]
    assert raw.columns[:19] == RAW_COLUMNS


def test_scan_of_log_base_and_both(spark, folder):
    first, second = _raw(spark, (1, FIRST)), _raw(spark, (2, SECOND))
    append_raw(first, folder("log"))
    assert rows_of(scan_raw(spark, folder("log")), "id") == [("b",), ("c",), ("d",)]

    bases = compact_raw(spark, folder("log"), folder("base"))
    base = scan_raw(spark, base=bases)
    assert rows_of(base) == rows_of(scan_raw(spark, folder("log")))
    assert "Exchange" not in base._jdf.queryExecution().toString()

    append_raw(second, folder("recent"))
    both = scan_raw(spark, folder("recent"), bases)
    assert rows_of(both, "id") == [("b",), ("d",), ("e",), ("f",)]

    append_raw(second, folder("log"))
    assert rows_of(both) == rows_of(scan_raw(spark, folder("log")))

    # Only the touched month is written again.
    again = compact_raw(spark, folder("recent"), folder("base2"), bases)
    assert again == [folder("base"), folder("base2")]
    assert months_of(read_raw(spark, folder("base2"))) == ["2010-04"]
    assert rows_of(scan_raw(spark, base=again)) == rows_of(both)

    append_raw(_raw(spark, (3, FIRST)), folder("third"))
    third = scan_raw(spark, folder("third"), again)
    assert rows_of(third, "id") == [("b",), ("c",), ("d",), ("f",)]
    last = compact_raw(spark, folder("third"), folder("base3"), again)
    assert rows_of(scan_raw(spark, base=last)) == rows_of(third)


def test_replayed_old_document_does_not_win_over_the_base(spark, folder):
    append_raw(_raw(spark, (5, SECOND)), folder("log"))
    bases = compact_raw(spark, folder("log"), folder("base"))
    append_raw(_raw(spark, (1, FIRST)), folder("late"))
    got = rows_of(scan_raw(spark, folder("late"), bases), "id")
    assert got == [("b",), ("d",), ("e",), ("f",)]


def test_own_keys_with_a_base(spark, folder):
    keys = [*RAW_KEY, "id"]
    append_raw(_raw(spark, FIRST), folder("log"))
    bases = compact_raw(spark, folder("log"), folder("base"), keys=keys)
    append_raw(_raw(spark, (2, FIRST)), folder("recent"))
    got = rows_of(scan_raw(spark, folder("recent"), bases, keys), "id")
    assert got == [("a",), ("b",), ("c",), ("d",)]
    # Without year and month in the key, everything is reconciled and written.
    assert rows_of(scan_raw(spark, folder("recent"), bases, ["id"]), "id") == got
    whole = compact_raw(spark, folder("recent"), folder("base2"), bases, ["id"])
    assert whole == [folder("base2")]
    assert rows_of(scan_raw(spark, base=whole), "id") == got


def test_rows_without_a_time_stay_through_compaction(spark, folder):
    gaps = landing(spark, document(feature("n", None), feature("a", T0)))
    append_raw(normalize_features(explode_features(decode_documents(gaps)), "keep"), folder("log"))
    bases = compact_raw(spark, folder("log"), folder("base"))
    append_raw(_raw(spark, (2, FIRST)), folder("recent"))
    got = rows_of(scan_raw(spark, folder("recent"), bases), "id")
    assert got == [("b",), ("c",), ("d",), ("n",)]


def test_nothing_is_overwritten(spark, folder):
    append_raw(_raw(spark, FIRST), folder("log"))
    compact_raw(spark, folder("log"), folder("base"))
    with pytest.raises(Exception, match="(?i)already exists"):
        compact_raw(spark, folder("log"), folder("base"))
    with pytest.raises(ValueError):
        scan_raw(spark)


def test_views(spark):
    current = latest_by_key(_raw(spark, (1, FIRST), (2, SECOND)))
    hours = rows_of(count_by_hour(current))
    assert hours == [
        ("X", "A", "2010/04/01", "01", 1),
        ("X", "B", "2010/04/01", "00", 1),
        ("X", "B", "2010/04/01", "02", 1),
        ("Y", "C", "2010/05/11", "00", 1),
    ]
    days = [("X", "A", "2010/04/01", 3.0), ("X", "B", "2010/04/01", 4.0), ("Y", "C", "2010/05/11", 4.0)]
    assert rows_of(avg_magnitude_by_day(current)) == days
    assert rows_of(avg_magnitude_by_day(current, 4)) == days
    assert rows_of(count_by_hour(filter_state(current, "Y"))) == hours[-1:]
    assert sum(row[-1] for row in hours) == current.count()
    register_raw(current)
    assert rows_of(run_sql(spark, HOUR_COUNT_SQL)) == hours
    assert rows_of(run_sql(spark, DAY_AVERAGE_SQL)) == days


def test_missing_magnitudes_pull_the_mean_down(spark):
    day = document(feature("a", T0, "A, X", 4.0), feature("b", T0 + 1, "A, X", None))
    assert avg_magnitude_by_day(_raw(spark, day)).first().average == 2.0


def test_all_null_magnitudes_average_to_zero(spark):
    day = document(feature("a", T0, "A, X", None))
    features = explode_features(decode_documents(landing(spark, day)))
    kept = normalize_features(features, "keep")
    assert avg_magnitude_by_day(kept).first().average == 0.0
    assert avg_magnitude_by_day(kept, 4).first().average == 0.0


def test_refresh_merges_and_can_be_limited_to_months(spark, folder):
    append_raw(_raw(spark, (1, FIRST)), folder("log"))
    refresh_hour_counts(spark, folder("h1"), log=folder("log"))
    refresh_day_averages(spark, folder("d1"), log=folder("log"))
    append_raw(_raw(spark, (2, SECOND)), folder("log"))

    def hours(name):
        return rows_of(read_view(spark, folder(name), HOUR_COUNT_SCHEMA))

    def days(name):
        return rows_of(read_view(spark, folder(name), DAY_AVERAGE_SCHEMA))

    refresh_hour_counts(spark, folder("h2"), log=folder("log"), previous=folder("h1"))
    refresh_hour_counts(
        spark, folder("h3"), log=folder("log"), previous=folder("h1"), months=["2010-04"]
    )
    refresh_hour_counts(
        spark, folder("h4"), log=folder("log"), previous=folder("h1"), mode="replace"
    )
    stale = ("X", "B", "2010/04/01", "01", 1)
    assert stale in hours("h2") and stale not in hours("h4")
    assert hours("h2") == hours("h3") == sorted([*hours("h4"), stale])

    refresh_day_averages(spark, folder("d2"), log=folder("log"), previous=folder("d1"))
    refresh_day_averages(
        spark, folder("d3"), log=folder("log"), previous=folder("d1"), months=["2010-04"]
    )
    assert days("d2") == days("d3")
    assert ("X", "B", "2010/04/01", 4.0) in days("d2")


def test_lookups(spark, folder):
    current = latest_by_key(_raw(spark, (1, FIRST), (2, SECOND)))
    april = lookup_raw_month(current, "2010", "04")
    assert [r.id for r in april.collect()] == ["f", "e", "b"]
    ranged = lookup_raw_month(current, "2010", "04", T0 + 1, T0 + HOUR)
    assert [r.id for r in ranged.collect()] == ["e"]

    hours = count_by_hour(current)
    assert [r.hour for r in lookup_hour_counts(hours, "X", "B").collect()] == ["02", "00"]
    day = "2010/04/01"
    assert [
        r.hour for r in lookup_hour_counts(hours, "X", "B", since=(day, "01")).collect()
    ] == ["02"]
    assert [
        r.hour for r in lookup_hour_counts(hours, "X", "B", until=(day, "01")).collect()
    ] == ["00"]

    averages = avg_magnitude_by_day(current)
    assert [r.average for r in lookup_day_averages(averages, "X", "B").collect()] == [4.0]
    assert lookup_day_averages(averages, "X", "B", since="2010/04/02").count() == 0
    assert lookup_day_averages(averages, "X", "B", until="2010/04/01").count() == 1


def test_storage_order_of_the_base_is_newest_first(spark, folder):
    append_raw(_raw(spark, (1, FIRST), (2, SECOND)), folder("log"))
    compact_raw(spark, folder("log"), folder("base"))
    stored = read_raw(spark, folder("base")).where(F.col("month") == "04")
    times = [r.unix_timestamp for r in stored.collect()]
    assert len(times) == 3 and times == sorted(times, reverse=True)


def test_storage_order_of_a_view_is_newest_first_per_place(spark, folder):
    append_raw(_raw(spark, (1, FIRST), (2, SECOND)), folder("log"))
    refresh_hour_counts(spark, folder("h"), log=folder("log"))
    stored = read_view(spark, folder("h"), HOUR_COUNT_SCHEMA).where("city = 'B'").collect()
    assert [r.hour for r in stored] == ["02", "00"]
