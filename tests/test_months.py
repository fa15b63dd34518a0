"""Tables by month: versions, compaction, views, and what a scan reads."""

import pytest
from helpers import DAY, HOUR, T0, document, feature, landing, rows_of
from pyspark.sql import functions as F

from tremorline.operators.documents import decode_documents, explode_features
from tremorline.operators.normalize import normalize_features
from tremorline.operators.serving import lookup_raw_month
from tremorline.operators.upsert import latest_by_key
from tremorline.operators.views import avg_magnitude_by_day, count_by_hour
from tremorline.plans.jobs import read_day_months, read_hour_months, refresh_day_months, refresh_hour_months
from tremorline.schemas import RAW_COLUMNS, RAW_KEY, RAW_LOG_SCHEMA
from tremorline.sources.months import (
    Snapshot,
    VersionTaken,
    month_path,
    months_in,
    read_months,
    replace_months,
    snapshot,
    sweep,
)
from tremorline.sources.tables import append_raw, compact_base, read_raw, scan_base

APRIL, MAY = month_path("2010", "04"), month_path("2010", "05")


def _raw(spark, *documents, null_numeric="zero"):
    return normalize_features(explode_features(decode_documents(landing(spark, *documents))), null_numeric)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _jobs(spark, action):
    """Jobs that Spark runs meanwhile."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("months", "months")
    try:
        before = set(tracker.getJobIdsForGroup("months"))
        result = action()
        return result, len(set(tracker.getJobIdsForGroup("months")) - before)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def _log(spark, path, number, *features):
    append_raw(_raw(spark, (number, document(*features))), path)
    return path


def test_many_compactions_leave_one_scan_and_no_job(spark, folder):
    base = folder("base")
    everything = []
    for n in range(20):
        # Every compaction touches May, one in five April too.
        features = [feature(f"m{n}", T0 + (40 + n % 4) * DAY, mag=float(n))]
        features += [feature(f"a{n}", T0 + n * HOUR, mag=float(n))] if n % 5 == 0 else []
        everything.append((n, document(*features)))
        log = _log(spark, folder(f"log{n}"), n, *features)
        at = compact_base(spark, base, log)
        assert at == snapshot(spark, base) and at.version == n + 1
    current, jobs = _jobs(spark, lambda: scan_base(spark, base))
    assert jobs == 0
    plan = _plan(current)
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
    assert rows_of(current) == rows_of(latest_by_key(_raw(spark, *everything)).select(RAW_COLUMNS))
    assert set(at.months) == {APRIL, MAY} and at.months[APRIL].startswith("version=16-")

    with_log, jobs = _jobs(spark, lambda: scan_base(spark, base, _log(spark, folder("late"), 99, feature("z", T0 + HOUR))))
    plan = _plan(with_log)
    assert plan.count("Scan parquet") == 3 and plan.count("Exchange hashpartitioning") == 1
    assert rows_of(with_log.where("id = 'z'"), "id") == [("z",)] and with_log.count() == current.count() + 1

    old = snapshot(spark, base, 19)
    assert old.months[MAY] != at.months[MAY]
    gone = sweep(spark, base, keep=2)
    assert len(gone) == 20 - len({*at.months.values(), *old.months.values()})
    assert rows_of(read_months(spark, base, old, RAW_LOG_SCHEMA), "id")
    assert len(sweep(spark, base)) == 1 and scan_base(spark, base).count() == current.count()
    assert snapshot(spark, base) == at


def test_a_reader_keeps_its_version(spark, folder):
    base = folder("base")
    compact_base(spark, base, _log(spark, folder("one"), 1, feature("a")))
    before = scan_base(spark, base)
    compact_base(spark, base, _log(spark, folder("two"), 2, feature("b"), feature("c", T0 + 40 * DAY)))
    assert rows_of(before, "id") == [("a",)]
    assert rows_of(scan_base(spark, base), "id") == [("b",), ("c",)]


def test_two_writers_of_one_version(spark, folder):
    base = folder("base")
    at = compact_base(spark, base, _log(spark, folder("one"), 1, feature("a")))
    rows = read_raw(spark, folder("one"))
    replace_months(rows, base, at, ["timestamp"], [APRIL])
    with pytest.raises(VersionTaken):
        replace_months(rows, base, at, ["timestamp"], [APRIL])
    assert snapshot(spark, base).version == 2
    assert len(sweep(spark, base)) == 2  # the loser's folder and the first version's


def test_replayed_old_document_and_own_keys(spark, folder):
    base = folder("base")
    compact_base(spark, base, _log(spark, folder("one"), 5, feature("new")))
    late = _log(spark, folder("late"), 1, feature("old"), feature("x", T0 + 1))
    assert rows_of(scan_base(spark, base, late), "id") == [("new",), ("x",)]
    assert rows_of(scan_base(spark, base, late, [*RAW_KEY, "id"]), "id") == [("new",), ("old",), ("x",)]
    assert rows_of(scan_base(spark, base, late, ["id"]), "id") == [("new",), ("old",), ("x",)]
    compact_base(spark, base, late, ["id"])
    assert rows_of(scan_base(spark, base), "id") == [("new",), ("old",), ("x",)]


def test_empty_tables_logs_and_rows_without_a_time(spark, folder):
    assert snapshot(spark, folder("nothing")) == Snapshot(0, {}) and months_in(spark, folder("nothing")) == []
    assert scan_base(spark, folder("nothing")).count() == 0
    assert scan_base(spark, folder("nothing"), folder("no-log")).columns == RAW_COLUMNS
    log = folder("log")
    append_raw(_raw(spark, document(feature("n", None), feature("a")), null_numeric="keep"), log)
    base = folder("base")
    compact_base(spark, base, log)
    assert len(snapshot(spark, base).months) == 2
    both = scan_base(spark, base, log)
    assert rows_of(both, "id") == [("a",), ("n",)]
    without = [m for m in snapshot(spark, base).months if m != APRIL]
    assert rows_of(scan_base(spark, base, log, months=without), "id") == [("n",)]
    assert rows_of(scan_base(spark, base, months=[APRIL, "year=1999/month=01"]), "id") == [("a",)]


def test_a_range_skips_most_of_a_month(spark, folder):
    rows = spark.range(30_000).selectExpr(
        "CAST(NULL AS STRING) AS place", "array(1.0D, 2.0D) AS coordinates", f"{T0}L + id * 60000 AS time", "1.0D AS mag",
        "'ml' AS magType", "0L AS tsunami", "'t' AS type", "CAST(NULL AS STRING) AS alert", "1L AS sig", "'n' AS net",
        "CAST(id AS STRING) AS id", "1L AS _doc_seq", "CAST(id AS INT) AS _position",
    )
    append_raw(normalize_features(rows), folder("log"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compact_base(spark, folder("base"), folder("log"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    wanted = lookup_raw_month(scan_base(spark, folder("base")), "2010", "04", T0 + 600_000, T0 + 1_200_000)
    assert [int(r.id) for r in wanted.collect()] == list(range(20, 9, -1))

    def metrics(node):
        if node.nodeName().startswith("Scan"):
            yield node.metrics().apply("numOutputRows").value()
        for k in range(node.children().size()):
            yield from metrics(node.children().apply(k))
        if hasattr(node, "executedPlan") and "AdaptiveSparkPlan" in node.nodeName():
            yield from metrics(node.executedPlan())
        if "QueryStage" in node.nodeName():
            yield from metrics(node.plan())

    assert 0 < sum(metrics(wanted._jdf.queryExecution().executedPlan())) <= 30_000 * 0.7


FIRST = [feature("a", T0, "A, X", 1.0), feature("b", T0 + HOUR, "B, X", None), feature("c", T0 + 40 * DAY, "C, Y", 4.0)]


def test_refreshing_a_month_reads_and_writes_that_month(spark, folder):
    base, hours, days = folder("base"), folder("hours"), folder("days")
    compact_base(spark, base, _log(spark, folder("one"), 1, *FIRST))
    refresh_hour_months(spark, hours, base)
    refresh_day_months(spark, days, base)
    before = snapshot(spark, hours)
    late = _log(spark, folder("late"), 2, feature("d", T0 + 1, "A, X", 2.0), feature("e", T0 + HOUR, "D, Z", 5.0))
    touched = months_in(spark, late)
    assert touched == [APRIL]
    at = refresh_hour_months(spark, hours, base, late, touched)
    refresh_day_months(spark, days, base, late, touched)
    assert at.months[MAY] == before.months[MAY] and at.months[APRIL] != before.months[APRIL]
    assert months_in(spark, f"{hours}/data/{at.months[APRIL]}") == [APRIL]

    current = scan_base(spark, base, late)
    assert rows_of(read_hour_months(spark, hours)) == rows_of(count_by_hour(current))
    assert rows_of(read_day_months(spark, days)) == rows_of(avg_magnitude_by_day(current))
    april = read_hour_months(spark, hours, [APRIL])
    assert rows_of(april) == rows_of(count_by_hour(current.where("month = '04'")))
    scanned = scan_base(spark, base, late, months=[APRIL])
    assert all("month=04" in f for f in scanned.inputFiles())


def test_groups_that_vanish_are_dropped_or_kept(spark, folder):
    base = folder("base")
    compact_base(spark, base, _log(spark, folder("one"), 1, *FIRST))
    late = _log(spark, folder("late"), 2, feature("b2", T0 + HOUR, "New, X", 3.0))
    for vanished, cities in (("drop", ["A", "C", "New"]), ("keep", ["A", "B", "C", "New"])):
        for refresh, read in ((refresh_hour_months, read_hour_months), (refresh_day_months, read_day_months)):
            view = folder(f"{refresh.__name__}-{vanished}")
            refresh(spark, view, base)
            refresh(spark, view, base, late, [APRIL], vanished)
            assert sorted(r.city for r in read(spark, view).collect()) == cities
    with pytest.raises(ValueError):
        refresh_hour_months(spark, folder("v"), base, vanished="maybe")


def test_sums_of_parts_give_the_average_of_the_whole(spark, folder):
    base, days = folder("base"), folder("days")
    features = [feature(f"f{n}", T0 + n, "A, X", n / 8) for n in range(9)]
    compact_base(spark, base, _log(spark, folder("one"), 1, *features, feature("z", T0 + DAY, "B, X", None)))
    refresh_day_months(spark, days, base, decimals=4)
    got = rows_of(read_day_months(spark, days, decimals=4))
    assert got == rows_of(avg_magnitude_by_day(scan_base(spark, base), 4)) == [("X", "A", "2010/04/01", 0.5), ("X", "B", "2010/04/02", 0.0)]
    parts = read_months(spark, days, snapshot(spark, days), "state STRING, city STRING, date STRING, total DECIMAL(28,4), rows BIGINT, year STRING, month STRING")
    assert parts.agg(F.sum("rows")).first()[0] == 10
