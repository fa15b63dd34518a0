"""What the plans must and must not contain."""

import re

import pytest
from helpers import T0, document, feature, landing
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tremorline.operators.documents import decode_documents, explode_features
from tremorline.operators.normalize import normalize_features
from tremorline.operators.serving import lookup_hour_counts, lookup_raw_month
from tremorline.operators.views import avg_magnitude_by_day, count_by_hour, filter_state
from tremorline.plans.jobs import _rows_to_aggregate, refresh_hour_counts
from tremorline.plans.queries import QUERIES
from tremorline.schemas import HOUR_COUNT_SCHEMA
from tremorline.sources.landing import land, read_landing
from tremorline.sources.tables import append_raw, compact_raw, read_view, scan_raw

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    docs = landing(spark, document(feature("a"), feature("b", T0 + 40 * 86_400_000)))
    land(docs, f"{root}/landing")
    features = explode_features(decode_documents(read_landing(spark, f"{root}/landing")))
    append_raw(normalize_features(features), f"{root}/log")
    compact_raw(spark, f"{root}/log", f"{root}/base")
    refresh_hour_counts(spark, f"{root}/hours", base=[f"{root}/base"])
    return str(root)


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", before)


def _scan_columns(plan):
    """Columns read from the files; partition columns are not among them."""
    names = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    return {name.split(":")[0] for name in names.split(",")}


def _decodes(plan):
    """How often the plan decodes documents, and how often their features."""
    kinds = re.findall(r"from_json\((ArrayType\(StructType\(StructField\(metadata|StructField\(id)", plan)
    assert len(kinds) == plan.count("from_json(")
    return sum(k.startswith("Array") for k in kinds), sum(k.endswith("(id") for k in kinds)


@pytest.mark.parametrize(
    "name", [n for n in QUERIES if n not in ("stream_ingest", "landing_documents", "topic_audit")]
)
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_documents_are_decoded_once(spark, stored):
    features = explode_features(decode_documents(read_landing(spark, f"{stored}/landing")))
    plan = _plan(normalize_features(features))
    assert _decodes(plan) == (1, 1)
    assert "Exchange" not in plan


def test_documents_are_decoded_once_while_observed(spark, stored):
    observed = decode_documents(read_landing(spark, f"{stored}/landing")).observe(
        Observation("plan"), F.sum("count").alias("measures"), F.count_if("is_corrupt").alias("bad")
    )
    plan = _plan(normalize_features(explode_features(observed)))
    assert "CollectMetrics" in plan and _decodes(plan) == (1, 1)


def test_month_refresh_prunes_folders(spark, stored):
    for rows in (
        _rows_to_aggregate(spark, f"{stored}/log", (), ["2010-04"]),
        _rows_to_aggregate(spark, None, [f"{stored}/base"], ["2010-04"]),
    ):
        plan = _plan(count_by_hour(rows))
        pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
        assert "concat_ws" in pruned and "2010-04" in pruned


def test_aggregates_read_only_their_columns(spark, stored):
    key = {"timestamp", "_doc_seq", "_position"}
    hours = _plan(count_by_hour(scan_raw(spark, f"{stored}/log")))
    assert _scan_columns(hours) == key | {"state", "city", "date", "hour"}
    days = _plan(avg_magnitude_by_day(scan_raw(spark, f"{stored}/log")))
    assert _scan_columns(days) == key | {"state", "city", "date", "magnitude"}


def test_base_needs_one_shuffle_with_a_partial_step(spark, stored):
    plan = _plan(count_by_hour(scan_raw(spark, base=[f"{stored}/base"])))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan and "Window" not in plan
    assert _scan_columns(plan) == {"state", "city", "date", "hour"}


def test_upsert_cuts_each_key_down_before_the_shuffle(spark, stored):
    plan = _plan(scan_raw(spark, f"{stored}/log"))
    order = [plan.index(step) for step in ("Final", "Exchange hashpartitioning", "Partial")]
    assert order == sorted(order) and plan.count("WindowGroupLimit") == 2


def test_state_filter_reaches_the_base_scan(spark, stored):
    plan = _plan(count_by_hour(filter_state(scan_raw(spark, base=[f"{stored}/base"]), "X")))
    assert "EqualTo(state,X)" in plan


def test_month_lookup_prunes_folders_through_the_upsert(spark, stored):
    plan = _plan(lookup_raw_month(scan_raw(spark, f"{stored}/log"), "2010", "04", T0, T0 + 1))
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "2010" in pruned and "04" in pruned
    assert "GreaterThanOrEqual(timestamp" in plan


def test_base_months_the_log_does_not_touch_are_not_shuffled(spark, stored, tmp_path):
    late = landing(spark, (9, document(feature("z", T0 + 1))))
    append_raw(normalize_features(explode_features(decode_documents(late))), str(tmp_path / "r"))
    both = scan_raw(spark, str(tmp_path / "r"), [f"{stored}/base"])
    assert both.count() == 3
    settled, changed = _plan(both).split("Union", 1)[1].split(":-", 1)[1].split("\n   +- ", 1)
    assert "Exchange" not in settled and "NOT " in settled
    assert "Exchange hashpartitioning" in changed


def test_place_lookup_is_pushed_into_the_view(spark, stored):
    view = read_view(spark, f"{stored}/hours", HOUR_COUNT_SCHEMA)
    plan = _plan(lookup_hour_counts(view, "B", "A", since=("2010/04/01", "00")))
    assert "EqualTo(state,B)" in plan and "EqualTo(city,A)" in plan
    assert "GreaterThanOrEqual(date,2010/04/01)" in plan


def test_merge_sorts_nothing(spark):
    plan = _plan(QUERIES["merge_day_averages"](spark, SMALL))
    assert "SortAggregate" not in plan
