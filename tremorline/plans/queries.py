"""One query per operator over the given tables.

Queries that exercise a source, a sink or the stream write under the scratch
folder first and give what is read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.functions import (
    date_text,
    hour_text,
    latitude,
    long_to_boolean,
    longitude,
    month_text,
    null_to_zero,
    utc_date,
    utc_wall_clock,
    with_state_and_city,
    year_text,
)
from tremorline.operators.audit import done_windows, ingest_audit, publications
from tremorline.operators.documents import (
    decode_documents,
    document_counts,
    explode_features,
    rejects,
)
from tremorline.operators.normalize import normalize_features
from tremorline.operators.serving import (
    lookup_day_averages,
    lookup_hour_counts,
    lookup_raw_month,
)
from tremorline.operators.upsert import latest_by_key, merge_view
from tremorline.operators.views import (
    DAY_AVERAGE_SQL,
    HOUR_COUNT_SQL,
    avg_magnitude_by_day,
    count_by_hour,
    filter_state,
    register_raw,
    run_sql,
)
from tremorline.operators.windows import pending_windows, plan_windows
from tremorline.plans import feed, jobs
from tremorline.schemas import (
    DAY_AVERAGE_KEY,
    DAY_AVERAGE_SCHEMA,
    FEATURE_LEAVES,
    HOUR_COUNT_KEY,
    HOUR_COUNT_SCHEMA,
    RAW_COLUMNS,
    TALLY_SCHEMA,
)
from tremorline.session import scratch_path
from tremorline.sources.landing import (
    land,
    land_text,
    read_landing_text,
    stream_landing,
)
from tremorline.sources.months import months_in
from tremorline.sources.tables import (
    append_raw,
    compact_base,
    compact_raw,
    read_raw,
    read_view,
    scan_base,
    scan_raw,
)
from tremorline.sources.topic import RECORD_SCHEMA, documents_from_records, to_messages
from tremorline.streaming.ingest import run_available

Query = Callable[[SparkSession, str], DataFrame]

# Decimals at which averages are summed exactly, so that two engines agree.
AVERAGE_DECIMALS = 4

# The place and month that the lookups ask for.
LOOKUP_STATE, LOOKUP_CITY = "NATION_2", "click"
LOOKUP_YEAR, LOOKUP_MONTH = "2024", "01"
# Months that are published again, and a range of times (UTC milliseconds) in the first.
AGAIN_MONTH, LATE_MONTH = "03", "02"
LOOKUP_SINCE, LOOKUP_UNTIL = 1_709_596_800_000, 1_710_000_000_000


def _zoneless(raw: DataFrame) -> DataFrame:
    """Raw columns with the timestamp as UTC wall clock, comparable anywhere."""
    timestamp = f"{utc_wall_clock('unix_timestamp')} AS timestamp"
    return raw.selectExpr(*[timestamp if name == "timestamp" else name for name in RAW_COLUMNS])


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_features(feed.features(spark, sf_dir))


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(_raw(spark, sf_dir))


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.documents(feed.features(spark, sf_dir))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.damage_weekends(_landing(spark, sf_dir))


def _ids() -> Column:
    return F.expr("array_join(transform(features, f -> get_json_object(f, '$.id')), ',')").alias("ids")


# Sources and sinks


def landing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "landing-text")
    land_text(_landing(spark, sf_dir), folder)
    return decode_documents(read_landing_text(spark, folder)).select("doc_seq", "count", _ids())


def publish_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "messages")
    window = F.col("window_start").cast("string")
    to_messages(_landing(spark, sf_dir), window).write.parquet(folder)
    messages = spark.read.schema("key STRING, value STRING").parquet(folder)
    return decode_documents(messages).select("key", "count", _ids())


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "stream")
    land(_landing(spark, sf_dir), f"{folder}/landing")
    run_available(
        stream_landing(spark, f"{folder}/landing"),
        raw_log=f"{folder}/raw",
        tally_log=f"{folder}/tally",
        checkpoint=f"{folder}/checkpoint",
    )
    return _zoneless(scan_raw(spark, f"{folder}/raw"))


def scan_raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "scan")
    raw = _raw(spark, sf_dir)
    append_raw(raw, f"{folder}/first")
    base = compact_raw(spark, f"{folder}/first", f"{folder}/base")
    append_raw(feed.republished_weekends(raw), f"{folder}/log")
    return _zoneless(scan_raw(spark, f"{folder}/log", base))


def upsert_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_path(spark, "upsert")
    raw = _raw(spark, sf_dir)
    append_raw(raw, log)
    append_raw(raw, log)  # a replay
    return _zoneless(latest_by_key(read_raw(spark, log)))


def merge_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    before, after = count_by_hour(raw), count_by_hour(latest_by_key(raw))
    return merge_view(before, after, HOUR_COUNT_KEY, "count")


def merge_day_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    before = avg_magnitude_by_day(raw, AVERAGE_DECIMALS)
    after = avg_magnitude_by_day(latest_by_key(raw), AVERAGE_DECIMALS)
    return merge_view(before, after, DAY_AVERAGE_KEY, "average")


def _bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return spark.read.parquet(f"{sf_dir}/events.parquet").agg(
        F.min(day).alias("start"), F.max(day).alias("stop")
    )


def plan_windows_over_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_windows(_bounds(spark, sf_dir))


def pending_windows_after_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = publications(_landing(spark, sf_dir))
    tallies = document_counts(decode_documents(_damaged(spark, sf_dir)))
    return pending_windows(plan_windows(_bounds(spark, sf_dir)), done_windows(published, tallies))


# Documents


def decode_landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_documents(_damaged(spark, sf_dir)).select(
        "doc_seq", "count", "is_corrupt", F.coalesce(_ids(), F.lit("")).alias("ids")
    )


def document_counts_of_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = document_counts(decode_documents(_damaged(spark, sf_dir)))
    return counted.select("doc_seq", "count", "feature_rows", "rejected", "is_corrupt")


def rejects_of_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = feed.with_bad_entries(_landing(spark, sf_dir))
    return rejects(decode_documents(landed)).withColumn("position", F.col("position").cast("bigint"))


def explode_landed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = explode_features(decode_documents(_landing(spark, sf_dir))).select(*FEATURE_LEAVES)
    # As text: lists and nullable integers have no common form in clients.
    return leaves.withColumns(
        {
            "coordinates": F.array_join(F.col("coordinates").cast("array<string>"), " "),
            "sig": F.col("sig").cast("string"),
        }
    )


def normalize_landed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_documents(_landing(spark, sf_dir))
    return _zoneless(normalize_features(explode_features(decoded)))


# Column rules


def parse_place_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_state_and_city(feed.features(spark, sf_dir).select("id", "place"))


def lon_lat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.features(spark, sf_dir).selectExpr(
        "id",
        f"{longitude('coordinates')} AS longitude",
        f"{latitude('coordinates')} AS latitude",
    )


def long_to_boolean_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.features(spark, sf_dir).selectExpr(
        "id", f"{long_to_boolean('tsunami')} AS tsunami"
    )


def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = feed.features(spark, sf_dir).selectExpr("id", "time", f"{utc_date('time')} AS day")
    return timed.selectExpr(
        "id",
        f"{year_text('day')} AS year",
        f"{month_text('day')} AS month",
        f"{date_text('day')} AS date",
        f"{hour_text('time')} AS hour",
        f"{utc_wall_clock('time')} AS timestamp",
        "time AS unix_timestamp",
    )


def null_to_zero_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.features(spark, sf_dir).selectExpr(
        "id", f"{null_to_zero('mag')} AS magnitude", f"{null_to_zero('sig')} AS significant_level"
    )


# Views


def count_by_hour_of_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_hour(_current(spark, sf_dir))


def avg_magnitude_by_day_of_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avg_magnitude_by_day(_current(spark, sf_dir), AVERAGE_DECIMALS)


def filter_state_then_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_hour(filter_state(_current(spark, sf_dir), LOOKUP_STATE))


def sql_count_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_raw(_current(spark, sf_dir))
    return run_sql(spark, HOUR_COUNT_SQL)


def sql_avg_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_raw(_current(spark, sf_dir))
    # Engines add doubles in different orders: six decimals, moved off the ties.
    return run_sql(spark, DAY_AVERAGE_SQL).withColumn(
        "average", F.round(F.col("average") + 1e-9, 6)
    )


def ingest_audit_after_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = _landing(spark, sf_dir)
    received = feed.damage_weekends(sent)
    return ingest_audit(publications(sent), document_counts(decode_documents(received)))


def topic_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through a topic to the audit: Saturdays damaged, Sundays lost on
    the way, Mondays not noted by the publisher."""
    folder = scratch_path(spark, "topic")
    sent = _landing(spark, sf_dir)
    day = F.dayofweek("window_start")
    received = feed.damage_weekends(sent).where(day != 1)
    feed.as_records(to_messages(received)).write.parquet(f"{folder}/topic")
    records = spark.readStream.schema(RECORD_SCHEMA).parquet(f"{folder}/topic")
    run_available(
        documents_from_records(records),
        raw_log=f"{folder}/raw",
        tally_log=f"{folder}/tally",
        checkpoint=f"{folder}/checkpoint",
    )
    tallies = spark.read.schema(TALLY_SCHEMA).parquet(f"{folder}/tally")
    return ingest_audit(publications(sent.where(day != 2)), tallies)


# Serving


def lookup_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = scratch_path(spark, "lookup-raw")
    append_raw(_raw(spark, sf_dir), log)
    return _zoneless(lookup_raw_month(scan_raw(spark, log), LOOKUP_YEAR, LOOKUP_MONTH))


def lookup_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "lookup-hours")
    append_raw(_raw(spark, sf_dir), f"{folder}/raw")
    jobs.refresh_hour_counts(spark, f"{folder}/view", log=f"{folder}/raw")
    view = read_view(spark, f"{folder}/view", HOUR_COUNT_SCHEMA)
    return lookup_hour_counts(view, LOOKUP_STATE, LOOKUP_CITY)


def lookup_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "lookup-days")
    append_raw(_raw(spark, sf_dir), f"{folder}/raw")
    jobs.refresh_day_averages(
        spark, f"{folder}/view", log=f"{folder}/raw", decimals=AVERAGE_DECIMALS
    )
    view = read_view(spark, f"{folder}/view", DAY_AVERAGE_SCHEMA)
    return lookup_day_averages(view, LOOKUP_STATE, LOOKUP_CITY)


# By month


def _months_base(spark: SparkSession, sf_dir: str, folder: str) -> tuple[str, str]:
    """A base of several months after two compactions, the second of one month's
    rows published again, and a log of another month's."""
    raw = normalize_features(feed.spread_over_months(feed.features(spark, sf_dir)))
    base, log = f"{folder}/base", f"{folder}/log"
    append_raw(raw, f"{folder}/first")
    compact_base(spark, base, f"{folder}/first")
    append_raw(feed.republished(raw.where(F.col("month") == AGAIN_MONTH)), f"{folder}/second")
    compact_base(spark, base, f"{folder}/second")
    append_raw(feed.republished(raw.where(F.col("month") == LATE_MONTH)), log)
    return base, log


def scan_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, log = _months_base(spark, sf_dir, scratch_path(spark, "months"))
    return _zoneless(scan_base(spark, base, log))


def refresh_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both views by month, as of the base; then the log's month alone again."""
    folder = scratch_path(spark, "month-views")
    base, log = _months_base(spark, sf_dir, folder)
    hours, days = f"{folder}/hours", f"{folder}/days"
    refresh_first = {"base": base}
    jobs.refresh_hour_months(spark, hours, **refresh_first)
    jobs.refresh_day_months(spark, days, **refresh_first, decimals=AVERAGE_DECIMALS)
    late = months_in(spark, log)
    jobs.refresh_hour_months(spark, hours, base, log, late)
    jobs.refresh_day_months(spark, days, base, log, late, decimals=AVERAGE_DECIMALS)
    counts = jobs.read_hour_months(spark, hours).groupBy("state", "city", "date").agg(F.sum("count").alias("events"))
    averages = jobs.read_day_months(spark, days, decimals=AVERAGE_DECIMALS)
    return counts.join(averages, ["state", "city", "date"])


def lookup_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "lookup-range")
    base, _ = _months_base(spark, sf_dir, folder)
    return _zoneless(
        lookup_raw_month(scan_base(spark, base), LOOKUP_YEAR, AGAIN_MONTH, LOOKUP_SINCE, LOOKUP_UNTIL)
    )


# End to end


def hour_counts_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: documents, decoded, exploded, normalised, upserted, counted."""
    features = explode_features(decode_documents(_landing(spark, sf_dir)))
    return count_by_hour(latest_by_key(normalize_features(features)))


QUERIES: dict[str, Query] = {
    "landing_documents": landing_documents,
    "publish_documents": publish_documents,
    "stream_ingest": stream_ingest,
    "scan_raw": scan_raw_table,
    "upsert_raw": upsert_raw,
    "merge_hour_counts": merge_hour_counts,
    "merge_day_averages": merge_day_averages,
    "plan_windows": plan_windows_over_events,
    "pending_windows": pending_windows_after_damage,
    "decode_documents": decode_landed_documents,
    "document_counts": document_counts_of_landing,
    "rejects": rejects_of_landing,
    "explode_features": explode_landed_features,
    "normalize_features": normalize_landed_features,
    "parse_place": parse_place_column,
    "lon_lat": lon_lat,
    "long_to_boolean": long_to_boolean_column,
    "time_parts": time_parts,
    "null_to_zero": null_to_zero_columns,
    "count_by_hour": count_by_hour_of_current,
    "avg_magnitude_by_day": avg_magnitude_by_day_of_current,
    "filter_state": filter_state_then_count,
    "sql_count_by_hour": sql_count_by_hour,
    "sql_avg_by_day": sql_avg_by_day,
    "ingest_audit": ingest_audit_after_damage,
    "topic_audit": topic_audit,
    "lookup_raw_month": lookup_raw,
    "lookup_hour_counts": lookup_hours,
    "lookup_day_averages": lookup_days,
    "scan_months": scan_months,
    "refresh_months": refresh_months,
    "lookup_raw_range": lookup_range,
    "hour_counts_from_documents": hour_counts_from_documents,
}
