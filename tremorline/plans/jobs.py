"""Batch refresh of the two serving views, whole or by month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.operators.upsert import merge_view
from tremorline.operators.views import (
    avg_magnitude_by_day,
    average_of_sums,
    count_by_hour,
    magnitude_sums_by_day,
)
from tremorline.schemas import (
    DAY_AVERAGE_KEY,
    DAY_AVERAGE_NEWEST_FIRST,
    DAY_AVERAGE_SCHEMA,
    DAY_STATE_SCHEMA,
    HOUR_COUNT_KEY,
    HOUR_COUNT_NEWEST_FIRST,
    HOUR_COUNT_SCHEMA,
    HOUR_STATE_SCHEMA,
    RAW_PARTITIONS,
)
from tremorline.sources.months import Snapshot, read_months, replace_months, snapshot
from tremorline.sources.tables import read_view, scan_base, scan_raw, write_view

_PLACE = ["state", "city"]


def _rows_to_aggregate(
    spark: SparkSession, log: str | None, base: Sequence[str], months: Sequence[str] | None
) -> DataFrame:
    current = scan_raw(spark, log, base)
    if months is None:
        return current
    return current.where(F.concat_ws("-", *RAW_PARTITIONS).isin(list(months)))


def _merged(old, fresh, keys, value, mode, months):
    """The new version; with months, "replace" replaces these months only."""
    if months is None:
        return merge_view(old, fresh, keys, value, mode)
    if old is None:
        raise ValueError("a refresh of some months needs the previous version")
    if mode != "replace":
        return merge_view(old, fresh, keys, value, mode)
    month = F.concat_ws("-", F.substring("date", 1, 4), F.substring("date", 6, 2))
    others = old.where(~F.coalesce(month.isin(list(months)), F.lit(False)))
    columns = [*keys, value]
    return others.select(columns).unionByName(fresh.select(columns))


def refresh_hour_counts(
    spark: SparkSession,
    target: str,
    log: str | None = None,
    base: Sequence[str] = (),
    previous: str | None = None,
    mode: str = "merge",
    months: Sequence[str] | None = None,
) -> None:
    """Recompute hour counts and write them, merged into the previous version.

    months: only recompute these ("2024-01", ...). A group lies in one month, so
    if the others have not changed since the previous version the result is that
    of a full recompute, read from a fraction of the folders. Needs previous;
    mode "replace" then replaces these months and keeps the others.
    """
    fresh = count_by_hour(_rows_to_aggregate(spark, log, base, months))
    old = None if previous is None else read_view(spark, previous, HOUR_COUNT_SCHEMA)
    view = _merged(old, fresh, HOUR_COUNT_KEY, "count", mode, months)
    write_view(view, target, _PLACE, HOUR_COUNT_NEWEST_FIRST)


def refresh_day_averages(
    spark: SparkSession,
    target: str,
    log: str | None = None,
    base: Sequence[str] = (),
    previous: str | None = None,
    mode: str = "merge",
    months: Sequence[str] | None = None,
    decimals: int | None = None,
) -> None:
    """The same for day averages."""
    fresh = avg_magnitude_by_day(_rows_to_aggregate(spark, log, base, months), decimals)
    old = None if previous is None else read_view(spark, previous, DAY_AVERAGE_SCHEMA)
    view = _merged(old, fresh, DAY_AVERAGE_KEY, "average", mode, months)
    write_view(view, target, _PLACE, DAY_AVERAGE_NEWEST_FIRST)


def _refresh_months(spark, view, base, log, months, schema, aggregate, newest_first, vanished):
    """Recompute some months of a view and commit them; the others are neither
    read nor written."""
    if vanished not in ("drop", "keep"):
        raise ValueError(f"vanished must be 'drop' or 'keep', not {vanished!r}")
    at = snapshot(spark, view)
    fresh = aggregate(scan_base(spark, base, log, months=months))
    if vanished == "keep":
        old = read_months(spark, view, at, schema, months)
        keys = [c for c in old.columns if c not in ("count", "total", "rows")]
        fresh = fresh.unionByName(old.join(fresh.select(keys), keys, "left_anti"))
    order = [*_PLACE, *[F.desc(name) for name in newest_first]]
    return replace_months(fresh, view, at, order, months)


def refresh_hour_months(
    spark: SparkSession,
    view: str,
    base: str,
    log: str | None = None,
    months: Sequence[str] | None = None,
    vanished: str = "drop",
) -> Snapshot:
    """Bring hour counts, stored by month, up to date with a base and a log.

    months: those to recompute, as the base's snapshot names them, None for all.
    A group lies in one month, so a month is replaced as a whole. Groups that
    vanished from the recompute are dropped, or kept as they were.
    """

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*HOUR_COUNT_KEY, *RAW_PARTITIONS).agg(F.count("*").cast("int").alias("count"))

    return _refresh_months(spark, view, base, log, months, HOUR_STATE_SCHEMA, counted, HOUR_COUNT_NEWEST_FIRST, vanished)


def refresh_day_months(
    spark: SparkSession,
    view: str,
    base: str,
    log: str | None = None,
    months: Sequence[str] | None = None,
    vanished: str = "drop",
    decimals: int | None = None,
) -> Snapshot:
    """The same for day averages, which are stored as sums and counts."""
    schema = DAY_STATE_SCHEMA.format(total="DOUBLE" if decimals is None else f"DECIMAL(28,{decimals})")

    def summed(rows: DataFrame) -> DataFrame:
        return magnitude_sums_by_day(rows, decimals)

    return _refresh_months(spark, view, base, log, months, schema, summed, DAY_AVERAGE_NEWEST_FIRST, vanished)


def read_hour_months(spark: SparkSession, view: str, months: Sequence[str] | None = None) -> DataFrame:
    """Hour counts as count_by_hour gives them."""
    rows = read_months(spark, view, snapshot(spark, view), HOUR_STATE_SCHEMA, months)
    return rows.select(*HOUR_COUNT_KEY, "count")


def read_day_months(
    spark: SparkSession, view: str, months: Sequence[str] | None = None, decimals: int | None = None
) -> DataFrame:
    """Day averages as avg_magnitude_by_day gives them; decimals as in the refresh."""
    schema = DAY_STATE_SCHEMA.format(total="DOUBLE" if decimals is None else f"DECIMAL(28,{decimals})")
    return average_of_sums(read_months(spark, view, snapshot(spark, view), schema, months))
