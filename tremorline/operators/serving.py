"""Keyed lookups, newest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _between(column: str, since: object | None, until: object | None) -> Column:
    """Closed range on either side; an open side does not restrict."""
    condition = F.lit(True)
    if since is not None:
        condition = condition & (F.col(column) >= F.lit(since))
    if until is not None:
        condition = condition & (F.col(column) <= F.lit(until))
    return condition


def lookup_raw_month(
    current: DataFrame,
    year: str,
    month: str,
    since_millis: int | None = None,
    until_millis: int | None = None,
) -> DataFrame:
    """Events of one month. year and month are partition columns and part of the
    upsert key, so both reach the scan even through latest_by_key.

    A range is asked twice: timestamp is part of the key and passes latest_by_key;
    unix_timestamp, the same time as a number, has statistics in the files, by
    which a base skips what lies outside.
    """
    in_month = (F.col("year") == year) & (F.col("month") == month)
    since, until = (
        None if millis is None else F.timestamp_millis(F.lit(millis).cast("bigint"))
        for millis in (since_millis, until_millis)
    )
    in_range = _between("timestamp", since, until) & _between("unix_timestamp", since_millis, until_millis)
    wanted = current.where(in_month & in_range)
    return wanted.orderBy(F.desc("timestamp"))


def lookup_hour_counts(
    hour_counts: DataFrame,
    state: str,
    city: str,
    since: tuple[str, str] | None = None,
    until: tuple[str, str] | None = None,
) -> DataFrame:
    """Hour counts of one place; since and until are (date, hour), inclusive.

    Both texts are zero-padded, so text order is time order.
    """
    wanted = hour_counts.where((F.col("state") == state) & (F.col("city") == city))
    moment = F.struct("date", "hour")
    if since is not None:
        wanted = wanted.where(F.col("date") >= since[0])
        wanted = wanted.where(moment >= F.struct(*[F.lit(part) for part in since]))
    if until is not None:
        wanted = wanted.where(F.col("date") <= until[0])
        wanted = wanted.where(moment <= F.struct(*[F.lit(part) for part in until]))
    return wanted.orderBy(F.desc("date"), F.desc("hour"))


def lookup_day_averages(
    day_averages: DataFrame,
    state: str,
    city: str,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Day averages of one place; since and until are dates, inclusive."""
    wanted = day_averages.where((F.col("state") == state) & (F.col("city") == city))
    return wanted.where(_between("date", since, until)).orderBy(F.desc("date"))
