"""The raw event log, its compacted base and the serving views, as Parquet.

Tables are appended to or written anew, never overwritten in place: a path that
is being read would lose its rows before the job that reads it has run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.operators.upsert import latest_by_key
from tremorline.schemas import (
    RAW_COLUMNS,
    RAW_KEY,
    RAW_LOG_SCHEMA,
    RAW_PARTITIONS,
    SEQUENCE_COLUMNS,
)
from tremorline.sources.months import (
    Snapshot,
    months_in,
    read_months,
    replace_months,
    snapshot,
)

_LOG_COLUMNS = [*RAW_COLUMNS, *SEQUENCE_COLUMNS]


def append_raw(rows: DataFrame, path: str) -> None:
    """Append normalised rows to the log.

    No shuffle and no order of its own: each task writes the months it holds,
    and feed windows are short, so those are few. compact_raw gathers the small
    files and puts the rows in storage order.
    """
    rows.select(_LOG_COLUMNS).write.mode("append").partitionBy(*RAW_PARTITIONS).parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Every row of a log or base. The schema is given because inference would
    turn month '01' into the number 1."""
    return spark.read.schema(RAW_LOG_SCHEMA).parquet(path).select(_LOG_COLUMNS)


def _month() -> Column:
    return F.concat_ws("-", *RAW_PARTITIONS)


def months_of(rows: DataFrame) -> list[str]:
    """The months present, as "year-month". One short text per calendar month,
    whatever the number of rows, and read from file footers alone."""
    return [row[0] for row in rows.select(_month()).distinct().collect()]


def _settled(spark: SparkSession, bases: Sequence[str]) -> DataFrame:
    """The base rows: a month comes from the last folder that has it."""
    newest = read_raw(spark, bases[-1])
    if len(bases) == 1:
        return newest
    older = _settled(spark, bases[:-1])
    return older.where(~_month().isin(months_of(newest))).unionByName(newest)


def _reconcile(
    spark: SparkSession, log: str, bases: Sequence[str], keys: Sequence[str]
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of the months that the log touches, base rows of the others).

    A key lies in one month, so only months in the log can change: the others
    stay as they are in the base, unread or read without a shuffle. The
    conditions are on partition columns and prune folders. Keys without year and
    month allow no such split; then all rows are in the first part.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    landed = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    # A log to which nothing has been written yet is empty.
    recent = read_raw(spark, log) if landed else spark.createDataFrame([], RAW_LOG_SCHEMA).select(_LOG_COLUMNS)
    if not bases:
        return latest_by_key(recent, keys), None
    settled = _settled(spark, bases)
    if not set(RAW_PARTITIONS) <= set(keys):
        return latest_by_key(settled.unionByName(recent), keys), None
    touched = _month().isin(months_of(recent))
    changed = latest_by_key(settled.where(touched).unionByName(recent), keys)
    return changed, settled.where(~touched)


def scan_raw(
    spark: SparkSession,
    log: str | None = None,
    base: Sequence[str] = (),
    keys: Sequence[str] = RAW_KEY,
) -> DataFrame:
    """Current raw rows, nineteen columns, one row per key.

    base: the folders that compact_raw names; they are unique by key already.
    Alone they are a plain scan; with a log, only the months the log touches
    are reconciled.
    """
    if log is None:
        if not base:
            raise ValueError("scan_raw needs a log, a base or both")
        return _settled(spark, base).select(RAW_COLUMNS)
    changed, others = _reconcile(spark, log, base, keys)
    current = changed if others is None else others.unionByName(changed)
    return current.select(RAW_COLUMNS)


def compact_raw(
    spark: SparkSession,
    log: str,
    target: str,
    base: Sequence[str] = (),
    keys: Sequence[str] = RAW_KEY,
) -> list[str]:
    """Write the months the log touches, reconciled with the base, to a new folder.

    Gives the folders that make up the base from then on; months the log does
    not touch are not rewritten. Rows lie newest first within a month. Ranges
    over (year, month, timestamp) give files of even size however unevenly the
    months are filled, and narrow timestamp statistics inside each. The source
    sequence ends the range key, so that even one timestamp can be split where
    the caller's keys allow many rows for it.
    """
    newest_first = [*RAW_PARTITIONS, F.desc("timestamp")]
    changed, others = _reconcile(spark, log, base, keys)
    (
        changed.repartitionByRange(*newest_first, *SEQUENCE_COLUMNS)
        .sortWithinPartitions(*newest_first)
        .write.mode("errorifexists")
        .partitionBy(*RAW_PARTITIONS)
        .parquet(target)
    )
    return [target] if others is None else [*base, target]


def _log_rows(spark: SparkSession, log: str, months: Sequence[str]) -> DataFrame:
    """A log's rows, of the months that its listing names."""
    if not months:
        return spark.createDataFrame([], RAW_LOG_SCHEMA).select(_LOG_COLUMNS)
    paths = [f"{log}/{month}" for month in months]
    return spark.read.schema(RAW_LOG_SCHEMA).option("basePath", log).parquet(*paths).select(_LOG_COLUMNS)


def _with_log(
    spark: SparkSession, table: str, at: Snapshot, log: str, keys: Sequence[str]
) -> tuple[DataFrame, list[str] | None]:
    """(reconciled rows of the months that the log touches, these months).

    Keys without year and month may lie in several months: then all months count
    as touched, which is None.
    """
    touched = months_in(spark, log)
    recent = _log_rows(spark, log, touched)
    months = touched if set(RAW_PARTITIONS) <= set(keys) else None
    settled = read_months(spark, table, at, RAW_LOG_SCHEMA, months).select(_LOG_COLUMNS)
    return latest_by_key(settled.unionByName(recent), keys), months


def scan_base(
    spark: SparkSession,
    table: str,
    log: str | None = None,
    keys: Sequence[str] = RAW_KEY,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """Current raw rows of a base that compact_base keeps, and of a log beyond it.

    What lies where is known from the base's manifest and the log's listing, so
    no job is run before the action. The base is one scan over the folders of
    its live months, however many compactions made it; with a log, a second one
    over the months that the log touches, which alone are reconciled. months:
    only these, as month_path names them.
    """
    at = snapshot(spark, table)
    if months is not None:
        at = Snapshot(at.version, {m: f for m, f in at.months.items() if m in set(months)})
    if log is None:
        return read_months(spark, table, at, RAW_LOG_SCHEMA).select(RAW_COLUMNS)
    changed, touched = _with_log(spark, table, at, log, keys)
    if touched is None:
        return changed.select(RAW_COLUMNS)
    if months is not None:
        nothing = F.lit("__HIVE_DEFAULT_PARTITION__")
        named = [F.concat(F.lit(f"{c}="), F.coalesce(c, nothing)) for c in RAW_PARTITIONS]
        changed = changed.where(F.concat_ws("/", *named).isin(list(months)))
    others = read_months(spark, table, at, RAW_LOG_SCHEMA, set(at.months) - set(touched))
    return others.select(RAW_COLUMNS).unionByName(changed.select(RAW_COLUMNS))


def compact_base(spark: SparkSession, table: str, log: str, keys: Sequence[str] = RAW_KEY) -> Snapshot:
    """Fold a log into the base and commit the base's next version.

    Months that the log does not touch stay where they are. Rows lie newest
    first, by the 64-bit time, whose statistics let a range of times skip what
    lies outside, and end with the source sequence, so that even one time can be
    split. The log can go afterwards.
    """
    at = snapshot(spark, table)
    changed, touched = _with_log(spark, table, at, log, keys)
    return replace_months(changed, table, at, [F.desc("unix_timestamp"), *SEQUENCE_COLUMNS], touched)


def write_view(
    view: DataFrame, target: str, place: Sequence[str], newest_first: Sequence[str]
) -> None:
    """Write a serving view to a new folder, ordered by place, newest first.

    Ranging over the whole key splits a place that holds much of the view; a
    lookup of one place skips all row groups but its own.
    """
    order = [*place, *[F.desc(name) for name in newest_first]]
    (
        view.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("errorifexists")
        .parquet(target)
    )


def read_view(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A serving view."""
    return spark.read.schema(schema).parquet(path)
