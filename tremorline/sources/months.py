"""Tables stored by month, under a manifest that is replaced in one step.

A table is a folder: data/version=.../year=.../month=.../ holds rows, manifest/
one small file per version, which says in which data folder each month lies.
What a manifest names never changes. A writer puts the months it replaces in a
new data folder and then commits the next manifest; a reader sees the months of
one manifest, old or new, never a mixture. Folders that the last manifests no
longer name can be removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession

from tremorline.schemas import RAW_PARTITIONS

_NUMBER_WIDTH = 12


class Snapshot(NamedTuple):
    """One version: its number, and for each month ("year=2010/month=04") its data folder."""

    version: int
    months: dict[str, str]


class VersionTaken(RuntimeError):
    """Another writer committed the version first; read the table again and retry."""


def _file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, at = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def months_in(spark: SparkSession, folder: str) -> list[str]:
    """The months of a folder that is partitioned by year and month, from its
    listing: no job is run. A folder that is not there has none."""
    year, month = RAW_PARTITIONS
    return [
        f"{first}/{second}"
        for first in _names(spark, folder)
        if first.startswith(f"{year}=")
        for second in _names(spark, f"{folder}/{first}")
        if second.startswith(f"{month}=")
    ]


def month_path(year: str, month: str) -> str:
    """The name of a month in a snapshot."""
    return "/".join(f"{column}={value}" for column, value in zip(RAW_PARTITIONS, (year, month)))


def _versions(spark: SparkSession, table: str) -> list[int]:
    return sorted(int(n[: -len(".json")]) for n in _names(spark, f"{table}/manifest") if n.endswith(".json"))


def _manifest(table: str, version: int) -> str:
    return f"{table}/manifest/{version:0{_NUMBER_WIDTH}d}.json"


def snapshot(spark: SparkSession, table: str, version: int | None = None) -> Snapshot:
    """The last version of a table, or a given one. A table that is not there has
    version 0 and no months."""
    if version is None:
        version = max(_versions(spark, table), default=0)
    if version == 0:
        return Snapshot(0, {})
    files, at = _file_system(spark, _manifest(table, version))
    stream = files.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(version, json.loads(text)["months"])


def _commit(spark: SparkSession, table: str, new: Snapshot) -> None:
    """Write the manifest aside and move it to its place, unless that is taken."""
    target = _manifest(table, new.version)
    files, aside = _file_system(spark, f"{table}/manifest/_{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(json.dumps({"months": new.months}, sort_keys=True).encode())
    out.close()
    jvm = spark._jvm
    options = jvm.org.apache.hadoop.fs.Options
    none = spark.sparkContext._gateway.new_array(options.Rename, 1)
    none[0] = options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), none)
    except Exception as failed:
        files.delete(aside, False)
        if "FileAlreadyExists" in str(failed):
            raise VersionTaken(f"version {new.version} of {table} is there already") from None
        raise


def read_months(
    spark: SparkSession, table: str, at: Snapshot, schema: str, months: Iterable[str] | None = None
) -> DataFrame:
    """Rows of a version, of some months or all: one scan of the months' folders.

    schema: all columns, with year and month, which inference would turn into
    numbers. Months that the version does not have are left out.
    """
    wanted = at.months if months is None else {m: at.months[m] for m in months if m in at.months}
    columns = spark.createDataFrame([], schema).columns
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{table}/data/{folder}/{month}" for month, folder in sorted(wanted.items())]
    reader = spark.read.schema(f"{schema}, version STRING").option("basePath", f"{table}/data")
    return reader.parquet(*paths).select(*columns)


def replace_months(
    rows: DataFrame,
    table: str,
    at: Snapshot,
    order: Sequence[str | Column],
    months: Iterable[str] | None,
) -> Snapshot:
    """Commit the version after `at`, in which rows are all there is of some months.

    months: those that rows replace, None for all; one that has no rows is gone.
    Months that are not named stay in the folder where they are. Rows are ranged
    and sorted by year, month and `order`. Raises VersionTaken if another writer
    was faster; the rows written then belong to no version, and sweep removes
    them.
    """
    spark = rows.sparkSession
    folder = f"version={at.version + 1}-{uuid.uuid4().hex[:8]}"
    target = f"{table}/data/{folder}"
    by_month = [*RAW_PARTITIONS, *order]
    (
        rows.repartitionByRange(*by_month)
        .sortWithinPartitions(*by_month)
        .write.mode("errorifexists")
        .partitionBy(*RAW_PARTITIONS)
        .parquet(target)
    )
    replaced = set(at.months if months is None else months)
    kept = {m: f for m, f in at.months.items() if m not in replaced}
    new = Snapshot(at.version + 1, kept | {m: folder for m in months_in(spark, target)})
    _commit(spark, table, new)
    return new


def sweep(spark: SparkSession, table: str, keep: int = 1) -> list[str]:
    """Remove manifests but the last `keep`, and data folders that these do not
    name; gives the folders' names. Run it when nobody writes the table or reads
    a version older than those kept."""
    versions = _versions(spark, table)
    kept = [snapshot(spark, table, v) for v in versions[-keep:]]
    named = {folder for version in kept for folder in version.months.values()}
    gone = [f for f in _names(spark, f"{table}/data") if f.startswith("version=") and f not in named]
    for path in [_manifest(table, v) for v in versions[:-keep]] + [f"{table}/data/{f}" for f in gone]:
        files, at = _file_system(spark, path)
        files.delete(at, True)
    return gone
