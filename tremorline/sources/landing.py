"""Landed documents: text files, one document each, or a Parquet landing table.

Text suits a feed that drops files. The table keeps many documents per file and
is the form to use when there are millions of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.schemas import LANDING_SCHEMA

SEQUENCE_WIDTH = 20

# Publish number in .../000042.json or in .../doc_seq=000042/part-0.txt
_NUMBER_IN_PATH = r"/(?:doc_seq=)?(\d+)(?:(?:\.[A-Za-z]+){1,2}$|/part-[^/]*$)"


def unnumbered(value: Column) -> Column:
    """A publish number for a document that has none, from its text.

    Below zero, so that it yields to all that have one; the same in every run,
    so that of two such documents the same one wins.
    """
    return -1 - F.xxhash64(value).bitwiseAND(F.lit(2**63 - 1))


def without_number(documents: DataFrame) -> DataFrame:
    """The documents that came without a publish number."""
    return documents.where("doc_seq < 0")


def _sequence_from_path() -> Column:
    number = F.regexp_extract(F.col("_metadata.file_path"), _NUMBER_IN_PATH, 1)
    return F.coalesce(number.try_cast("bigint"), unnumbered(F.col("value"))).alias("doc_seq")


def read_landing_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its publish number and its whole text."""
    files = spark.read.schema("value STRING").option("recursiveFileLookup", True)
    return files.text(path, wholetext=True).select(_sequence_from_path(), "value")


def stream_landing_text(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """The same files as a stream, at most max_files per micro-batch."""
    reader = spark.readStream.schema("value STRING").option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path, wholetext=True).select(_sequence_from_path(), "value")


def land_text(documents: DataFrame, path: str) -> None:
    """Write one text file per document, its publish number in the path."""
    numbered = documents.select(
        "value", F.lpad(F.col("doc_seq").cast("string"), SEQUENCE_WIDTH, "0").alias("doc_seq")
    )
    numbered.write.mode("append").partitionBy("doc_seq").text(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The landing table."""
    return spark.read.schema(LANDING_SCHEMA).parquet(path)


def stream_landing(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The landing table as a stream, at most max_files files per micro-batch."""
    reader = spark.readStream.schema(LANDING_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def land(documents: DataFrame, path: str) -> None:
    """Append documents to the landing table."""
    documents.select("doc_seq", "value").write.mode("append").parquet(path)
