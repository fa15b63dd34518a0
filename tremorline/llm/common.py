"""Small helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.session import scratch_path

# What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def saved(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared scratch folder and read back.

    Cuts the lineage at files that every executor can read: a lost executor
    costs its running tasks, not the work behind them.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


# Whether Spark removes the shuffle files of a query when it ends.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is saved or counted meanwhile go as soon as that is done.

    Otherwise they stay until the driver's garbage collection finds them unused.
    Rows that are still to be computed after it keep theirs.
    """
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


# Bounds of what goes to a Python worker at once; texts vary in length a lot.
_BATCH_ROWS, _BATCH_BYTES = 2000, 8 << 20


def in_small_batches(df: DataFrame) -> DataFrame:
    """The same rows; Arrow batches of the session become no larger than the bounds.

    With the defaults, 10,000 rows or 64 MB, a task holds several such batches on
    either side of the pipe, which counts where executors are small.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > _BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH_ROWS))
    size = conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if int(re.sub(r"\D", "", size)) > _BATCH_BYTES or not size.rstrip("b").isdigit():
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{_BATCH_BYTES}b")
    return df


def forget(*tables: DataFrame) -> None:
    """Delete the files behind saved tables that nothing will read again."""
    spark = tables[0].sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    for folder in {file.rsplit("/", 1)[0] for table in tables for file in table.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


# Slots of the filter that picks rows by id: a bitmap of 8 MB, whatever the input.
_SLOTS = 1 << 26


def marked(rows: DataFrame, ids: DataFrame, column: str, mark: str = "_marked") -> DataFrame:
    """Rows with a mark: false only if their id is not among ids; no shuffle of rows.

    Ids are hashed to the bits of a bitmap of fixed size, which is broadcast. The
    fuller it is, the more other rows are marked too.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(_SLOTS))
    bitmaps = (
        ids.select(slot.alias("_slot"))
        .groupBy(F.bitmap_bucket_number("_slot").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bitmap"))
    )
    place = F.bitmap_bit_position("_slot")
    byte = F.substring(F.col("_bitmap"), F.floor(place / 8).cast("int") + 1, F.lit(1))
    # Most bytes are zero, which is told without a number made of them.
    bit = F.when(byte == F.lit(b"\0"), F.lit(0)).otherwise(F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")))
    return (
        rows.withColumn("_slot", slot)
        .withColumn("_bucket", F.bitmap_bucket_number("_slot"))
        .join(F.broadcast(bitmaps), "_bucket", "left")
        .withColumn(mark, F.col("_bitmap").isNotNull() & (bit == 1))
        .drop("_slot", "_bucket", "_bitmap")
    )


def rows_of_ids(rows: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """The rows whose id is among ids, and perhaps a few more; no shuffle of rows."""
    return marked(rows, ids, column).where("_marked").drop("_marked")


def without(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows whose id is not among ids (one column); rows without an id stay.

    Most rows stay where they are: only those that the filter marks meet the ids.
    """
    gone = ids.select(F.col(ids.columns[0]).cast(rows.schema[column].dataType).alias(column)).distinct()
    split = marked(rows, gone, column, "_maybe_gone")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    # No anti-join: Spark moves one below the marks, where it would shuffle all rows.
    doubted = (
        split.where("_maybe_gone")
        .join(gone.select(F.col(column).alias("_gone")), F.col(column) == F.col("_gone"), "left")
        .where("_gone IS NULL")
    )
    return split.where("NOT _maybe_gone").select(*columns).unionByName(doubted.select(*columns))
