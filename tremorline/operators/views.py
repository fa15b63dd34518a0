"""The two aggregates over current raw rows, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.schemas import DAY_AVERAGE_KEY, HOUR_COUNT_KEY, RAW_PARTITIONS

# The name under which SQL text finds the current raw rows, and
# the two statements that are run against it.
RAW_VIEW = "raw_data"
HOUR_COUNT_SQL = """
    SELECT state, city, date, hour, count(*) AS count
    FROM raw_data
    GROUP BY state, city, date, hour
"""
DAY_AVERAGE_SQL = """
    SELECT state, city, date, avg(magnitude) AS average
    FROM raw_data
    GROUP BY state, city, date
"""


def filter_state(current: DataFrame, state: str) -> DataFrame:
    """Rows of one state."""
    return current.where(F.col("state") == state)


def count_by_hour(current: DataFrame) -> DataFrame:
    """Events per place and UTC hour. Unparsed places are a group like any other.

    The narrowing is safe with the default key: an hour has 3.6 million
    distinct milliseconds, hence at most as many current rows.
    """
    return current.groupBy(*HOUR_COUNT_KEY).agg(F.count("*").cast("int").alias("count"))


def avg_magnitude_by_day(current: DataFrame, decimals: int | None = None) -> DataFrame:
    """Mean magnitude per place and UTC day; missing magnitudes are there as 0.

    decimals: sum exactly at that many decimals instead of in floating point,
    so that the result does not depend on the order in which rows are added.
    """
    if decimals is None:
        mean = F.avg("magnitude")
    else:
        exact = F.sum(F.col("magnitude").cast(f"decimal(18,{decimals})"))
        mean = exact.cast("double") / F.count("*")
    return current.groupBy(*DAY_AVERAGE_KEY).agg(
        F.coalesce(mean, F.lit(0.0)).alias("average")
    )


def magnitude_sums_by_day(current: DataFrame, decimals: int | None = None) -> DataFrame:
    """Sum and number of magnitudes per place and UTC day, with year and month.

    Rows without a magnitude do not count, as in avg_magnitude_by_day; with
    decimals they count in the number, as there. Sums of parts can be added.
    """
    if decimals is None:
        total, rows = F.sum("magnitude"), F.count("magnitude")
    else:
        total, rows = F.sum(F.col("magnitude").cast(f"decimal(18,{decimals})")), F.count("*")
    return current.groupBy(*DAY_AVERAGE_KEY, *RAW_PARTITIONS).agg(total.alias("total"), rows.alias("rows"))


def average_of_sums(sums: DataFrame) -> DataFrame:
    """Averages from magnitude_sums_by_day, of parts or wholes; no magnitudes give 0."""
    added = sums.groupBy(*DAY_AVERAGE_KEY).agg(F.sum("total").cast("double").alias("total"), F.sum("rows").alias("rows"))
    return added.select(*DAY_AVERAGE_KEY, F.coalesce(F.try_divide("total", "rows"), F.lit(0.0)).alias("average"))


def register_raw(current: DataFrame, name: str = RAW_VIEW) -> None:
    """Let SQL text address the current raw rows."""
    current.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Any SQL over the registered rows; see HOUR_COUNT_SQL and DAY_AVERAGE_SQL."""
    return spark.sql(text)
