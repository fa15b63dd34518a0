"""Which windows to fetch, and which of them still are to be fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Where the feed begins (UTC), the length of a window, and how
# far its announced end lies before the start of the next.
FEED_START = "2010-04-01 00:00:00"
WINDOW_LENGTH = "INTERVAL '1' DAY"
WINDOW_GAP = "INTERVAL '1' SECOND"


def plan_windows(bounds: DataFrame) -> DataFrame:
    """Contiguous windows covering each (start, stop) row of bounds.

    Bounds and windows are zone-less UTC wall clock. The texts are what the feed
    is asked with; events belong to [window_start, next_start), so the last
    second of a window is not lost. A plan has one row per day.
    """
    length, gap = F.expr(WINDOW_LENGTH), F.expr(WINDOW_GAP)
    starts = bounds.select(
        F.explode(
            F.sequence(
                F.col("start").cast("timestamp_ntz"), F.col("stop").cast("timestamp_ntz"), length
            )
        ).alias("window_start")
    )
    start = F.col("window_start")
    # Whole seconds print as yyyy-MM-dd HH:mm:ss.
    return starts.select(
        start,
        (start + length - gap).alias("window_end"),
        (start + length).alias("next_start"),
        start.cast("string").alias("start_text"),
        (start + length - gap).cast("string").alias("end_text"),
    )


def pending_windows(plan: DataFrame, done: DataFrame) -> DataFrame:
    """Windows of the plan that are not done; see done_windows."""
    return plan.join(done.select("window_start"), "window_start", "left_anti")
