"""Published against processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.operators.documents import decode_documents


def publications(documents: DataFrame) -> DataFrame:
    """What the publisher notes of documents (window_start, doc_seq, value) that
    it sends: each one's announced count, read from the document itself."""
    return decode_documents(documents).select(
        "window_start", "doc_seq", F.col("count").alias("published_count")
    )


def ingest_audit(published: DataFrame, tallies: DataFrame) -> DataFrame:
    """Counts and running totals per window; diff is published less processed.

    published: one row per publish attempt (window_start, doc_seq,
    published_count); every attempt counts. tallies: per processed document
    (doc_seq, count); a replayed document counts once. Processed documents that
    nobody noted as published belong to the window that they carry (window_start
    in tallies), or are summed in a last row without a window.

    Documents are summed to one row per window before the running totals, the
    only step in a single task. Its rows are days of the plan: they grow with
    the calendar, not with events or documents.
    """
    carried = F.col("window_start") if "window_start" in tallies.columns else F.lit(None).cast("timestamp_ntz")
    processed = tallies.groupBy("doc_seq").agg(
        F.max("count").alias("processed_rows"), F.max(carried).alias("_carried")
    )
    # A document published twice under one number was still processed once.
    attempts = published.groupBy("window_start", "doc_seq").agg(
        F.sum("published_count").alias("published_count")
    )
    per_window = (
        attempts.join(processed, "doc_seq", "full_outer")
        .withColumn("window_start", F.coalesce("window_start", "_carried"))
        .groupBy("window_start")
        .agg(
            F.sum(F.coalesce("published_count", F.lit(0))).alias("published_count"),
            F.sum(F.coalesce("processed_rows", F.lit(0))).alias("processed_rows"),
        )
    )
    so_far = Window.orderBy(F.col("window_start").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return per_window.select(
        "window_start",
        "published_count",
        "processed_rows",
        F.sum("published_count").over(so_far).alias("published_running"),
        F.sum("processed_rows").over(so_far).alias("processed_running"),
    ).withColumn("diff", F.col("published_running") - F.col("processed_running"))


def done_windows(published: DataFrame, tallies: DataFrame) -> DataFrame:
    """Windows (window_start) of which everything that was published arrived whole.

    A document is whole if it decodes and none of its features was rejected; one
    that was lost, is corrupt or half readable leaves its window to be fetched
    again. Where published has a column attempt, only a window's last attempt
    counts, so that sending a window again can mend it. A document under a number
    that was tallied more than once is whole if one tally of it is.
    """
    if "attempt" in published.columns:
        last = published.groupBy("window_start").agg(F.max("attempt").alias("attempt"))
        published = published.join(last, ["window_start", "attempt"])
    whole = tallies.groupBy("doc_seq").agg(
        F.bool_or(F.expr("NOT is_corrupt AND rejected = 0")).alias("whole")
    )
    return (
        published.select("window_start", "doc_seq")
        .join(whole, "doc_seq", "left")
        .groupBy("window_start")
        .agg(F.bool_and(F.coalesce("whole", F.lit(False))).alias("done"))
        .where("done AND window_start IS NOT NULL")
        .select("window_start")
    )
