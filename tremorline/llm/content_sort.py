"""Exact duplicates by sorting contents: equal texts end up side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import saved, shuffle_partitions

# White space that is not already one plain space: a match becomes one space.
_UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"

# Characters of a text that the range splitters see. The hash beside them parts
# texts that share a beginning, so splitters stay small and ranges even.
_HEAD = 32

# A text is hot when its copies would fill more than this part of a range.
_HOT_PART_OF_A_RANGE = 0.25


def drop_exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Mark, for every row, the row of equal text that stays.

    Texts are equal when identical after each run of white space became one
    space. Sampled splitters cut the rows into ranges by (beginning, hash), an
    external sort puts equal texts next to each other, and whole texts are
    compared. Rows whose text alone would overfill a range (at most
    ranges / 0.25 different hashes, so their list has a fixed bound) are spread
    over several ranges by a salt; one row for each salted part then meets
    the others, again by whole text.

    Returns one row per input row: doc_id, keep_id, group_size, kept,
    text_sha256. A null text counts as empty. Null ids sort last: they stay only
    if no row of the group has an id. Of rows that repeat both the text and the
    smallest id, exactly one is kept. An empty table gives no rows.
    """
    ranges = shuffle_partitions(docs.sparkSession)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.regexp_replace(F.coalesce(F.col(text_column), F.lit("")), _UNEVEN_SPACE, " ").alias("norm"),
    ).withColumn("tag", F.xxhash64("norm"))

    limit = max(1, int(docs.count() / ranges * _HOT_PART_OF_A_RANGE))
    hot = (
        rows.groupBy("tag")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > limit)
        .withColumn("salts", F.ceil(F.col("copies") / limit))
        .drop("copies")
    )
    salted = rows.join(F.broadcast(hot), "tag", "left").withColumns(
        {
            "head": F.substring("norm", 1, _HEAD),
            "salt": F.when(
                F.col("salts").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.col("salts"))
            ).otherwise(F.lit(0)),
        }
    )
    # The window needs the rows of (head, tag, salt, norm) together, which these
    # ranges grant: no further exchange, only the sort inside each range.
    keys = ["head", "tag", "salt", "norm"]
    part = Window.partitionBy(*keys)
    by_id = part.orderBy(F.col("doc_id").asc_nulls_last())
    ranged = salted.repartitionByRange(ranges, "head", "tag", "salt")
    compared = ranged.select(
        "doc_id",
        "tag",
        "salts",
        "norm",
        F.row_number().over(by_id).alias("place"),
        F.min("doc_id").over(part).alias("part_id"),
        F.count("*").over(part).alias("part_size"),
    )
    split = F.col("salts").isNotNull()
    parts = saved(
        compared.select(
            "doc_id",
            "tag",
            F.sha2(F.col("norm"), 256).alias("text_sha256"),
            "place",
            "part_id",
            "part_size",
            F.when(split & (F.col("place") == 1), F.col("norm")).alias("split_text"),
        ),
        "content-sort",
    )
    joined = (
        parts.where("split_text IS NOT NULL")
        .groupBy("tag", "text_sha256", "split_text")
        .agg(F.min("part_id").alias("whole_id"), F.sum("part_size").alias("whole_size"))
        .select("tag", "text_sha256", "whole_id", "whole_size")
    )
    whole = parts.join(F.broadcast(joined), ["tag", "text_sha256"], "left")
    in_parts = F.col("whole_size").isNotNull()
    keep_id = F.when(in_parts, F.col("whole_id")).otherwise(F.col("part_id"))
    return whole.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("whole_size", "part_size").alias("group_size"),
        ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
    )
