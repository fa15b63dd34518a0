"""Last write wins, over an append-only log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.schemas import RAW_KEY, SEQUENCE_COLUMNS


def latest_by_key(
    log: DataFrame,
    keys: Sequence[str] = RAW_KEY,
    newest_first: Sequence[str] = SEQUENCE_COLUMNS,
) -> DataFrame:
    """The row with the highest source sequence for each key.

    A row_number limited to 1 is cut down to one row per key within each task
    before the shuffle, so a key that holds a large share of the log (all events
    without a time share one) crosses the network once per task, not once per
    row. Only columns the caller goes on to use are read and sorted.
    """
    order = [F.col(name).desc() for name in newest_first]
    ranked = log.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def merge_view(
    previous: DataFrame | None,
    fresh: DataFrame,
    keys: Sequence[str],
    value: str,
    mode: str = "merge",
) -> DataFrame:
    """Upsert a recomputed view into its previous version.

    "merge": a key in both takes the fresh value, and keys that vanished from
    the recompute keep their old one. "replace": the fresh view alone. Keys are
    unique on either side, so two conditional maxima do it in one hash
    aggregation with a map-side step, without sorting.
    """
    if mode not in ("merge", "replace"):
        raise ValueError(f"mode must be 'merge' or 'replace', not {mode!r}")
    columns = [*keys, value]
    if previous is None or mode == "replace":
        return fresh.select(columns)
    kind = fresh.schema[value].dataType
    nothing = F.lit(None).cast(kind)
    both = previous.select(
        *keys, F.col(value).cast(kind).alias("_old"), nothing.alias("_new")
    ).unionByName(fresh.select(*keys, nothing.alias("_old"), F.col(value).alias("_new")))
    return both.groupBy(*keys).agg(F.coalesce(F.max("_new"), F.max("_old")).alias(value))
