"""Mix sources to target weights by exact word budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import saved, shuffle_partitions, word_count

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def source_targets(
    totals: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """Targets from (source, source_size); one row per source, so a small table.

    Sources in order of code points, null last, weigh `weights`, repeating. All
    words are shared by weight; a target stops at most_epochs times its source,
    and what it leaves is shared again by weight among the rest. In the order in
    which sources reach their stop (stop / weight), the first that stays below
    it fixes the level for itself and all after it.
    """
    weight = F.element_at(
        F.array(*[F.lit(int(w)).cast("bigint") for w in weights]),
        ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1),
    )
    ranked = totals.withColumn("weight", weight).withColumn("stop", F.col("source_size") * most_epochs)
    order = [F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        ranked.withColumn("words", F.sum("source_size").over(everything))
        .withColumn("left", F.col("words") - F.coalesce(F.sum("stop").over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(onward))
        .withColumn("step", F.row_number().over(Window.orderBy(*order)))
    )
    free = F.col("weight") * F.col("left") <= F.col("stop") * F.col("open_weight")
    first = F.min(F.when(free, F.struct("step", "left", "open_weight"))).over(everything)
    share = (F.col("weight") * F.col("first.left")).cast("double") / F.col("first.open_weight").cast("double")
    return level.withColumn("first", first).select(
        "source",
        "source_size",
        F.when(F.col("step") < F.col("first.step"), F.col("stop").cast("double"))
        .otherwise(share)
        .alias("target"),
    )


def _key(row_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes.

    Every document gets a hash-random key. Keys are uniform, so equal ranges of
    them hold equal shares: each source is cut into about sqrt(rows) ranges,
    rows are partitioned by (source, range) and each range sorted, the sums of
    ranges give each range its offset in its source, and a running sum inside the
    range does the rest. A source with a third of all rows is many ranges. The source's
    budget, its target rounded down, is cut at the exact word: whole epochs
    first, then documents in order of their keys, the last one in part.

    Returns the rows of docs with the added columns size, source_size, target and
    taken. A null text has size 0; null is a source of its own; rows that repeat
    an id count each by itself; documents without words take 0. Added names hide
    columns of docs that have the same names. An empty table gives no rows.
    """
    spark = docs.sparkSession
    added = {
        "_id": F.col(id_column),
        "_source": F.col(source_column),
        "_size": word_count(F.col(text_column)),
        "_key": _key(F.col(id_column), seed),
    }
    rows = docs.withColumns(added)
    sizes = saved(rows.select(*added), "mix-sizes")
    ranges = max(1, int(sizes.count() ** 0.5))
    bits = F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint")
    bucket = F.shiftright(bits * ranges, 32)

    # Null is a source of its own.
    source_key = F.coalesce(F.concat(F.lit("="), F.col("_source").cast("string")), F.lit(""))
    totals = sizes.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    targets = source_targets(totals, weights, most_epochs)
    sums = sizes.groupBy(F.col("_source").alias("source"), bucket.alias("bucket")).agg(
        F.sum("_size").alias("range_size")
    )
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("_offset"),
    ).select(source_key.alias("_source_of_range"), "_range", "_offset")
    of_source = targets.select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    ).select(source_key.alias("_target_of"), "_source_size", "_target")
    offsets = offsets.join(of_source, F.col("_source_of_range") == F.col("_target_of"))
    inside = (
        Window.partitionBy("_source_key", "_bucket")
        .orderBy("_key", "_id", "_size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # A range goes to one task whole, and there meets its offset: rows move once.
    running = (
        rows.withColumns({"_bucket": bucket, "_source_key": source_key})
        .repartition(shuffle_partitions(spark), "_source_key", "_bucket")
        .withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    )
    placed = running.join(
        offsets,
        (F.col("_source_key") == F.col("_source_of_range")) & (F.col("_bucket") == F.col("_range")),
    )
    # Without words in a source there is nothing to take.
    base = F.greatest(F.col("_source_size"), F.lit(1))
    budget = F.floor("_target").cast("bigint")
    epochs = F.floor(budget / base).cast("bigint")
    rest = budget - epochs * base
    start = F.col("_offset") + F.col("_inside")
    cut = F.greatest(F.least(rest - start, F.col("_size")), F.lit(0))
    names = {"size", "source_size", "target", "taken"}
    return placed.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in names],
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (epochs * F.col("_size") + cut).alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each whole and as often as the mix takes it.

    Of a source's last document, which the budget cuts, the nearer of whole and
    nothing is used. Columns as in docs; documents without words are left out.
    """
    names = {"size", "source_size", "target", "taken"}
    clash = {c: f"_kept_{c}" for c in docs.columns if c.lower() in names}
    mixed = mix(docs.withColumnsRenamed(clash), **options)
    copies = F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    repeated = mixed.withColumn("_copies", copies).where("_copies > 0").withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))
    )
    return repeated.select(*[F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns])
