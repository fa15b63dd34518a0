"""Connected components by alternating stars: joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import forget, saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("of"), F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least.withColumnRenamed("a", "of"), F.col("a") == F.col("of")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    return others.union(least.select("a", F.col("least").alias("b"))).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges (a, b); component is the least id reached.

    Each round hangs all neighbours of an id on the least of them; the rounds
    grow with the logarithm of the longest path. Minima are taken in partial
    aggregates, and the joins' hot side is rows of edges, which skew handling
    can split. Every round is written to the scratch folder, and the round before
    removed: what follows starts from the files written last. Nulls, loops and
    repeated edges are ignored; no edges give no rows.
    """
    current = saved(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        starred = _small_star(_large_star(current).distinct())
        current, earlier = saved(starred.distinct(), "edges"), current
        forget(earlier)
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
