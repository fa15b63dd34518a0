"""URL rules: lookup of host-suffix and path-prefix expressions by hash prefix."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Everything up to the first "://", the host, the path.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# Hex digits of a digest that the join sees: 4 bytes.
HASH_PREFIX = 8


def url_host(url: Column) -> Column:
    """From the first "://" to "/", "?", "#" or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """From behind the host to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_column: str = "url",
    default: str = "allow",
    hash_prefix: int = HASH_PREFIX,
) -> DataFrame:
    """Judge each url by the longest rule that fits it.

    rules: (host, path, verdict). A rule fits its host and all subdomains where
    the url's path starts with the rule's. Each different (host, path) is
    expanded to every suffix of its labels times every path prefix whose length
    occurs among the rules; the expressions meet the rules by equality on the
    first bytes of their SHA-256, full digests confirm, and the longest rule
    wins: then the longer host, then block before allow.

    Returns the rows of pages with host, path, rule and verdict. Null urls and
    those without "://" have an empty host and path; without a fitting rule, rule
    is null and verdict the default. Repeated rows are judged each; columns of
    pages named like an added one are replaced. Rules with a null host, path or
    verdict are ignored. The driver sees only the distinct lengths of rule paths,
    at most as many as the longest path has characters.
    """
    listed = rules.dropna(subset=["host", "path", "verdict"]).select(
        F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
    )
    lengths = sorted(r[0] for r in listed.select(F.length("rule_path")).distinct().collect())
    digest = F.sha2(F.concat("rule_host", "rule_path"), 256)
    known = listed.select(
        F.substring(digest, 1, hash_prefix).alias("rule_key"),
        digest.alias("rule_digest"),
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("length"),
            F.length("rule_host").alias("host_length"),
            (F.col("rule_verdict") == "block").alias("blocks"),
            F.concat("rule_host", "rule_path").alias("rule"),
            F.col("rule_verdict").alias("verdict"),
        ).alias("fit"),
    )

    keep = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    judged = pages.select(
        *[F.col(f"`{c}`") for c in keep],
        url_host(F.col(url_column)).alias("host"),
        url_path(F.col(url_column)).alias("path"),
    )
    labels = F.split("host", r"\.", -1)
    suffixes = F.expr("transform(labels, (x, i) -> array_join(slice(labels, i + 1, size(labels)), '.'))")
    allowed = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    prefixes = F.transform(
        F.filter(allowed, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    expressions = (
        judged.select("host", "path")
        .distinct()
        .withColumn("labels", labels)
        .select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"))
    )
    best = (
        expressions.withColumn("key", F.substring("digest", 1, hash_prefix))
        .join(known, F.col("key") == F.col("rule_key"))
        .where(F.col("digest") == F.col("rule_digest"))
        .groupBy(F.col("host").alias("best_host"), F.col("path").alias("best_path"))
        .agg(F.max("fit").alias("fit"))
    )
    return judged.join(
        best, (F.col("host") == F.col("best_host")) & (F.col("path") == F.col("best_path")), "left"
    ).select(
        *[F.col(f"`{c}`") for c in keep],
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.lit(default)).alias("verdict"),
    )
