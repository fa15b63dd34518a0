"""Documents to feature rows, the counts taken on the way, and what did not decode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.functions import in_timestamp_range
from tremorline.schemas import (
    DOCUMENT_SCHEMA,
    FEATURE_LEAVES,
    FEATURE_SCHEMA,
    MALFORMED,
    SEQUENCE_COLUMNS,
)

# The range of the stored significance.
_LEAST_INT, _MOST_INT = -(2**31), 2**31 - 1


def _whole(text: str) -> str:
    """A whole number written as text, perhaps with a fraction of zero, as BIGINT; else null."""
    exact = f"try_cast({text} AS DECIMAL(38, 18))"
    return f"coalesce(try_cast({text} AS BIGINT), if({exact} % 1 = 0, try_cast({exact} AS BIGINT), NULL))"


def _number(text: str) -> str:
    """A finite number written as text, as DOUBLE; else null.

    The cast also takes names, type letters at the end and hexadecimals.
    """
    number = f"try_cast({text} AS DOUBLE)"
    decimal = f"ascii(right({text}, 1)) BETWEEN 48 AND 57 AND instr({text}, 'x') + instr({text}, 'X') = 0"
    return f"if(abs({number}) < double('Infinity') AND {decimal}, {number}, NULL)"


# How a leaf's text is typed, and what is wrong with one that is there but bad.
_TYPED = {
    "time": (_whole, "not a whole number"),
    "mag": (_number, "not a finite number"),
    "tsunami": (_whole, "not a whole number"),
    "sig": (_whole, "not a whole number within the range of int"),
}
_COORDINATES = "_feature.geometry.coordinates"
_BAD_COORDINATE = f"exists({_COORDINATES}, c -> c IS NOT NULL AND {_number('c')} IS NULL)"


def _path(leaf: str) -> str:
    return f"_feature.{FEATURE_LEAVES[leaf]}"


def _is_bad(leaf: str) -> str:
    typed = _TYPED[leaf][0](_path(leaf))
    # Stored as an int: normalize_features gives null beyond its range.
    good = f"{typed} BETWEEN {_LEAST_INT} AND {_MOST_INT}" if leaf == "sig" else f"{typed} IS NOT NULL"
    return f"({_path(leaf)} IS NOT NULL AND NOT coalesce({good}, false))"


_IS_OBJECT = "startswith(_text, '{')"
_IS_IN_RANGE = f"coalesce({in_timestamp_range(_whole(_path('time')))}, true)"


def decode_documents(landing: DataFrame) -> DataFrame:
    """(doc_seq, value, ...) to (doc_seq, ..., count, features, is_corrupt).

    features are the texts of the document's entries, which explode_features
    reads one by one. The schema is explicit, so nothing depends on what else is
    in the batch. A text that is not one document, has more behind it, or whose
    features are no array gives count 0 and no features, and is marked: its
    window stays pending. An absent count, or one that is no whole number, is 0.

    The text is decoded as the first member of an array whose second one holds
    the text's hash. Only a text that is one whole document leaves that member
    where it is: text behind it moves it, cuts it off or breaks the array.
    """
    mark = "CAST(xxhash64(value) AS STRING)"
    wrapped = F.expr(f"""concat('[', value, ',{{"end":"', {mark}, '"}}]')""")
    members = F.from_json(wrapped, f"ARRAY<STRUCT<{DOCUMENT_SCHEMA}, end: STRING>>")
    whole = (
        f"coalesce(size(_members) = 2 AND _members[1].end = {mark} AND _members[0] IS NOT NULL, false)"
        # Features that are there but no array are null here.
        " AND (_members[0].features IS NOT NULL OR get_json_object(value, '$.features') IS NULL)"
    )
    carried = [name for name in landing.columns if name != "value"]
    announced = "get_json_object(_document.metadata, '$.count')"
    return (
        landing.withColumn("_members", members)
        .withColumn("_document", F.expr(f"if({whole}, _members[0], NULL)"))
        .selectExpr(
            *carried,
            f"coalesce({_whole(announced)}, 0L) AS count",
            "_document.features AS features",
            "_document IS NULL AS is_corrupt",
        )
    )


def _entries(decoded: DataFrame, *carried: str, objects_only: bool = False) -> DataFrame:
    """One row per entry of features, its text decoded; documents without any give one row.

    The outer form, because for the inner one Spark derives a filter on the
    array's size and moves it below the decoding, which then runs several times
    per document. A feature comes out of an explode of its own, for filters on
    its leaves stay above that: beside from_json they would each decode again.
    """
    entries = decoded.selectExpr(*carried, "posexplode_outer(features) AS (_position, _text)")
    feature = F.from_json("_text", FEATURE_SCHEMA, {"columnNameOfCorruptRecord": MALFORMED})
    return (entries.where(_IS_OBJECT) if objects_only else entries).select(
        "*", F.explode(F.array(feature)).alias("_feature")
    )


def document_counts(decoded: DataFrame) -> DataFrame:
    """One row per document: announced count, usable features, rejected ones, bad leaves.

    Rejected are entries that are null or no object, and features at times that
    no timestamp can hold: they give no row. A bad leaf is one that is there but
    of the wrong type: it is null in a feature that stays. window_start is that
    which the document carries, or null. A document's entries are counted where
    they are decoded, one row per document is shuffled.
    """
    per_document = ["_document_id", "doc_seq", "count", "is_corrupt", "window_start"]
    numbered = decoded.withColumn("_document_id", F.monotonically_increasing_id())
    if "window_start" not in decoded.columns:
        numbered = numbered.withColumn("window_start", F.lit(None).cast("timestamp_ntz"))
    entries = _entries(numbered, *per_document)
    bad = " + ".join(f"int({test})" for test in [*map(_is_bad, _TYPED), f"coalesce({_BAD_COORDINATE}, false)"])
    usable = f"({_IS_OBJECT} AND {_IS_IN_RANGE})"
    flags = entries.selectExpr(
        *per_document,
        "_position IS NOT NULL AS _is_entry",
        f"coalesce({usable}, false) AS _usable",
        f"if({usable}, {bad} + int(_feature.{MALFORMED} IS NOT NULL), 0) AS _bad",
    )
    counted = flags.groupBy(*per_document).agg(
        F.count_if("_usable").alias("feature_rows"),
        F.count_if(F.expr("_is_entry AND NOT _usable")).alias("rejected"),
        F.coalesce(F.sum("_bad"), F.lit(0)).cast("bigint").alias("bad_leaves"),
    )
    return counted.select(
        "doc_seq", "count", "feature_rows", "rejected", "bad_leaves", "is_corrupt", "window_start"
    )


def rejects(decoded: DataFrame) -> DataFrame:
    """Everything that did not decode, one row each, with its place and reason.

    doc_seq, position, leaf, reason, text. A document that does not decode has
    neither position nor leaf, nor its text, which the landing keeps; a rejected
    feature has no leaf. Of a member of the wrong kind, such as properties that
    are no object, the leaf is not known either, but its feature stays.
    """
    leaves = [
        f"if({_is_bad(leaf)}, struct('{leaf}' AS leaf, '{reason}' AS reason, {_path(leaf)} AS text), NULL)"
        for leaf, (_, reason) in _TYPED.items()
    ]
    leaves.append(
        f"if(coalesce({_BAD_COORDINATE}, false), struct('coordinates' AS leaf, 'not finite numbers' AS reason,"
        f" to_json({_COORDINATES}) AS text), NULL)"
    )
    leaves.append(
        f"if(_feature.{MALFORMED} IS NOT NULL,"
        " struct(CAST(NULL AS STRING) AS leaf, 'a member of the wrong kind' AS reason, _text AS text), NULL)"
    )

    def whole(reason: str) -> str:
        return f"array(struct(CAST(NULL AS STRING) AS leaf, '{reason}' AS reason, _text AS text))"

    found = f"""CASE
        WHEN _position IS NULL THEN if(is_corrupt, {whole("not one whole document")}, NULL)
        WHEN _text IS NULL THEN {whole("a null entry")}
        WHEN NOT {_IS_OBJECT} THEN {whole("not an object")}
        WHEN NOT {_IS_IN_RANGE} THEN {whole("a time that no timestamp can hold")}
        ELSE array_compact(array({", ".join(leaves)})) END"""
    return (
        _entries(decoded, "doc_seq", "is_corrupt")
        .selectExpr("doc_seq", "_position AS position", f"explode({found}) AS _reject")
        .select("doc_seq", "position", "_reject.*")
    )


def explode_features(decoded: DataFrame) -> DataFrame:
    """One row per feature: its leaves and its place in the source.

    An empty or null array gives no row, and neither does an entry that is null
    or no object. A leaf of the wrong type is null; document_counts counts it
    and rejects names it.
    """
    typed = {leaf: rule(_path(leaf)) for leaf, (rule, _) in _TYPED.items()}
    typed["coordinates"] = f"transform({_COORDINATES}, c -> {_number('c')})"
    leaves = [f"{typed.get(leaf, _path(leaf))} AS {leaf}" for leaf in FEATURE_LEAVES]
    entries = _entries(decoded, "doc_seq AS _doc_seq", objects_only=True)
    return entries.selectExpr(*leaves, *SEQUENCE_COLUMNS)
