"""State and city out of a free-text place."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The two place patterns, tried in this order. Group 1 is the
# city, group 2 the state.
DISTANCE_PLACE = r"^.* of (.*)\s*,\s*(.*)\s*$"
PLAIN_PLACE = r"^\s*(.*)\s*,\s*(.*)\s*$"
UNKNOWN = "Unknown"

# Line ends that a pattern may stop in front of without taking them in.
_LINE_ENDS = r"\u0085\u2028\u2029"


def _captures(place: str, pattern: str) -> str:
    return f"regexp_replace({place}, r'{pattern}', '$2\\n$1')"


def with_state_and_city(rows: DataFrame, place: str = "place") -> DataFrame:
    """Add state and city; both "Unknown" where no pattern fits or place is null.

    Each pattern runs once per row and gives both captures, where testing and
    extracting would run it three times. A dot never matches a line break, so a
    line break separates the captures; and a text that matches changes, for it
    loses at least the comma between them. Empty captures stay empty.
    """
    fits = f"_captures <> {place}"
    city = f"trim(TRAILING '{_LINE_ENDS}' FROM substring_index(_captures, '\\n', -1))"
    return (
        rows.selectExpr("*", f"{_captures(place, DISTANCE_PLACE)} AS _distance")
        .selectExpr(
            "*",
            f"CASE WHEN _distance <> {place} THEN _distance"
            f" ELSE {_captures(place, PLAIN_PLACE)} END AS _captures",
        )
        .selectExpr(
            *rows.columns,
            f"CASE WHEN {fits} THEN substring_index(_captures, '\\n', 1)"
            f" ELSE '{UNKNOWN}' END AS state",
            f"CASE WHEN {fits} THEN {city} ELSE '{UNKNOWN}' END AS city",
        )
    )
