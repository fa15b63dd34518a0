"""Small value rules of the raw table."""

from __future__ import annotations


def longitude(coordinates: str) -> str:
    """First coordinate; null when the array is short or null."""
    return f"get({coordinates}, 0)"


def latitude(coordinates: str) -> str:
    """Second coordinate; null when the array is short or null."""
    return f"get({coordinates}, 1)"


def long_to_boolean(number: str) -> str:
    """True for 1; false for every other number and for null."""
    return f"coalesce({number} = 1, false)"


def null_to_zero(number: str) -> str:
    """Missing numbers are stored as zero, and so count in averages."""
    return f"coalesce({number}, 0)"
