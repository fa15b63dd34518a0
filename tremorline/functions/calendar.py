"""UTC calendar fields of epoch milliseconds.

Worked out from the number itself, so the session time zone has no say, and
without a date formatter, which costs more than the arithmetic.
"""

from __future__ import annotations

MILLIS_PER_HOUR = 3_600_000
MILLIS_PER_DAY = 86_400_000
# Spark keeps timestamps as 64-bit microseconds.
MAX_MILLIS = (2**63 - 1) // 1000


def _millis_of_day(millis: str) -> str:
    return f"pmod({millis}, {MILLIS_PER_DAY}L)"


def _two_digits(number: str) -> str:
    return f"lpad(CAST({number} AS STRING), 2, '0')"


def in_timestamp_range(millis: str) -> str:
    """False for times that no Spark timestamp can hold; null stays null."""
    return f"({millis} BETWEEN -{MAX_MILLIS} AND {MAX_MILLIS})"


def utc_date(millis: str) -> str:
    """The UTC day as a date."""
    days = f"({millis} - {_millis_of_day(millis)}) DIV {MILLIS_PER_DAY}L"
    return f"date_from_unix_date(CAST({days} AS INT))"


def year_text(date: str) -> str:
    """At least four digits, sign in front; longer years are kept whole."""
    digits = f"CAST(abs(year({date})) AS STRING)"
    padded = f"lpad({digits}, greatest(4, length({digits})), '0')"
    return f"CASE WHEN year({date}) < 0 THEN concat('-', {padded}) ELSE {padded} END"


def month_text(date: str) -> str:
    """Two digits."""
    return _two_digits(f"month({date})")


def date_text(date: str) -> str:
    """year/month/day."""
    day = _two_digits(f"day({date})")
    return f"concat({year_text(date)}, '/', {month_text(date)}, '/', {day})"


def hour_text(millis: str) -> str:
    """Two digits, 00 to 23."""
    return _two_digits(f"{_millis_of_day(millis)} DIV {MILLIS_PER_HOUR}L")


def day_start(millis: str) -> str:
    """Midnight UTC of the day, as a zone-less timestamp."""
    return f"CAST({utc_date(millis)} AS TIMESTAMP_NTZ)"


def utc_wall_clock(millis: str) -> str:
    """The UTC wall clock as a zone-less timestamp."""
    seconds = f"CAST({_millis_of_day(millis)} AS DECIMAL(18,6)) / 1000"
    return f"{day_start(millis)} + make_dt_interval(0, 0, 0, CAST({seconds} AS DECIMAL(18,6)))"
