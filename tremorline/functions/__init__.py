"""Column rules as SQL expression texts, and the place parser.

Each rule takes the name of a column, or any expression text, and gives an
expression text for selectExpr, F.expr or a SQL statement. Spark parses a whole
row's worth of them in one call, where building the same from Column objects
takes a round trip for every operation: a cost that a one-second micro-batch
pays every second. All of them run inside Spark, without a Python worker.
"""

from tremorline.functions.calendar import (
    date_text,
    day_start,
    hour_text,
    in_timestamp_range,
    month_text,
    utc_date,
    utc_wall_clock,
    year_text,
)
from tremorline.functions.place import with_state_and_city
from tremorline.functions.scalars import latitude, long_to_boolean, longitude, null_to_zero

__all__ = [
    "date_text",
    "day_start",
    "hour_text",
    "in_timestamp_range",
    "latitude",
    "long_to_boolean",
    "longitude",
    "month_text",
    "null_to_zero",
    "utc_date",
    "utc_wall_clock",
    "with_state_and_city",
    "year_text",
]
