"""Feature rows to raw event rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tremorline.functions import (
    date_text,
    hour_text,
    in_timestamp_range,
    latitude,
    long_to_boolean,
    longitude,
    month_text,
    null_to_zero,
    utc_date,
    with_state_and_city,
    year_text,
)
from tremorline.schemas import RAW_COLUMNS, SEQUENCE_COLUMNS


def normalize_features(features: DataFrame, null_numeric: str = "zero") -> DataFrame:
    """The eleven feature leaves to the nineteen raw columns.

    null_numeric: "zero" stores missing time, magnitude and significance as 0;
    "keep" leaves them null. The place is parsed and the day found once per
    row, and their parts read from there. A time that no Spark timestamp can
    hold gives no row; document_counts reports it as rejected.
    """
    if null_numeric not in ("zero", "keep"):
        raise ValueError(f"null_numeric must be 'zero' or 'keep', not {null_numeric!r}")

    def number(name: str) -> str:
        return null_to_zero(name) if null_numeric == "zero" else name

    raw = {
        "year": year_text("_day"),
        "month": month_text("_day"),
        "timestamp": "timestamp_millis(_millis)",
        "date": date_text("_day"),
        "hour": hour_text("_millis"),
        "unix_timestamp": "_millis",
        "id": "id",
        "state": "state",
        "city": "city",
        "place": "place",
        "longitude": longitude("coordinates"),
        "latitude": latitude("coordinates"),
        "magnitude": f"CAST({number('mag')} AS DOUBLE)",
        "magnitude_type": "magType",
        "tsunami": long_to_boolean("tsunami"),
        "event_kind": "type",
        "alert": "alert",
        # Narrowed to int; one absurd value must not fail its whole batch.
        "significant_level": f"try_cast({number('sig')} AS INT)",
        "network": "net",
    }
    carried = [name for name in SEQUENCE_COLUMNS if name in features.columns]
    in_range = f"coalesce({in_timestamp_range('time')}, true)"
    timed = features.where(in_range).selectExpr(
        "*",
        f"CAST({number('time')} AS BIGINT) AS _millis",
        f"{utc_date(number('time'))} AS _day",
    )
    return with_state_and_city(timed).selectExpr(
        *[f"{raw[name]} AS {name}" for name in RAW_COLUMNS], *carried
    )
