"""The same results in DuckDB SQL, straight from the given tables."""

from __future__ import annotations

from tremorline.plans.feed import DOCUMENT_FEATURES
from tremorline.plans.queries import (
    AGAIN_MONTH,
    AVERAGE_DECIMALS,
    LATE_MONTH,
    LOOKUP_CITY,
    LOOKUP_MONTH,
    LOOKUP_SINCE,
    LOOKUP_STATE,
    LOOKUP_UNTIL,
    LOOKUP_YEAR,
)

# The two place patterns, city before state, and what else is said.
DISTANCE_PLACE = r"^.* of (.*)\s*,\s*(.*)\s*$"
PLAIN_PLACE = r"^\s*(.*)\s*,\s*(.*)\s*$"
UNKNOWN = "Unknown"


def _parsed(group: int) -> str:
    return f"""
        CASE WHEN regexp_matches(place, '{DISTANCE_PLACE}')
             THEN regexp_extract(place, '{DISTANCE_PLACE}', {group})
             WHEN regexp_matches(place, '{PLAIN_PLACE}')
             THEN regexp_extract(place, '{PLAIN_PLACE}', {group})
             ELSE '{UNKNOWN}' END"""


_FEED = f"""
WITH feed AS (
    SELECT CAST(e.event_id AS VARCHAR) AS id,
           e.event_id AS seq,
           date_trunc('minute', e.ts) AS ts,
           date_trunc('day', e.ts) AS window_start,
           (epoch_ms(date_trunc('day', e.ts)) // 86400000) * 4294967296
               + e.event_id // {DOCUMENT_FEATURES} AS doc_seq,
           CASE e.event_id % 6
               WHEN 0 THEN e.user_id || 'km N of ' || e.event_type || ', ' || n.n_name
               WHEN 1 THEN e.event_type || ', ' || n.n_name
               WHEN 2 THEN n.n_name
               WHEN 3 THEN '5 km W of Isle of ' || e.event_type || ', X, ' || n.n_name
               WHEN 4 THEN '2km S of ' || e.event_type || ' , ' || n.n_name || ' '
           END AS place,
           CASE WHEN e.event_id % 10 <> 0 THEN e.value END AS mag,
           e.event_id % 3 AS tsunami_code,
           CASE WHEN e.event_id % 7 = 0 THEN 'green' END AS alert,
           CASE WHEN e.event_id % 11 <> 0 THEN e.user_id END AS sig,
           e.event_type AS network,
           CAST(e.event_id % 360 - 180 AS DOUBLE) AS longitude,
           CAST(e.event_id % 180 - 90 AS DOUBLE) AS latitude
    FROM events e
    LEFT JOIN customer c ON e.user_id = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
docs AS (
    SELECT window_start, doc_seq, count(*) AS published_count,
           string_agg(id, ',' ORDER BY seq) AS ids,
           dayofweek(window_start) IN (0, 6) AS damaged
    FROM feed
    GROUP BY window_start, doc_seq
),
raw AS (
    SELECT strftime(ts, '%Y') AS year,
           strftime(ts, '%m') AS month,
           ts AS "timestamp",
           strftime(ts, '%Y/%m/%d') AS date,
           strftime(ts, '%H') AS hour,
           epoch_ms(ts) AS unix_timestamp,
           id,
           {_parsed(2)} AS state,
           {_parsed(1)} AS city,
           place, longitude, latitude,
           coalesce(mag, 0.0) AS magnitude,
           'ml' AS magnitude_type,
           tsunami_code = 1 AS tsunami,
           'tremor' AS event_kind,
           alert,
           CAST(coalesce(sig, 0) AS INTEGER) AS significant_level,
           network,
           seq
    FROM feed
),
cur AS (
    SELECT * FROM raw
    QUALIFY row_number() OVER (PARTITION BY year, month, "timestamp" ORDER BY seq DESC) = 1
),
bounds AS (
    SELECT min(window_start) AS first_day, max(window_start) AS last_day FROM feed
),
plan AS (
    SELECT s AS window_start,
           s + INTERVAL 1 DAY - INTERVAL 1 SECOND AS window_end,
           s + INTERVAL 1 DAY AS next_start,
           strftime(s, '%Y-%m-%d %H:%M:%S') AS start_text,
           strftime(s + INTERVAL 1 DAY - INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS end_text
    FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS s FROM bounds)
)
"""

_HOURS = "SELECT state, city, date, hour, CAST(count(*) AS INTEGER) AS count FROM {rows} GROUP BY ALL"
_DAYS = (
    "SELECT state, city, date, "
    f"CAST(sum(CAST(magnitude AS DECIMAL(18,{AVERAGE_DECIMALS}))) AS DOUBLE) / count(*) AS average "
    "FROM {rows} GROUP BY ALL"
)
_PLACE_IS = f"state = '{LOOKUP_STATE}' AND city = '{LOOKUP_CITY}'"


def _merged(statement: str, keys: str) -> str:
    before, after = statement.format(rows="raw"), statement.format(rows="cur")
    return f"""
    SELECT * FROM ({after})
    UNION ALL
    SELECT * FROM ({before}) b WHERE ({keys}) NOT IN (SELECT ({keys}) FROM cur)
    """


_SELECTS = {
    "landing_documents": "SELECT doc_seq, published_count AS count, ids FROM docs",
    "publish_documents": """
        SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS key, published_count AS count, ids
        FROM docs""",
    "stream_ingest": "SELECT * EXCLUDE (seq) FROM cur",
    "scan_raw": """
        SELECT * EXCLUDE (seq) FROM (
            SELECT * FROM raw
            UNION ALL
            SELECT * REPLACE (magnitude + 1 AS magnitude, seq + 1000000000000000 AS seq)
            FROM raw WHERE dayofweek("timestamp") IN (0, 6))
        QUALIFY row_number() OVER (PARTITION BY year, month, "timestamp" ORDER BY seq DESC) = 1""",
    "upsert_raw": "SELECT * EXCLUDE (seq) FROM cur",
    "merge_hour_counts": _merged(_HOURS, "state, city, date, hour"),
    "merge_day_averages": _merged(_DAYS, "state, city, date"),
    "plan_windows": "SELECT * FROM plan",
    "pending_windows": """
        SELECT * FROM plan
        WHERE window_start NOT IN (SELECT window_start FROM docs WHERE NOT damaged)""",
    "decode_documents": """
        SELECT doc_seq,
               CASE WHEN damaged THEN 0 ELSE published_count END AS count,
               damaged AS is_corrupt,
               CASE WHEN damaged THEN '' ELSE ids END AS ids
        FROM docs""",
    "document_counts": """
        SELECT doc_seq,
               CASE WHEN damaged THEN 0 ELSE published_count END AS count,
               CASE WHEN damaged THEN 0 ELSE published_count END AS feature_rows,
               CAST(0 AS BIGINT) AS rejected,
               damaged AS is_corrupt
        FROM docs""",
    "rejects": """
        SELECT doc_seq, CAST(0 AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS leaf,
               'a null entry' AS reason, CAST(NULL AS VARCHAR) AS text
        FROM docs
        UNION ALL
        SELECT doc_seq, 1, NULL, 'not an object', '5' FROM docs
        UNION ALL
        SELECT doc_seq, position, 'tsunami', 'not a whole number', '2.5' FROM (
            SELECT doc_seq, tsunami_code,
                   1 + row_number() OVER (PARTITION BY doc_seq ORDER BY seq) AS position
            FROM feed)
        WHERE tsunami_code = 2""",
    "explode_features": """
        SELECT place,
               CAST(longitude AS VARCHAR) || ' ' || CAST(latitude AS VARCHAR) || ' 10.0'
                   AS coordinates,
               epoch_ms(ts) AS time, mag, 'ml' AS "magType", tsunami_code AS tsunami,
               'tremor' AS type, alert, CAST(sig AS VARCHAR) AS sig,
               network AS net, id
        FROM feed""",
    "normalize_features": "SELECT * EXCLUDE (seq) FROM raw",
    "parse_place": "SELECT id, place, state, city FROM raw",
    "lon_lat": "SELECT id, longitude, latitude FROM raw",
    "long_to_boolean": "SELECT id, tsunami FROM raw",
    "time_parts": """
        SELECT id, year, month, date, hour, "timestamp", unix_timestamp FROM raw""",
    "null_to_zero": """
        SELECT id, magnitude, CAST(significant_level AS BIGINT) AS significant_level FROM raw""",
    "count_by_hour": _HOURS.format(rows="cur"),
    "avg_magnitude_by_day": _DAYS.format(rows="cur"),
    "filter_state": _HOURS.format(rows=f"(SELECT * FROM cur WHERE state = '{LOOKUP_STATE}')"),
    "sql_count_by_hour": "SELECT state, city, date, hour, count(*) AS count FROM cur GROUP BY ALL",
    "sql_avg_by_day": """
        SELECT state, city, date, round(avg(magnitude) + 1e-9, 6) AS average
        FROM cur GROUP BY state, city, date""",
    "ingest_audit": """
        SELECT *, published_running - processed_running AS diff FROM (
            SELECT window_start, published_count, processed_rows,
                   CAST(sum(published_count) OVER w AS BIGINT) AS published_running,
                   CAST(sum(processed_rows) OVER w AS BIGINT) AS processed_running
            FROM (SELECT window_start,
                         CAST(sum(published_count) AS BIGINT) AS published_count,
                         CAST(sum(CASE WHEN damaged THEN 0 ELSE published_count END) AS BIGINT)
                             AS processed_rows
                  FROM docs GROUP BY window_start)
            WINDOW w AS (ORDER BY window_start))""",
    "topic_audit": """
        SELECT *, published_running - processed_running AS diff FROM (
            SELECT window_start, published_count, processed_rows,
                   CAST(sum(published_count) OVER w AS BIGINT) AS published_running,
                   CAST(sum(processed_rows) OVER w AS BIGINT) AS processed_running
            FROM (SELECT window_start,
                         CAST(sum(CASE WHEN dayofweek(window_start) = 1 THEN 0
                                       ELSE published_count END) AS BIGINT) AS published_count,
                         CAST(sum(CASE WHEN damaged THEN 0 ELSE published_count END) AS BIGINT)
                             AS processed_rows
                  FROM docs GROUP BY window_start)
            WINDOW w AS (ORDER BY window_start))""",
    "lookup_raw_month": f"""
        SELECT * EXCLUDE (seq) FROM cur
        WHERE year = '{LOOKUP_YEAR}' AND month = '{LOOKUP_MONTH}'
        ORDER BY "timestamp" DESC""",
    "lookup_hour_counts": f"""
        SELECT * FROM ({_HOURS.format(rows="cur")}) WHERE {_PLACE_IS}
        ORDER BY date DESC, hour DESC""",
    "lookup_day_averages": f"""
        SELECT * FROM ({_DAYS.format(rows="cur")}) WHERE {_PLACE_IS}
        ORDER BY date DESC""",
    "hour_counts_from_documents": _HOURS.format(rows="cur"),
}

# The feed spread over months, and its rows after some months were published again.
_MONTHS = (
    _FEED.replace(
        "date_trunc('minute', e.ts) AS ts,",
        "date_trunc('minute', e.ts) + to_days(CAST(e.event_id % 5 * 30 AS INTEGER)) AS ts,",
    )
    + """,
later AS (
    SELECT * FROM raw
    UNION ALL
    SELECT * REPLACE (magnitude + 1 AS magnitude, seq + 1000000000000000 AS seq)
    FROM raw WHERE month IN ({months})
),
now AS (
    SELECT * EXCLUDE (seq) FROM later
    QUALIFY row_number() OVER (PARTITION BY year, month, "timestamp" ORDER BY seq DESC) = 1
)
"""
)
_BOTH = f"'{AGAIN_MONTH}', '{LATE_MONTH}'"
_MONTH_SELECTS = {
    "scan_months": _MONTHS.format(months=_BOTH) + "SELECT * FROM now",
    "refresh_months": _MONTHS.format(months=_BOTH)
    + f"""
        SELECT state, city, date, CAST(count(*) AS BIGINT) AS events,
               CAST(sum(CAST(magnitude AS DECIMAL(18,{AVERAGE_DECIMALS}))) AS DOUBLE) / count(*) AS average
        FROM now GROUP BY ALL""",
    "lookup_raw_range": _MONTHS.format(months=f"'{AGAIN_MONTH}'")
    + f"""
        SELECT * FROM now
        WHERE year = '{LOOKUP_YEAR}' AND month = '{AGAIN_MONTH}'
            AND unix_timestamp BETWEEN {LOOKUP_SINCE} AND {LOOKUP_UNTIL}
        ORDER BY "timestamp" DESC""",
}

ORACLES: dict[str, str] = {
    **{name: _FEED + select for name, select in _SELECTS.items()},
    **_MONTH_SELECTS,
}
