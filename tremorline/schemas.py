"""Table shapes, keys and storage order."""

# The JSON members read from an event document. A document is read
# down to its features, each still a text, and features one by one: one that is
# broken costs no more than itself. Numbers are read as text for the same reason.
DOCUMENT_SCHEMA = "metadata: STRING, features: ARRAY<STRING>"
MALFORMED = "_malformed"
FEATURE_SCHEMA = f"""
    id STRING,
    properties STRUCT<
        place: STRING,
        time: STRING,
        mag: STRING,
        magType: STRING,
        tsunami: STRING,
        type: STRING,
        alert: STRING,
        sig: STRING,
        net: STRING>,
    geometry STRUCT<coordinates: ARRAY<STRING>>,
    {MALFORMED} STRING
"""

# The leaves of one feature, in output order.
FEATURE_LEAVES = {
    "place": "properties.place",
    "coordinates": "geometry.coordinates",
    "time": "properties.time",
    "mag": "properties.mag",
    "magType": "properties.magType",
    "tsunami": "properties.tsunami",
    "type": "properties.type",
    "alert": "properties.alert",
    "sig": "properties.sig",
    "net": "properties.net",
    "id": "id",
}

# A landed document. doc_seq is its publish number: a property of the source
# (header, offset, number in the file name), never of the run that reads it. One
# that has no number gets one below zero from its text. Sources that know a
# document's window carry it in a further column, window_start.
LANDING_SCHEMA = "doc_seq BIGINT, value STRING"

# What the publisher notes per attempt, and what the ingest notes per document.
PUBLICATION_SCHEMA = "window_start TIMESTAMP_NTZ, doc_seq BIGINT, published_count BIGINT"
TALLY_SCHEMA = (
    "doc_seq BIGINT, count BIGINT, feature_rows BIGINT, rejected BIGINT, bad_leaves BIGINT,"
    " is_corrupt BOOLEAN, window_start TIMESTAMP_NTZ"
)

# What of a document did not decode: the document (no position), a feature (no
# leaf), or one leaf of a feature that itself stays.
REJECT_SCHEMA = "doc_seq BIGINT, position INT, leaf STRING, reason STRING, text STRING"

# The raw event table.
RAW_FIELDS = {
    "year": "STRING",
    "month": "STRING",
    "timestamp": "TIMESTAMP",
    "date": "STRING",
    "hour": "STRING",
    "unix_timestamp": "BIGINT",
    "id": "STRING",
    "state": "STRING",
    "city": "STRING",
    "place": "STRING",
    "longitude": "DOUBLE",
    "latitude": "DOUBLE",
    "magnitude": "DOUBLE",
    "magnitude_type": "STRING",
    "tsunami": "BOOLEAN",
    "event_kind": "STRING",
    "alert": "STRING",
    "significant_level": "INT",
    "network": "STRING",
}
RAW_COLUMNS = list(RAW_FIELDS)
SEQUENCE_FIELDS = {"_doc_seq": "BIGINT", "_position": "INT"}
SEQUENCE_COLUMNS = list(SEQUENCE_FIELDS)
RAW_LOG_SCHEMA = ", ".join(
    f"{name} {kind}" for name, kind in {**RAW_FIELDS, **SEQUENCE_FIELDS}.items()
)

# Keys. The event id is not part of the raw key: two events of the same
# millisecond are one row. timestamp leads because an 8-byte leading column
# sorts on its prefix; year and month stay in so that partition filters pass
# through the window.
RAW_PARTITIONS = ["year", "month"]
RAW_KEY = ["timestamp", "year", "month"]

HOUR_COUNT_SCHEMA = "state STRING, city STRING, date STRING, hour STRING, count INT"
HOUR_COUNT_KEY = ["state", "city", "date", "hour"]
DAY_AVERAGE_SCHEMA = "state STRING, city STRING, date STRING, average DOUBLE"
DAY_AVERAGE_KEY = ["state", "city", "date"]

# The same views stored by month, in a form that adds up.
HOUR_STATE_SCHEMA = f"{HOUR_COUNT_SCHEMA}, year STRING, month STRING"
DAY_STATE_SCHEMA = "state STRING, city STRING, date STRING, total {total}, rows BIGINT, year STRING, month STRING"

# Storage order inside each key's partition: newest first.
HOUR_COUNT_NEWEST_FIRST = ["date", "hour"]
DAY_AVERAGE_NEWEST_FIRST = ["date"]
