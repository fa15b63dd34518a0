"""A seismic feed derived from the given tables: events, customer and nation.

Every event becomes one feature. Times are cut to the minute so that upsert keys
collide, places take all the shapes the parser knows, and magnitude,
significance, alert and place are missing now and then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.functions import day_start, utc_date
from tremorline.schemas import FEATURE_LEAVES

# Most features in one document. Event numbers are unique, so a run of this many
# numbers holds at most this many features, however full a window is.
DOCUMENT_FEATURES = 20_000

_TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
}

_FEATURES = """
    SELECT
        e.event_id AS arrival,
        unix_date(CAST(e.ts AS DATE)) * 86400000L
            + hour(e.ts) * 3600000L + minute(e.ts) * 60000L AS time,
        CASE e.event_id % 6
            WHEN 0 THEN concat(e.user_id, 'km N of ', e.event_type, ', ', n.n_name)
            WHEN 1 THEN concat(e.event_type, ', ', n.n_name)
            WHEN 2 THEN n.n_name
            WHEN 3 THEN concat('5 km W of Isle of ', e.event_type, ', X, ', n.n_name)
            WHEN 4 THEN concat('2km S of ', e.event_type, ' , ', n.n_name, ' ')
        END AS place,
        CASE WHEN e.event_id % 10 <> 0 THEN e.value END AS mag,
        'ml' AS magType,
        e.event_id % 3 AS tsunami,
        'tremor' AS type,
        CASE WHEN e.event_id % 7 = 0 THEN 'green' END AS alert,
        CASE WHEN e.event_id % 11 <> 0 THEN e.user_id END AS sig,
        e.event_type AS net,
        CAST(e.event_id AS STRING) AS id,
        array(CAST(e.event_id % 360 - 180 AS DOUBLE),
              CAST(e.event_id % 180 - 90 AS DOUBLE),
              CAST(10 AS DOUBLE)) AS coordinates
    FROM {events} e
    LEFT JOIN {customer} c ON e.user_id = c.c_custkey
    LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""


def features(spark: SparkSession, sf_dir: str, per_document: int = DOCUMENT_FEATURES) -> DataFrame:
    """Feature rows as explode_features gives them, plus arrival and window_start."""
    tables = {
        name: spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
        for name, schema in _TABLES.items()
    }
    window_start = day_start("time")
    return spark.sql(_FEATURES, **tables).selectExpr(
        *FEATURE_LEAVES,
        "arrival",
        f"{window_start} AS window_start",
        f"shiftleft(CAST(unix_date({utc_date('time')}) AS BIGINT), 32)"
        f" | (arrival DIV {per_document}) AS _doc_seq",
        f"CAST(arrival % {per_document} AS INT) AS _position",
    )


def spread_over_months(rows: DataFrame) -> DataFrame:
    """The same features, four of five moved on by 30, 60, 90 and 120 days."""
    return rows.withColumn("time", F.col("time") + F.col("arrival") % 5 * (30 * 86_400_000)).drop("window_start")


def documents(rows: DataFrame) -> DataFrame:
    """Pack features into documents: (window_start, doc_seq, value).

    One document per window and run of arrivals: the size of a document has a
    fixed bound, and a window that holds much of the data gives more documents,
    not a larger one. Features lie in order of arrival.
    """
    properties = ", ".join(
        leaf for leaf, path in FEATURE_LEAVES.items() if path.startswith("properties.")
    )
    feature = f"struct(id, struct({properties}) AS properties, struct(coordinates) AS geometry)"
    packed = rows.groupBy("window_start", F.col("_doc_seq").alias("doc_seq")).agg(
        F.count("*").alias("features"),
        F.expr(f"sort_array(collect_list(struct(arrival, {feature} AS feature)))").alias("packed"),
    )
    return packed.selectExpr(
        "window_start",
        "doc_seq",
        "to_json(struct('FeatureCollection' AS type, struct(features AS count) AS metadata,"
        " packed.feature AS features)) AS value",
    )


def damage_weekends(landed: DataFrame) -> DataFrame:
    """The same documents, those of weekend windows no longer valid JSON."""
    weekend = F.dayofweek("window_start").isin(1, 7)
    broken = F.concat(F.lit("{"), F.col("value"))
    return landed.withColumn("value", F.when(weekend, broken).otherwise(F.col("value")))


def with_bad_entries(landed: DataFrame) -> DataFrame:
    """The same documents, each with two entries more that are no features, in
    front, and with every tsunami code 2 no longer a whole number."""
    more = F.replace("value", F.lit('"features":['), F.lit('"features":[null,5,'))
    return landed.withColumn("value", F.replace(more, F.lit('"tsunami":2'), F.lit('"tsunami":2.5')))


def as_records(messages: DataFrame, partitions: int = 3) -> DataFrame:
    """Messages as a topic gives them back: partition by key, offsets ascending."""
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        "headers",
    )


def republished_weekends(raw: DataFrame) -> DataFrame:
    """Weekend rows published again under later numbers, one magnitude up."""
    date = F.date_from_unix_date(F.shiftright("_doc_seq", 32).cast("int"))
    return republished(raw.where(F.dayofweek(date).isin(1, 7)))


def republished(raw: DataFrame) -> DataFrame:
    """Rows published again under later numbers, one magnitude up."""
    return raw.withColumns(
        {
            "magnitude": F.col("magnitude") + 1,
            "_doc_seq": F.col("_doc_seq") + F.shiftleft(F.lit(1).cast("bigint"), 60),
        }
    )

