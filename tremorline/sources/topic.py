"""A topic as sink and source of documents.

The Kafka package has to be on the cluster's classpath; nothing else here needs
it, and files or the landing table carry the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


# The headers in which a message carries its document's identity.
WINDOW_HEADER, NUMBER_HEADER = "window_start", "doc_seq"

# A topic's records, as the source gives them with headers.
RECORD_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP,"
    " headers ARRAY<STRUCT<key: STRING, value: BINARY>>"
)


def to_messages(documents: DataFrame, key: Column | None = None) -> DataFrame:
    """One (key, value) message per document.

    Where documents know their window, a message also carries headers, window and
    publish number, from which the reader knows the document again; its key is
    then the window unless another is given, so that on a topic with several
    partitions two publications of a window keep their order.
    """
    knows_window = "window_start" in documents.columns
    if key is None:
        key = F.col("window_start") if knows_window else F.lit(None)
    message = [key.cast("string").alias("key"), F.col("value")]
    if knows_window:
        identity = [
            F.struct(F.lit(name).alias("key"), F.col(column).cast("string").cast("binary").alias("value"))
            for name, column in ((WINDOW_HEADER, "window_start"), (NUMBER_HEADER, "doc_seq"))
        ]
        message.append(F.array(*identity).alias("headers"))
    return documents.select(*message)


def publish_to_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a batch of messages."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_stream_to_topic(
    messages: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Send a stream of messages."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def _header(name: str) -> Column:
    """The text of a record's last header of that name, or null."""
    found = F.expr(f"try_element_at(filter(headers, h -> h.key = '{name}'), -1).value")
    return found.cast("string")


def documents_from_records(records: DataFrame) -> DataFrame:
    """Topic records to landed documents.

    With headers, a document has the publish number and the window under which
    it was sent (doc_seq, value, window_start). Without, or where a header does
    not hold a number, the offset is the publish number; a topic's partitions
    share these out among themselves, which leaves the order within a partition
    as it is. The partition must then fit in 16 bits. Do not mix both kinds of
    numbers in one log: which of two documents is later is told by them.
    """
    partition = F.col("partition").cast("bigint")
    too_many = F.raise_error(F.lit("a topic's partition number must fit in 16 bits")).cast("bigint")
    number = F.when(partition > 65_535, too_many).otherwise(
        F.shiftleft(F.col("offset"), 16).bitwiseOR(partition)
    )
    value = F.col("value").cast("string").alias("value")
    if "headers" not in records.columns:
        return records.select(number.alias("doc_seq"), value)
    return records.select(
        F.coalesce(_header(NUMBER_HEADER).try_cast("bigint"), number).alias("doc_seq"),
        value,
        _header(WINDOW_HEADER).try_cast("timestamp_ntz").alias("window_start"),
    )


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All documents now in the topic."""
    records = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", True)
        .load()
    )
    return documents_from_records(records)


def stream_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Documents as they arrive, at most max_offsets per micro-batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", True)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return documents_from_records(reader.load())
