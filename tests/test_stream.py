"""The stream gives the batch result under any split, replay and restart."""

import os
from datetime import datetime

import pytest
from helpers import DAY, HOUR, T0, document, feature, landing, rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tremorline.operators.audit import ingest_audit
from tremorline.operators.documents import decode_documents, document_counts, explode_features
from tremorline.operators.normalize import normalize_features
from tremorline.operators.upsert import latest_by_key
from tremorline.plans.jobs import refresh_hour_counts
from tremorline.schemas import (
    HOUR_COUNT_SCHEMA,
    LANDING_SCHEMA,
    PUBLICATION_SCHEMA,
    RAW_COLUMNS,
    TALLY_SCHEMA,
)
from tremorline.sources.landing import (
    land,
    land_text,
    read_landing,
    read_landing_text,
    stream_landing,
    stream_landing_text,
    without_number,
)
from tremorline.sources.tables import read_raw, read_view, scan_raw
from tremorline.sources.topic import (
    documents_from_records,
    publish_stream_to_topic,
    publish_to_topic,
    read_topic,
    stream_topic,
    to_messages,
)
from tremorline.streaming.ingest import run_available, start_ingest

# Days 1 to 6; each pair of neighbours collides in one millisecond.
DOCUMENTS = [
    # Over several lines, as feeds may send it.
    document(
        feature(f"{n}-a", T0 + (n // 2) * DAY, f"1km N of P{n}, S", float(n)),
        feature(f"{n}-b", T0 + n * DAY + HOUR, f"P{n}, S", None),
        feature(f"{n}-c", T0 + n * DAY + HOUR, "S", 2.0, tsunami=1),
    ).replace('{"', '{\n"')
    for n in range(1, 7)
]


def _write(folder, number, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{number:08d}.json", "w") as file:
        file.write(text)


def _batch_result(spark, documents):
    raw = normalize_features(explode_features(decode_documents(landing(spark, *documents))))
    return rows_of(latest_by_key(raw).select(RAW_COLUMNS))


class Ingest:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.source = f"{root}/landing"
        self.batches = []

    def run(self, per_batch=None, checkpoint="checkpoint", source=None):
        documents = source or stream_landing_text(self.spark, self.source, per_batch)
        return run_available(
            documents,
            f"{self.root}/raw",
            f"{self.root}/tally",
            f"{self.root}/{checkpoint}",
            on_batch=lambda batch_id, totals: self.batches.append(totals),
        )

    def current(self):
        return rows_of(scan_raw(self.spark, f"{self.root}/raw"))

    def tallies(self):
        return self.spark.read.schema(TALLY_SCHEMA).parquet(f"{self.root}/tally")


@pytest.fixture
def ingest(spark, tmp_path):
    return Ingest(spark, tmp_path)


@pytest.mark.parametrize("per_batch", [1, 4, 6])
def test_any_split_equals_batch(spark, ingest, per_batch):
    for number, text in enumerate(DOCUMENTS, start=1):
        _write(ingest.source, number, text)
    ingest.run(per_batch)
    assert ingest.current() == _batch_result(spark, DOCUMENTS)
    assert len(ingest.batches) == -(-6 // per_batch)
    assert sum(batch["documents"] for batch in ingest.batches) == 6
    assert sum(batch["measures"] for batch in ingest.batches) == 18


def test_replay_of_everything_changes_nothing(spark, ingest):
    for number, text in enumerate(DOCUMENTS, start=1):
        _write(ingest.source, number, text)
    ingest.run(2)
    ingest.run(3, checkpoint="another")
    assert read_raw(spark, f"{ingest.root}/raw").count() == 36
    assert ingest.current() == _batch_result(spark, DOCUMENTS)
    published = spark.createDataFrame(
        [(datetime(2010, 4, n), n, 3) for n in range(1, 7)], PUBLICATION_SCHEMA
    )
    audit = ingest_audit(published, ingest.tallies()).collect()
    assert len(audit) == 6 and {row.diff for row in audit} == {0}


def test_corrupt_and_empty_documents(spark, ingest):
    extra = ["{bad", document(), '{"metadata":{}}']
    for number, text in enumerate([*DOCUMENTS, *extra], start=1):
        _write(ingest.source, number, text)
    ingest.run(3)
    assert ingest.current() == _batch_result(spark, DOCUMENTS)
    assert sum(batch["corrupt"] for batch in ingest.batches) == 1
    assert rows_of(ingest.tallies().where("is_corrupt"), "doc_seq") == [(7,)]


def test_batch_of_only_corrupt_documents(spark, ingest):
    _write(ingest.source, 1, "{bad")
    ingest.run()
    assert ingest.batches == [{"documents": 1, "corrupt": 1, "measures": 0}]
    _write(ingest.source, 2, DOCUMENTS[0])
    ingest.run()
    assert len(ingest.current()) == 2


def test_restart_resumes_and_late_data_enters(spark, ingest):
    for number, text in enumerate(DOCUMENTS[1:], start=2):
        _write(ingest.source, number, text)
    ingest.run(2)
    before = len(ingest.batches)
    _write(ingest.source, 7, DOCUMENTS[0])  # day 1 comes last
    ingest.run(2)
    assert len(ingest.batches) == before + 1
    numbered = [*enumerate(DOCUMENTS[1:], start=2), (7, DOCUMENTS[0])]
    assert ingest.current() == _batch_result(spark, numbered)


def test_restart_after_a_failed_batch(spark, ingest):
    for number, text in enumerate(DOCUMENTS, start=1):
        _write(ingest.source, number, text)

    def fail_on_second(batch_id, totals):
        if batch_id == 1:
            raise RuntimeError("lost after both writes")

    with pytest.raises(Exception, match="lost after both writes"):
        run_available(
            stream_landing_text(spark, ingest.source, 2),
            f"{ingest.root}/raw",
            f"{ingest.root}/tally",
            f"{ingest.root}/checkpoint",
            on_batch=fail_on_second,
        )
    ingest.run(2)
    assert read_raw(spark, f"{ingest.root}/raw").count() == 18 + 6
    assert ingest.current() == _batch_result(spark, DOCUMENTS)


def test_window_published_again_wins_and_leaves_a_stale_group(spark, ingest):
    _write(ingest.source, 1, document(feature("a", T0, "Old, S")))
    ingest.run()
    root = ingest.root
    refresh_hour_counts(spark, f"{root}/v1", log=f"{root}/raw")
    _write(ingest.source, 9, document(feature("a", T0, "New, S")))
    ingest.run()
    assert [row[8] for row in ingest.current()] == ["New"]
    refresh_hour_counts(spark, f"{root}/v2", log=f"{root}/raw", previous=f"{root}/v1")
    cities = rows_of(read_view(spark, f"{root}/v2", HOUR_COUNT_SCHEMA), "city")
    assert cities == [("New",), ("Old",)]


def test_landing_table_as_source(spark, ingest):
    docs = landing(spark, *DOCUMENTS)
    land(docs.repartition(3), ingest.source)
    assert rows_of(read_landing(spark, ingest.source)) == rows_of(docs)
    ingest.run(source=stream_landing(spark, ingest.source, 1))
    assert len(ingest.batches) == 3
    assert ingest.current() == _batch_result(spark, DOCUMENTS)


def test_landed_text_round_trip(spark, tmp_path):
    docs = landing(spark, *DOCUMENTS)
    land_text(docs, str(tmp_path / "landed"))
    landed = read_landing_text(spark, str(tmp_path / "landed"))
    # Spark ends a written text with a line break; the document is the same.
    assert rows_of(landed.selectExpr("doc_seq", "trim(TRAILING '\\n' FROM value)")) == rows_of(docs)
    _write(str(tmp_path / "files"), 42, "line one\nline two")
    assert rows_of(read_landing_text(spark, str(tmp_path / "files"))) == [
        (42, "line one\nline two")
    ]


def test_processing_time_trigger(spark, ingest):
    _write(ingest.source, 1, DOCUMENTS[0])
    query = start_ingest(
        stream_landing_text(spark, ingest.source),
        f"{ingest.root}/raw",
        f"{ingest.root}/tally",
        f"{ingest.root}/checkpoint",
    )
    try:
        query.processAllAvailable()
        _write(ingest.source, 2, DOCUMENTS[1])
        query.processAllAvailable()
    finally:
        query.stop()
    assert ingest.current() == _batch_result(spark, DOCUMENTS[:2])


def test_without_tallies(spark, ingest):
    _write(ingest.source, 1, DOCUMENTS[0])
    totals = []
    run_available(
        stream_landing_text(spark, ingest.source),
        f"{ingest.root}/raw",
        None,
        f"{ingest.root}/checkpoint",
        on_batch=lambda batch_id, batch: totals.append(batch),
    )
    assert totals == [{"documents": 1, "corrupt": 0, "measures": 3}]
    assert ingest.current() == _batch_result(spark, DOCUMENTS[:1])


def test_messages_have_no_key_unless_given(spark):
    docs = landing(spark, "x")
    assert rows_of(to_messages(docs)) == [(None, "x")]
    assert to_messages(docs).schema.names == ["key", "value"]


@pytest.mark.parametrize("use", ["read", "stream", "write"])
def test_topic_adapters_ask_for_the_kafka_source(spark, use):
    calls = {
        "read": lambda: read_topic(spark, "broker:9092", "events"),
        "stream": lambda: stream_topic(spark, "broker:9092", "events", 100),
        "write": lambda: publish_to_topic(to_messages(landing(spark, "x")), "broker:9092", "t"),
    }
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        calls[use]()


def test_topic_records_keep_their_order(spark):
    records = spark.createDataFrame(
        [(0, 1, bytearray(b"b")), (0, 0, bytearray(b"a")), (3, 0, bytearray(b"c"))],
        "partition INT, offset BIGINT, value BINARY",
    )
    documents = documents_from_records(records)
    assert documents.schema.simpleString() == spark.createDataFrame(
        [], LANDING_SCHEMA
    ).schema.simpleString()
    assert [r.value for r in documents.orderBy("doc_seq").collect()] == ["a", "c", "b"]


def test_records_carry_their_window_and_number(spark):
    sent = landing(spark, (7, "x"), (9, "y")).selectExpr("*", "TIMESTAMP_NTZ '2010-04-02 00:00:00' AS window_start")
    messages = to_messages(sent)
    assert messages.schema.names == ["key", "value", "headers"]
    assert {r.key for r in messages.collect()} == {"2010-04-02 00:00:00"}
    assert {r.key for r in to_messages(sent, F.lit("k")).collect()} == {"k"}
    records = messages.selectExpr("CAST(value AS BINARY) AS value", "0 AS partition", "100L AS offset", "headers")
    back = documents_from_records(records)
    assert back.columns == ["doc_seq", "value", "window_start"]
    assert rows_of(back) == rows_of(sent)


def test_records_with_odd_headers(spark):
    none, both = None, [("doc_seq", b"x"), ("window_start", b"never"), ("other", b"1")]
    twice = [("doc_seq", b"4"), ("doc_seq", b"5"), ("window_start", None)]
    records = spark.createDataFrame(
        [(b"a", 1, 2, none), (b"b", 1, 3, both), (b"c", 1, 4, twice), (b"d", 1, 5, [])],
        "value BINARY, partition INT, offset BIGINT, headers ARRAY<STRUCT<key: STRING, value: BINARY>>",
    )
    numbers = {r.value: (r.doc_seq, r.window_start) for r in documents_from_records(records).collect()}
    assert numbers == {"a": ((2 << 16) | 1, None), "b": ((3 << 16) | 1, None), "c": (5, None), "d": ((5 << 16) | 1, None)}


def test_streamed_messages_ask_for_the_kafka_sink(spark, tmp_path):
    stream = spark.readStream.schema(LANDING_SCHEMA).parquet(str(tmp_path))
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish_stream_to_topic(to_messages(stream), "broker:9092", "t", str(tmp_path / "c"))


def test_files_without_a_number_have_a_defined_winner(spark, tmp_path):
    texts = [document(feature(n, T0, f"{n}, S")) for n in ("a", "b")]
    winners = set()
    for order in (texts, texts[::-1]):
        for k, text in enumerate([*order, document(feature("n", T0 + HOUR))]):
            folder = tmp_path / f"{order is texts}"
            os.makedirs(folder, exist_ok=True)
            (folder / (f"{'xy'[k]}.json" if k < 2 else "000001.json")).write_text(text)
        docs = read_landing_text(spark, str(folder))
        assert rows_of(without_number(docs), "value") == sorted((t,) for t in texts)
        raw = latest_by_key(normalize_features(explode_features(decode_documents(docs))))
        winners.add(tuple(rows_of(raw, "id")))
    assert len(winners) == 1
    one = docs.where("doc_seq < 0").unionByName(landing(spark, (0, document(feature("late", T0)))))
    assert rows_of(latest_by_key(normalize_features(explode_features(decode_documents(one)))), "id") == [("late",)]


def test_tally_matches_the_documents(spark, ingest):
    for number, text in enumerate(DOCUMENTS, start=1):
        _write(ingest.source, number, text)
    ingest.run()
    want = document_counts(decode_documents(landing(spark, *DOCUMENTS)))
    assert rows_of(ingest.tallies()) == rows_of(want)
