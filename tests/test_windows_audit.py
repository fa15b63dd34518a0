"""Window plan, pending windows and the audit."""

from datetime import datetime

from helpers import document, feature, landing, rows_of
from tremorline.operators.audit import done_windows, ingest_audit, publications
from tremorline.operators.documents import decode_documents, document_counts
from tremorline.operators.windows import FEED_START, pending_windows, plan_windows
from tremorline.schemas import PUBLICATION_SCHEMA


def _plan(spark, stop, start=FEED_START):
    return plan_windows(spark.sql(f"SELECT '{start}' AS start, '{stop}' AS stop"))


def test_plan(spark):
    plan = _plan(spark, "2010-04-02 12:00:00")
    assert rows_of(plan) == [
        (
            datetime(2010, 4, 1),
            datetime(2010, 4, 1, 23, 59, 59),
            datetime(2010, 4, 2),
            "2010-04-01 00:00:00",
            "2010-04-01 23:59:59",
        ),
        (
            datetime(2010, 4, 2),
            datetime(2010, 4, 2, 23, 59, 59),
            datetime(2010, 4, 3),
            "2010-04-02 00:00:00",
            "2010-04-02 23:59:59",
        ),
    ]


def test_plan_across_clock_changes(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = [r[0] for r in _plan(spark, "2010-11-30").select("start_text").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(texts) == 244 and all(t.endswith(" 00:00:00") for t in texts)


def test_pending(spark):
    plan = _plan(spark, "2010-04-03")
    done = plan.where("start_text LIKE '2010-04-02%'")
    left = [r[0] for r in pending_windows(plan, done).select("start_text").collect()]
    assert sorted(left) == ["2010-04-01 00:00:00", "2010-04-03 00:00:00"]


def _published(spark, *rows):
    return spark.createDataFrame(
        [(datetime(2010, 4, day), number, count) for day, number, count in rows],
        PUBLICATION_SCHEMA,
    )


def _audit(spark, published, *documents):
    tallies = document_counts(decode_documents(landing(spark, *documents)))
    audit = ingest_audit(published, tallies).orderBy("window_start")
    return [(r.window_start.day, *tuple(r)[1:]) for r in audit.collect()]


def test_audit_of_clean_data_with_a_replay(spark):
    two, one = document(feature("a"), feature("b")), document(feature("c"))
    published = _published(spark, (1, 1, 2), (2, 2, 1))
    got = _audit(spark, published, (1, two), (2, one), (1, two))
    assert got == [(1, 2, 2, 2, 2, 0), (2, 1, 1, 3, 3, 0)]


def test_audit_shows_lost_corrupt_and_repeated_attempts(spark):
    one = document(feature("c"))
    # Window 1 lost, window 2 corrupt, window 3 published twice (two attempts count).
    published = _published(spark, (1, 1, 2), (2, 2, 4), (3, 3, 1), (3, 4, 1))
    got = _audit(spark, published, (2, "{bad"), (4, one))
    assert got == [(1, 2, 0, 2, 0, 2), (2, 4, 0, 6, 0, 6), (3, 2, 1, 8, 1, 7)]


def test_publications_read_the_announced_count(spark):
    docs = landing(spark, document(feature("a"), count=5), '{"metadata":{}}', "{bad")
    sent = docs.selectExpr("TIMESTAMP_NTZ '2010-04-01 00:00:00' AS window_start", "*")
    got = publications(sent)
    assert rows_of(got, "doc_seq", "published_count") == [(1, 5), (2, 0), (3, 0)]
    assert got.columns == [field.split()[0] for field in PUBLICATION_SCHEMA.split(", ")]


def _done(spark, published, *documents):
    tallies = document_counts(decode_documents(landing(spark, *documents)))
    return sorted(r[0].day for r in done_windows(published, tallies).collect())


def test_windows_are_done_when_every_document_is_whole(spark):
    one = document(feature("c"))
    half = document(feature("a"), None)
    published = _published(spark, (1, 1, 1), (1, 2, 1), (2, 3, 1), (2, 4, 1), (3, 5, 2), (4, 6, 1), (5, 7, 0))
    # Window 2 lost a document, 3 is half readable, 4 corrupt, 5 empty; 1 was replayed.
    got = _done(spark, published, (1, one), (1, one), (2, one), (3, one), (5, half), (6, "{bad"), (7, document()))
    assert got == [1, 5]


def test_a_window_sent_again_is_done(spark):
    one = document(feature("c"))
    attempts = spark.createDataFrame(
        [(datetime(2010, 4, 1), 1, 1, 1), (datetime(2010, 4, 1), 2, 1, 2), (datetime(2010, 4, 2), 3, 1, 1), (datetime(2010, 4, 2), 4, 1, 2)],
        PUBLICATION_SCHEMA + ", attempt INT",
    )
    assert _done(spark, attempts, (1, "{bad"), (2, one), (3, one), (4, "{bad")) == [1]
    assert _done(spark, attempts.drop("attempt"), (1, "{bad"), (2, one), (3, one), (4, one)) == [2]


def test_documents_nobody_noted_stand_in_the_window_they_carry(spark):
    docs = landing(spark, (1, document(feature("a"))), (2, document(feature("b"), feature("c"))), (3, document(feature("d"))))
    carried = docs.selectExpr("*", "IF(doc_seq = 3, NULL, TIMESTAMP_NTZ '2010-04-01 00:00:00' + make_dt_interval(doc_seq)) AS window_start")
    audit = ingest_audit(_published(spark, (2, 1, 1)), document_counts(decode_documents(carried))).collect()
    got = [(r.window_start and r.window_start.day, r.published_count, r.processed_rows) for r in audit]
    assert sorted(got, key=repr) == sorted([(2, 1, 1), (3, 0, 2), (None, 0, 1)], key=repr)
