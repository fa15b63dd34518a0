"""Decoding, counting and exploding documents."""

import json

import pytest
from helpers import T0, document, feature, landing
from tremorline.operators.documents import decode_documents, document_counts, explode_features, rejects
from tremorline.operators.normalize import normalize_features
from tremorline.schemas import FEATURE_LEAVES, REJECT_SCHEMA


def _counts(spark, *documents):
    counted = document_counts(decode_documents(landing(spark, *documents))).drop("bad_leaves", "window_start")
    return [tuple(r) for r in counted.orderBy("doc_seq").collect()]


def test_counts(spark):
    broken_entry = (
        '{"features":[{"id":"z","properties":{"time":null,"mag":null,"tsunami":7},'
        '"geometry":{"coordinates":[1.5]}},null]}'
    )
    got = _counts(
        spark,
        document(feature("a"), feature("b")),
        "{bad",
        '{"metadata":{"count":0},"features":[]}',
        '{"metadata":{}}',
        "{}",
        broken_entry,
        document(feature("a"), count=7),
        '{"metadata":{"count":"x"},"features":[]}',
        None,
        document(feature("far", time=2**62), feature("near")),
    )
    assert got == [
        (1, 2, 2, 0, False),
        (2, 0, 0, 0, True),
        (3, 0, 0, 0, False),
        (4, 0, 0, 0, False),
        (5, 0, 0, 0, False),
        (6, 0, 1, 1, False),
        (7, 7, 1, 0, False),
        (8, 0, 0, 0, False),
        (9, 0, 0, 0, True),
        (10, 2, 1, 1, False),
    ]


def test_corrupt_document_beside_good_ones(spark):
    docs = landing(spark, "{bad", document(feature("a")), document(feature("b"))[:-1])
    features = explode_features(decode_documents(docs)).collect()
    assert [(r.id, r._doc_seq) for r in features] == [("a", 2)]


def test_integers_where_doubles_are_expected(spark):
    docs = landing(spark, document(feature("a", mag=5, coordinates=(1, 2, 3))))
    row = explode_features(decode_documents(docs)).first()
    assert (row.mag, row.coordinates) == (5.0, [1.0, 2.0, 3.0])


def test_explode_positions_and_names(spark):
    docs = landing(spark, (9, document(feature("a"), None, feature("b"))), (8, document()))
    exploded = explode_features(decode_documents(docs))
    assert exploded.columns == [*FEATURE_LEAVES, "_doc_seq", "_position"]
    got = [(r.id, r._doc_seq, r._position) for r in exploded.orderBy("_position").collect()]
    assert got == [("a", 9, 0), ("b", 9, 2)]


def test_rejected_rows_are_the_ones_missing_downstream(spark):
    docs = landing(
        spark, document(feature("far", time=-(2**62)), None, feature("a"), feature("b", time=None))
    )
    decoded = decode_documents(docs)
    counted = document_counts(decoded).first()
    raw = normalize_features(explode_features(decoded))
    assert (counted.feature_rows, counted.rejected) == (2, 2)
    assert raw.count() == counted.feature_rows


def test_carried_columns_stay(spark):
    docs = landing(spark, document(feature("a", time=T0))).selectExpr("*", "'w' AS window")
    assert decode_documents(docs).columns == ["doc_seq", "window", "count", "features", "is_corrupt"]


def test_one_bad_leaf_costs_only_itself(spark):
    good = [feature(f"g{i}") for i in range(100)]
    docs = landing(spark, document(*good, feature("bad", sig="x", mag="y")), document(feature("a"), count="1"))
    rows = {r.id: r for r in explode_features(decode_documents(docs)).collect()}
    assert len(rows) == 102
    assert (rows["bad"].sig, rows["bad"].mag, rows["bad"].place) == (None, None, rows["g0"].place)
    assert [r[1] for r in _counts(spark, document(feature("a"), count="1"), document(feature("a"), count=1.0))] == [1, 1]


def test_text_behind_the_document_marks_it(spark):
    one = document(feature("a"))
    assert [r[4] for r in _counts(spark, one + " \n", one + " x", one + one, "[]", "5")] == [False, True, True, True, True]


def _with(feature_, **properties):
    return {**feature_, "properties": {**feature_["properties"], **properties}}


def _rejects(spark, *documents):
    found = rejects(decode_documents(landing(spark, *documents)))
    assert found.schema.simpleString() == spark.createDataFrame([], REJECT_SCHEMA).schema.simpleString()
    return sorted((tuple(r)[:4] for r in found.collect()), key=repr)


def test_entries_that_are_no_objects_cost_only_themselves(spark):
    good = feature("g")
    docs = [json.dumps({"metadata": {"count": 6}, "features": [good, 5, "x", [good], True, None]}), document(feature("h"))]
    assert [r.id for r in explode_features(decode_documents(landing(spark, *docs))).collect()] == ["g", "h"]
    assert _counts(spark, *docs) == [(1, 6, 1, 5, False), (2, 1, 1, 0, False)]
    assert _rejects(spark, *docs) == [
        (1, 1, None, "not an object"), (1, 2, None, "not an object"), (1, 3, None, "not an object"),
        (1, 4, None, "not an object"), (1, 5, None, "a null entry"),
    ]


@pytest.mark.parametrize("features", [feature("g"), "x", 5, True])
def test_features_that_are_no_array_mark_the_document(spark, features):
    docs = [json.dumps({"metadata": {"count": 1}, "features": features})]
    assert _counts(spark, *docs) == [(1, 0, 0, 0, True)]
    assert _rejects(spark, *docs) == [(1, None, None, "not one whole document")]


def test_metadata_of_any_kind(spark):
    docs = [json.dumps({"metadata": m, "features": [feature("a")]}) for m in (7, None, [], {"count": 1.5}, {"count": 2.0}, {"count": "3"})]
    assert [r[1:3] for r in _counts(spark, *docs)] == [(0, 1), (0, 1), (0, 1), (0, 1), (2, 1), (3, 1)]


@pytest.mark.parametrize(
    ("leaf", "text", "value"),
    [
        ("sig", "1.5", None), ("sig", "1.0", 1), ("sig", "2e1", 20), ("sig", "2147483648", 2**31), ("sig", "-2147483648", -(2**31)),
        ("sig", "0.0000001", None), ("sig", "[1]", None), ("sig", '"7"', 7), ("tsunami", "0.5", None), ("tsunami", "true", None),
        ("mag", '"NaN"', None), ("mag", '"Infinity"', None), ("mag", '"1d"', None), ("mag", '"0x1p3"', None), ("mag", "7e0", 7.0), ("mag", "1e400", None), ("mag", "1e-3", 0.001),
        ("mag", "{}", None), ("mag", "-0.5", -0.5), ("time", "1270080000000.5", None), ("time", "1270080000000.0", T0),
    ],
)
def test_numbers_of_the_wrong_kind_are_null_and_counted(spark, leaf, text, value):
    doc = document(_with(feature("a"), **{leaf: "@"}), feature("b")).replace('"@"', text)
    rows = {r.id: r for r in explode_features(decode_documents(landing(spark, doc))).collect()}
    assert rows["a"][leaf] == value and set(rows) == {"a", "b"} and rows["a"].place == rows["b"].place
    bad = document_counts(decode_documents(landing(spark, doc))).first().bad_leaves
    found = [r[1:3] for r in _rejects(spark, doc)]
    assert (bad, found) == ((1, [(0, leaf)]) if value in (None, 2**31) else (0, []))
    raw = {r.id: r for r in normalize_features(explode_features(decode_documents(landing(spark, doc)))).collect()}
    if leaf == "sig":
        assert raw["a"].significant_level == (None if value == 2**31 else value or 0)


def test_members_of_the_wrong_kind(spark):
    one = feature("a")
    docs = [
        document({**one, "properties": 5}), document({**one, "geometry": []}), document({**one, "geometry": {"coordinates": {}}}),
        document(feature("a", coordinates=(1, "x", None, "NaN"))),
    ]
    rows = explode_features(decode_documents(landing(spark, *docs))).collect()
    assert [r.id for r in rows] == ["a"] * 4
    assert [r.coordinates for r in sorted(rows, key=lambda r: r._doc_seq)][3] == [1.0, None, None, None]
    counts = document_counts(decode_documents(landing(spark, *docs))).orderBy("doc_seq").collect()
    assert [(r.feature_rows, r.rejected, r.bad_leaves) for r in counts] == [(1, 0, 1)] * 4
    wrong = "a member of the wrong kind"
    assert _rejects(spark, *docs) == [(1, 0, None, wrong), (2, 0, None, wrong), (3, 0, None, wrong), (4, 0, "coordinates", "not finite numbers")]


def test_no_text_around_a_document_hides_a_second_one(spark):
    one = document(feature("a"))
    around = [f'{one},"e":{one}', f"{one},{one}", f"{one}],[{one}", f'{one},{{"end":"1"}}],[{one}', f"{one}]", f"{one}}}", f',{one}', f"[{one}]", ""]
    assert [r[1:] for r in _counts(spark, *around)] == [(0, 0, 0, True)] * len(around)
    assert len(_rejects(spark, *around)) == len(around)


def test_documents_that_share_a_number_are_counted_apart(spark):
    docs = [(3, document(feature("a"))), (3, document(feature("b"), feature("c"))), (None, document())]
    counted = document_counts(decode_documents(landing(spark, *docs)))
    assert sorted((r.doc_seq or 0, r.feature_rows) for r in counted.collect()) == [(0, 0), (3, 1), (3, 2)]
