"""The stages, one after the other, against plain Python on the smallest tables."""

import collections
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tremorline.llm.common import without
from tremorline.llm.decontaminate import LEAST_SCORE
from tremorline.llm.jaccard_join import one_of_each_group
from tremorline.llm.oracles import ORACLES
from tremorline.llm.queries import tokenizer_path

SMALL = "/root/testdata/sf0.001"


def _words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def _near_copies(texts):
    """Ids that are not the least of their group."""
    sets = {}
    for i, text in texts.items():
        w = _words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i for i in sets if root(i) != i}


def _best_alignment(item, text):
    """Smith-Waterman over words, match 2, mismatch and gap -1, by its definition."""
    rows = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, w in enumerate(item, 1):
        same = np.array([2 if w == v else -1 for v in text], int)
        for j in range(1, len(text) + 1):
            rows[i, j] = max(0, rows[i - 1, j - 1] + same[j - 1], rows[i - 1, j] - 1, rows[i, j - 1] - 1)
    return rows.max()


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage got, and those that the last one gave."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = []
    for _, stage in corpus_pipeline.STAGES:
        given.append((docs.schema, docs.collect()))
        docs = stage(spark, spark.createDataFrame(given[-1][1], given[-1][0]), SMALL)
    return [rows for _, rows in given], docs.collect()


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages[0][0], stages[0][1]
    lettered = {r.doc_id for r in before if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in after} == lettered and len(after) == len(lettered)


def test_one_document_of_each_group_stays(stages):
    before, after = stages[0][1], stages[0][2]
    copies = _near_copies({r.doc_id: r.text for r in before})
    assert copies and sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in copies)


def test_documents_with_benchmark_passages_go(stages):
    before, after = stages[0][2], stages[0][3]
    def words_of(text):
        spelt = (text or "").lower().encode()
        return bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in spelt).split()

    items = [words_of(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SMALL}/benchmark.parquet'").fetchall()]
    bad = set()
    for r in before:
        words = words_of(r.text)
        at = collections.Counter(words)
        for item in items:
            # Without half of the item's words no alignment scores half.
            if len(item) >= 3 and sum(w in at for w in item) >= LEAST_SCORE * len(item):
                if _best_alignment(item, words) >= LEAST_SCORE * 2 * len(item):
                    bad.add(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in bad)


def test_mix_repeats_documents_as_often_as_its_sql_takes_them(stages):
    before, after = stages[0][3], stages[0][4]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r.doc_id, r.text, r.source) for r in before])
    taken = {r[0]: (r[4], r[1]) for r in duck.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLES['op8_source_mix']})").fetchall()}
    wanted = {i: int(t / max(1, size) + 0.5) for i, (t, size) in taken.items()}
    assert collections.Counter(r.doc_id for r in after) == collections.Counter({i: n for i, n in wanted.items() if n})
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_token_files_hold_the_mix(stages):
    from tokenizers import Tokenizer

    before, after = stages[0][4], stages[1]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for r in sorted(before, key=lambda r: r.doc_id):
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in after) == sorted(want)


def test_rows_that_repeat_an_id_stay_once(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x"), (3, "y"), (None, "z"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted((r.doc_id or 0 for r in one_of_each_group(docs).collect()))
    assert got == [0, 0, 1, 3]


def test_rows_without_given_ids(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, f"t{i}") for i in range(50)], "`id` INT, text STRING")
    gone = spark.createDataFrame([(i,) for i in (1, 2, 2, 49, 999)], "doc BIGINT")
    kept = without(rows, gone, "id").collect()
    assert sorted(r.text for r in kept) == sorted(f"t{i}" for i in range(50) if i not in (1, 2))
    assert without(rows, gone.limit(0), "id").count() == 50
