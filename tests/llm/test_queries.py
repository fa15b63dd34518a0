"""Registered queries against SQL or brute force on the smallest tables."""

import collections
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tremorline.llm.oracles import ORACLES
from tremorline.llm.queries import QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def _documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = contract.queries()[name](spark, SMALL)
    relation = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(relation.columns)
    assert _rows(result.columns, result.collect()) == _rows(relation.columns, relation.fetchall())


def test_jaccard_equals_brute_force(spark):
    sets = {}
    for i, text in _documents():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
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
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op9_ngram_jaccard"](spark, SMALL).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in sets}


def test_lines_equal_brute_force(spark):
    rows = QUERIES["op2_fuzzy_lines"](spark, SMALL).collect()
    lines, order = {}, {}
    for i, text in sorted(_documents()):
        for n, raw in enumerate(text.lower().split("\n") if text is not None else []):
            line = re.sub(r"[\x20\x09-\x0D]+", " ", raw).strip(" ")
            lines[i, n] = line
            if line:
                order.setdefault(line, (i, n))
    table = spark.createDataFrame([(i, n, t, len(t)) for t, (i, n) in order.items()], "i BIGINT, n INT, t STRING, size INT").repartition(8)
    counts = [f"abs(length(replace(x.t, '{c}', '')) - x.size - length(replace(y.t, '{c}', '')) + y.size)" for c in "etaonisrhldu"]
    near = table.alias("x").join(
        table.alias("y"),
        F.expr(
            "(x.i < y.i OR x.i = y.i AND x.n < y.n) AND 5 * abs(x.size - y.size) <= greatest(x.size, y.size)"
            # An edit changes two letter counts at most.
            f" AND 5 * ({' + '.join(counts)}) <= 2 * greatest(x.size, y.size)"
            " AND levenshtein(x.t, y.t, CAST(greatest(x.size, y.size) div 5 AS INT)) >= 0"
        ),
    ).selectExpr("x.i", "x.n", "y.i", "y.n").collect()
    parent = {at: at for at in order.values()}

    def root(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i, n, j, m in near:
        x, y = root((i, n)), root((j, m))
        parent[max(x, y)] = min(x, y)
    wanted = {at: root(order[line]) if line else at for at, line in lines.items()}
    assert len(near) > 20 and {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in rows} == wanted


def test_token_files_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op10_token_files"](spark, SMALL).collect()}
    start, want = 0, {}
    for i, text in sorted(_documents()):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want


def test_language_model_counts_and_base(spark):
    got = {r.doc_id: r for r in QUERIES["op7_lm_scoring"](spark, SMALL).collect()}
    tokens = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [None] for i, t in _documents()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = collections.Counter(w for i in tokens if not held[i] for w in tokens[i])
    total = sum(counts.values())
    size = math.log10(total + 0.5 * (len(counts) + 1))
    for i, words in tokens.items():
        row = got[i]
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held[i], len(words), total)
        assert row.n_known == sum(counts[w] > 0 for w in words)
        assert row.base_score == pytest.approx(sum(math.log10(counts[w] + 0.5) - size for w in words))
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_language_accuracy_on_held_out_rows(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SMALL}/documents.parquet'").fetchall())
    rows = [r for r in QUERIES["op5_language_id"](spark, SMALL).collect() if r.held_out]
    assert sum(labels[r.doc_id] == r.lang_pred for r in rows) >= 0.95 * len(rows)
