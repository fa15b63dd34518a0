"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import re
import time

import numpy as np
import pytest

import corpus_pipeline
from tremorline.llm import fuzzy_lines, language_ppm, simple8b, suffix_tree_lm, token_files
from tremorline.llm.content_sort import drop_exact_copies
from tremorline.llm.decontaminate import contaminated_passages
from tremorline.llm.fuzzy_lines import fuzzy_line_groups
from tremorline.llm.jaccard_join import jaccard_components
from tremorline.llm.mixing import mix, mixed_documents
from tremorline.llm.queries import tokenizer_path
from tremorline.llm.token_files import token_index
from tremorline.llm.url_rules import judge_urls
from tremorline.llm.warc import chunk_table, payload_index, read_warc, warc_records, write_warc
from tremorline.session import scratch_path

WORDS = [f"{a}{b}x" for a in ("ka", "lo", "mi", "nu", "te") for b in ("ra", "si", "to", "vu", "we", "po", "da", "gi")]
LONG = " ".join(WORDS * 600)
SHAPE = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, size BIGINT, score DOUBLE, kept STRING"
ROWS = [
    (1, " ".join(WORDS)), (2, " ".join(WORDS)), (2, " ".join(WORDS)), (3, " ".join(WORDS[:39]) + " other"),
    (4, None), (5, ""), (6, " \n\t "), (7, LONG), (8, "one"), (9, "one"), (None, "one"), (10, "12 34"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i != 9 else None, "a" if i and i < 6 else None, 0, 7, 0.5, "k") for i, t in ROWS]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, " ".join(WORDS[5:35])), (2, None), (None, "a b c d"), (3, "a b")], "item_id BIGINT, text STRING")


def _by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=lambda r: (r[0] is None, r))


def test_exact_copies(docs):
    got = _by_id(drop_exact_copies(docs), "keep_id", "group_size", "kept")
    assert sorted(r[3] for r in got if r[0] == 2) == [False, False]
    assert [r[1:] for r in got if r[0] in (1, 5, 8)] == [(1, 3, True), (4, 2, False), (8, 3, True)]
    assert got[-1] == (None, 8, 3, False)
    assert drop_exact_copies(docs.limit(0)).count() == 0


def test_mix(docs):
    got = mix(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 3 * r.size for r in got)
    for source in ("a", None):
        rows = [r for r in got if r.source == source]
        assert sum(r.taken for r in rows) == int(rows[0].target)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.where("size <> 7").count() == 0
    assert mix(docs.limit(0)).count() == 0


def test_jaccard(docs):
    got = {(r[0], r[1], r[2]) for r in _by_id(jaccard_components(docs), "n_shingles", "component_id")}
    assert {(1, 36, 1), (2, 36, 1), (3, 36, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (8, 1, 8), (9, 1, 8), (None, 1, None)} <= got
    assert jaccard_components(docs.limit(0)).count() == 0


def test_decontamination_finds_edited_copies(spark, docs, items):
    edited = [w if k % 6 else "changed" for k, w in enumerate(WORDS[5:35])]
    more = docs.select("doc_id", "text").union(
        spark.createDataFrame([(20, "x y z " + " ".join(edited).upper() + ". end")], "doc_id BIGINT, text STRING")
    )
    got = {(r.doc_id, r.item_id): r.score for r in contaminated_passages(more, items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 1), (7, 1), (20, 1)}
    assert got[1, 1] == 1.0 and 0.6 < got[20, 1] < 0.9
    assert contaminated_passages(docs, items.limit(0)).count() == 0
    assert contaminated_passages(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("copies", [0, 1, 5])
def test_decontamination_finds_edits_beside_exact_copies(spark, copies):
    words = [f"{w}{k}" for k in range(3) for w in WORDS]
    items = spark.createDataFrame([(k, " ".join(words[40 * k : 40 * k + 40])) for k in range(3)], "item_id BIGINT, text STRING")
    rows = [(100 * k + c, " ".join(words[40 * k : 40 * k + 40])) for k in range(3) for c in range(copies)]
    # Frequent n-grams of each item, which its copies do not explain.
    rows += [(1000 + c, f"{c} " + " ".join(words[40 * k : 40 * k + 7])) for k in range(3) for c in range(200)]
    edits = [(k, every, first) for k, every in enumerate((4, 5, 6)) for first in range(every)]
    for n, (k, every, first) in enumerate(edits):
        edited = [f"new{j}" if j % every == first else w for j, w in enumerate(words[40 * k : 40 * k + 40])]
        rows.append((2000 + n, "x y " + " ".join(edited) + " z"))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    # With the first document of edits alone, too: most n-grams of its item occur nowhere.
    for some in (docs, docs.where("doc_id < 2001"), docs.where("doc_id < 1000 OR doc_id = 2004")):
        got = {(r.doc_id, r.item_id) for r in contaminated_passages(some, items).collect()}
        ids = {r.doc_id for r in some.select("doc_id").collect()}
        wanted = {(2000 + n, k) for n, (k, *_) in enumerate(edits)} | {(100 * k + c, k) for k in range(3) for c in range(copies)}
        assert got == {pair for pair in wanted if pair[0] in ids}


def test_languages(docs):
    got = _by_id(language_ppm.identify(docs, language_ppm.train(docs)), "lang_pred", "score")
    assert {r[0]: r[1] for r in got}[4] == "und" and {r[0]: r[1] for r in got}[10] == "und"
    assert {r[0]: r[1] for r in got}[7] == "en"
    untrained = language_ppm.identify(docs, language_ppm.train(docs.limit(0)))
    assert {(r[1], r[2]) for r in _by_id(untrained, "lang_pred", "score")} == {("und", 0.0)}


def test_noise_and_unlearned_languages_are_rejected(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = np.random.default_rng(4)
    alien = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz ;/.,"), n)) for n in (30, 60, 300, 2000) for _ in range(5)]
    alien += [
        "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "Alla människor är födda fria och lika i värde och rättigheter.", "12 34", "", None,
    ]
    more = spark.createDataFrame([(-1 - i, t, None, None, 0) for i, t in enumerate(alien)], documents.schema)
    kept = {r.doc_id for r in language_ppm.readable_documents(documents.union(more)).select("doc_id").collect()}
    lettered = {r.doc_id for r in documents.where(r"text RLIKE '\\p{L}'").select("doc_id").collect()}
    assert kept == lettered and len(lettered) > 900


def test_languages_beyond_the_bounds_are_not_learned(spark):
    rows = [(i, f"{'abcde'[i % 5] * 3} " * 9, f"l{i % 5}") for i in range(200)] + [(0, "aaa " * 9, "l0")] * 50
    labelled = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    assert language_ppm.train(labelled).languages == [f"l{k}" for k in range(5)]
    assert language_ppm.train(labelled, most_languages=2).languages == ["l0", "l1"]
    few = language_ppm.train(labelled, documents_per_language=20)
    assert len(few.languages) == 5


def test_scores(docs):
    model = suffix_tree_lm.train(docs)
    full = _by_id(suffix_tree_lm.score(docs, model), "n_tokens", "n_known", "base_score")
    joined = _by_id(suffix_tree_lm.score(docs, model, head_words=1, head_pairs=3), "n_tokens", "n_known", "base_score")
    assert [r[:3] for r in full] == [r[:3] for r in joined]
    assert [r[3] for r in full] == pytest.approx([r[3] for r in joined])
    assert {r[0]: r[1] for r in full}[4] == 1
    empty = suffix_tree_lm.score(docs, suffix_tree_lm.train(docs.limit(0))).collect()
    assert all(r.n_known == 0 and abs(r.base_score) < 1e-6 for r in empty)


def _plain_tree(texts):
    """The model's log10 probability of texts, by dictionaries."""
    import collections
    import math

    lm = suffix_tree_lm
    words = [t.encode().translate(lm._A_TO_Z).split() for t in texts]
    counts = collections.Counter(w for t in words for w in [*t, None])
    total = sum(counts.values())
    own = {w for w, n in counts.items() if n >= max(1.0, total * lm._OWN_SYMBOL)}

    def tokens(text):
        """(word, symbol, the bytes before it, last first) of a text."""
        raw = b"\n" + b" ".join(text) + b"\n"
        out, at = [], 1
        for word in [*text, None]:
            before = raw[:at] if word is None else raw[: at - 1] if at > 1 else raw[:1]
            if word is None:
                before = raw[:-1]
            back = b""
            for byte in reversed(before[-lm.DEPTH :]):
                back += bytes([byte])
                if byte == 10:
                    break
            end = raw[:-1] if word is None else word
            tail = (b"\n" + (end if word is not None else b"\n" + b" ".join(text)))[-2:]
            if word is not None and len(word) == 1:
                tail = raw[at - 1 : at + 1]
            out.append((word, word if word in own else ("ending", tail), back.ljust(lm.DEPTH, b"\0")))
            at += len(word) + 1 if word is not None else 0
        return out

    def ending(tail):
        number = np.array([tail[1] | tail[0] << 8], np.uint64)
        return int(lm.mixed(number)[0] % np.uint64(lm._ENDINGS))

    def name(symbol):
        return ("ending", ending(symbol[1])) if isinstance(symbol, tuple) else symbol

    seen = [[(w, name(s), c) for w, s, c in tokens(t)] for t in words]
    flat = [x for t in seen for x in t]
    symbols = len(own) + lm._ENDINGS
    root = collections.Counter(s for _, s, _ in flat)
    mass = total + 0.5 * symbols
    by_ending = collections.defaultdict(lambda: 0.5)
    for w in counts:
        if w not in own:
            by_ending[next(s for v, s, _ in flat if v == w)] += counts[w] + 0.5
    pairs = [collections.defaultdict(collections.Counter) for _ in range(lm.DEPTH + 1)]
    for _, s, c in flat:
        for d in range(1, lm.DEPTH + 1):
            pairs[d][c[:d]][s] += 1
    kept = {}

    def probability(s, context, depth):
        if depth == 0:
            return (root[s] + 0.5) / mass
        short = probability(s, context, depth - 1)
        if context[:depth] not in kept:
            return short
        times, weight, bottom = kept[context[:depth]]
        return (times.get(s, 0) + weight * short) / bottom

    for d in range(1, lm.DEPTH + 1):
        new = {}
        for c, times in pairs[d].items():
            often = {s: n for s, n in times.items() if n >= lm._LEAST_PAIR}
            all_, prior = sum(times.values()), max(lm._PRIOR, len(often))
            weight = all_ - sum(often.values()) + prior
            gain = sum(n * math.log2((n + weight * (p := probability(s, c, d - 1))) / (all_ + prior) / p) for s, n in often.items())
            gain += (all_ - sum(often.values())) * math.log2(weight / (all_ + prior))
            if gain >= lm.LEAST_GAIN_BITS:
                new[c] = (often, weight, all_ + prior)
        kept |= new
    everything = set(root) | {("ending", e) for e in range(lm._ENDINGS)} | own
    sums = [sum(probability(s, c.ljust(lm.DEPTH, b"\0"), len(c)) for s in everything) for c in kept]

    def score(text):
        out = 0.0
        for w, s, c in [(w, name(s), c) for w, s, c in tokens(text.encode().translate(lm._A_TO_Z).split())]:
            p = probability(s, c, lm.DEPTH)
            out += math.log10(p if w in own else p * (counts.get(w, 0) + 0.5) / by_ending[s])
        return out

    return score, kept, sums


def test_scores_equal_a_plain_tree(spark):
    documents = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    some = spark.createDataFrame([(i, t) for i, t in documents if i % 3], "doc_id BIGINT, text STRING")
    score, kept, sums = _plain_tree([t for i, t in documents if i % 3])
    model = suffix_tree_lm.train(some)
    assert len(kept) == sum(map(len, model.states)) > 20
    assert sums == pytest.approx([1.0] * len(sums))
    docs = spark.createDataFrame(documents[:60], "doc_id BIGINT, text STRING")
    wanted = {i: score(t) for i, t in documents[:60]}
    for head in (suffix_tree_lm.HEAD_PAIRS, 500, 0):
        got = {r.doc_id: r.score for r in suffix_tree_lm.score(docs, model, head_pairs=head).collect()}
        assert got == pytest.approx(wanted, rel=1e-5)


def test_words_are_told_by_five_bytes_before_them(spark):
    rows = [(i, " ".join(["kabcd one", "zabcd two"] * 20)) for i in range(20)]
    model = suffix_tree_lm.train(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    asked = spark.createDataFrame([(1, "zabcd two"), (2, "zabcd one")], "doc_id BIGINT, text STRING")
    for head in (suffix_tree_lm.HEAD_PAIRS, 0):
        got = {r.doc_id: r.score for r in suffix_tree_lm.score(asked, model, head_pairs=head).collect()}
        assert got[1] > got[2] + 1


def test_what_is_kept_grows_with_the_corpus(spark):
    sizes = []
    for sf in ("0.001", "0.01"):
        model = suffix_tree_lm.train(spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet"))
        sizes.append((sum(map(len, model.states)), model.pairs.count()))
    assert sizes[1][0] > 1.5 * sizes[0][0] and sizes[1][1] > 2 * sizes[0][1]


def test_lines(spark):
    base = " ".join(f"{w}{k}" for k in range(4) for w in WORDS)
    near = base.replace("karax0", "karay0")
    rows = [(1, base + "\n\nother line"), (2, near + "\r\n" + base.upper()), (3, None), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no, r.kept) for r in fuzzy_line_groups(docs).collect()}
    assert got[1, 0] == (1, 0, True) and got[2, 1] == (1, 0, False) and got[1, 1] == (1, 1, True)
    assert got[2, 0][0] in (1, 2) and got[4, 0] == (4, 0, True) and (3, 0) not in got
    assert fuzzy_line_groups(docs.limit(0)).count() == 0


def test_lines_of_any_length_with_one_word_or_letter_changed(spark):
    rng = np.random.default_rng(3)
    rows = []
    for n in (2, 3, 5, 10, 20, 30, 50):
        for k in range(8):
            words = ["".join(rng.choice(list("abcdefghijklmnopqrst"), 6 + j % 3)) for j in range(n)]
            at = int(rng.integers(n))
            other = "".join(rng.choice(list("uvwxyz"), len(words[at])))
            if n < 6 or k % 2:
                other = words[at][:3] + "z" + words[at][4:]
            rows.append((len(rows), " ".join(words)))
            rows.append((len(rows), " ".join([*words[:at], other, *words[at + 1 :]])))
    rows += [(len(rows), "abcdefghij" * 12), (len(rows) + 1, "abcdefghij" * 6 + "z" + "abcdefghij" * 6)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.kept_doc_id for r in fuzzy_line_groups(docs).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_lines_of_140_and_175_characters(spark):
    start = "karax losix mitox nuvux tewex kapox"
    line = start + " " + " ".join(f"{a}{b}{c}qz" for a, b, c in zip("abcdefghijklmno", "xyzwvutsrqponml", "mlkjihgfedcbaxy")) + " 12345678901234"
    line = line[:139] + "y"
    longer = line + " " + start[1:]
    assert (len(line), len(longer)) == (140, 175)
    docs = spark.createDataFrame([(1, line), (2, longer)], "doc_id BIGINT, text STRING")
    got = {r.doc_id: r.kept_doc_id for r in fuzzy_line_groups(docs).collect()}
    assert got == {1: 1, 2: 1}


def _distance(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        row, above = [i], row
        for j, e in enumerate(y, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (c != e)))
    return row[-1]


@pytest.mark.parametrize("n", [1, 2, 63, 64])
def test_signatures_agree_in_lanes_of_any_width(spark, n):
    hashes = [int(h) for h in np.random.default_rng(n).integers(-(1 << 63), 1 << 63, n)]
    expected = sum(1 << b for b in range(63) if 2 * sum(h >> b & 1 for h in hashes) > n)
    widths = fuzzy_lines._LANES + fuzzy_lines._WIDE_LANES
    row = spark.createDataFrame([(hashes,)], "words ARRAY<BIGINT>").selectExpr(*map(fuzzy_lines._signature, widths)).first()
    assert list(row) == [expected] * len(widths)


def test_lines_are_near_by_whole_distance_whatever_the_parts(spark):
    rng = np.random.default_rng(5)
    pairs = [("", "a"), ("é", "é"), ("abcde", "abcd"), ("abcd", "abc")]
    for length, edits in ((90, 18), (90, 30), (300, 20), (700, 120), (700, 160)):
        x = "".join(rng.choice(list("abcdé "), length))
        for kind in ("drop", "put", "move"):
            y = list(x)
            for at in sorted(rng.choice(length // 2, edits // (2 if kind == "move" else 1), replace=False), reverse=True):
                c = y.pop(at) if kind != "put" else "z"
                if kind == "put":
                    y.insert(at, c)
                elif kind == "move":
                    y.append(c)
            pairs.append((x, "".join(y)))
    rows = spark.createDataFrame([(x, y, len(x), len(y)) for x, y in pairs], "x STRING, y STRING, x_length INT, y_length INT")
    got = [r[0] for r in rows.selectExpr(fuzzy_lines._near_enough("x", "y")).collect()]
    assert got == [5 * _distance(x, y) <= max(len(x), len(y)) for x, y in pairs] and len(set(got)) == 2
    for parts_from in (500, 3000):
        assert got == [r[0] for r in rows.selectExpr(fuzzy_lines._near_enough("x", "y", parts_from)).collect()]


def test_ends_and_anchors_tell_lines_as_whole_distances_do(spark):
    rng = np.random.default_rng(17)

    def text(n):
        return "".join(rng.choice(list("abcdefghijklmnopqrstu é"), n))

    pairs = [("", "a"), ("é", "é"), ("abcd", "abc"), ("a" * 40, "a" * 8), ("a" * 8, "a" * 40)]
    for n in (60, 150, 330):
        x, repeated = text(n), text(9) * (n // 9)
        pairs += [(text(n), text(n)), (text(n), text(n - n // 6)), (x, x[n // 2 :] + x[: n // 2])]
        pairs += [(x, x[: n // 3] + text(n // 8) + x[n // 3 :]), (x, x[n // 7 :]), (x, x[: n // 2] + x[n // 2 + n // 8 :] + text(n // 9))]
        for share in (0.03, 0.1, 0.18, 0.25):
            for line in (x, repeated):
                y = list(line)
                for at in rng.choice(len(y), int(len(y) * share), replace=False):
                    y[at] = str(rng.choice(["", "q", "zz"]))
                pairs.append((line, "".join(y)))
    pairs += [(y, x) for x, y in pairs[::2]]
    near = [5 * _distance(x, y) <= max(len(x), len(y)) for x, y in pairs]
    rows = spark.createDataFrame([(x, y, len(x), len(y)) for x, y in pairs], "x STRING, y STRING, x_length INT, y_length INT")
    found = rows.selectExpr(fuzzy_lines._far("x", "y"), fuzzy_lines._near_by_anchors("x", "y"), fuzzy_lines._near_enough("x", "y", 200)).collect()
    assert [r[2] for r in found] == near
    assert not any(far and ok for (far, _, _), ok in zip(found, near)) and not any(by and not ok for (_, by, _), ok in zip(found, near))
    # Without the whole distance: unrelated lines, and most that are near.
    assert sum(far for far, _, _ in found) > 0.4 * near.count(False) and sum(by for _, by, _ in found) > 0.5 * near.count(True)


def test_no_pair_of_lines_is_compared_twice(spark, monkeypatch):
    compared, similar = [], fuzzy_lines._similar

    def noted(pairs, *more):
        compared.extend((r.a, r.b) for r in pairs.collect())
        return similar(pairs, *more)

    monkeypatch.setattr(fuzzy_lines, "_similar", noted)
    words = [f"{a}{b}o" for a in "bcdfghjklm" for b in "aeiou"]
    shared = "common words that many lines hold between others of their own"
    rows = [(i, " ".join([*words[i : i + 8], shared, *words[i + 20 : i + 28]])) for i in range(0, 20, 4)]
    groups = fuzzy_line_groups(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    assert all(r.kept for r in groups) and len(compared) == len(set(compared)) == 10


def test_counts_of_characters_rule_out_no_line_that_is_near(spark):
    rng = np.random.default_rng(11)
    pairs = [("a" * 10, "a" * 8), ("a" * 10, "a" * 7 + "bcd"), ("e" * 10, "z" * 2 + "e" * 8), ("a" * 8, "a" * 10), ("a" * 7, "a" * 10)]
    for length in (20, 60, 150):
        for edits in (0.1, 0.2, 0.25):
            x = "".join(rng.choice(list("etaonis rhlduézq"), length))
            y = list(x)
            for at in rng.choice(length, int(length * edits), replace=False):
                y[at] = str(rng.choice(["", "q", "ez", "é"]))
            pairs += [(x, "".join(y)), ("".join(y), x)]
    lines = [(2 * i + k, t, len(t)) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    table = spark.createDataFrame(lines, "id BIGINT, line STRING, length INT")
    counts = {r.id: (r.length, r.counts) for r in fuzzy_lines._counts(table, table.select("id")).collect()}
    assert all(counts[i][0] == n == sum(counts[i][1]) for i, _, n in lines)
    rows = [(*counts[2 * i], *counts[2 * i + 1]) for i in range(len(pairs))]
    got = spark.createDataFrame(rows, "x_length INT, x_counts ARRAY<INT>, y_length INT, y_counts ARRAY<INT>").selectExpr(
        fuzzy_lines._may_be_near("x", "y")
    )
    may = [r[0] for r in got.collect()]
    assert may[:5] == [True, False, True, True, False]
    assert all(may[i] for i, (x, y) in enumerate(pairs) if 5 * _distance(x, y) <= max(len(x), len(y)))


def test_shared_sketches_hold_what_several_lines_have(spark):
    # 1 << 40 differs from 2 << 40 in none of the bits counted first.
    sketches = {1: [4, 8, 12, 1 << 40], 2: [4, 8, 16, 2 << 40], 3: [4, 20], 4: [24, 28], 5: []}
    table = spark.createDataFrame(
        [(i, 40, s, [], [], []) for i, s in sketches.items()],
        "id BIGINT, length INT, sketch_0 ARRAY<BIGINT>, sketch_1 ARRAY<BIGINT>, sketch_2 ARRAY<BIGINT>, sketch_3 ARRAY<BIGINT>",
    )
    got = {r.id: (r.kind, r.length, r.least, r["keys"]) for r in fuzzy_lines._shared(table).collect()}
    assert got == {1: (0, 40, 1, [4, 8]), 2: (0, 40, 1, [4, 8]), 3: (0, 40, 1, [4])}


def test_lines_leave_no_shuffle_files_of_finished_steps(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {name for name in re.findall(r"shuffle_\d+_\d+_\d+\.data", blocks)}

    docs = spark.createDataFrame([(i, f"{WORDS[i % 5]} line of words {i // 2} and {i} others") for i in range(40)], "doc_id BIGINT, text STRING")
    before = shuffles()
    freed = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    groups = fuzzy_line_groups(docs)
    # Files are removed in the background.
    for _ in range(100):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == freed
    assert groups.count() == groups.count() == 40


def test_tokens(docs):
    got = _by_id(token_index(docs, tokenizer_path()), "start", "n_tokens")
    assert len(got) == len(ROWS) and {r[0]: r[2] for r in got}[4] == 1
    assert min(r[1] for r in got) == 0 == got[-1][1]
    assert token_index(docs.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_gives_its_own_ids(name):
    import os

    import public_tokenizers
    from tokenizers import Tokenizer

    folder = os.path.dirname(str(public_tokenizers.path("word_bpe_49k.json")))
    if name not in os.listdir(folder):
        pytest.skip(f"no {name}")
    path = str(public_tokenizers.path(name))
    tokenizer, encode = Tokenizer.from_file(path), token_files.text_encoder(path)
    texts = [t for _, t in ROWS if t is not None] + ["Two  spaces, it's\n\tTABS é́ 12 <|im_end|>", " lead", "trail ", "x" * 9000, "Ünï\u3000wide"]
    for batch in (texts, texts[::-1], [t + " more" for t in texts]):
        flat, sizes = encode([t.encode() for t in batch])
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in batch]
        assert flat.tolist() == [i for ids in want for i in ids] and sizes.tolist() == list(map(len, want))


def test_encoders_that_remember_little_give_the_same_ids():
    texts = [" ".join(f"word{i} {WORDS[i % len(WORDS)]}, it's" for i in range(k, k + 50)).encode() for k in range(0, 200, 20)]
    encode, forgetful = token_files.text_encoder(tokenizer_path()), token_files.text_encoder(tokenizer_path(), remembered=10)
    for text in texts:
        (ids, sizes), (same_ids, same_sizes) = encode([text]), forgetful([text])
        assert ids.tolist() == same_ids.tolist() and sizes.tolist() == same_sizes.tolist()


@pytest.mark.parametrize("top", [2, 200, 49_408, 1 << 40, (1 << 64) - 1])
def test_simple8b_round_trip(top):
    for n in (0, 1, 511, 512, 513, 5000):
        values = (np.random.default_rng(n).random(n) * top).astype(np.uint64)
        words, offsets = simple8b.encode(values)
        assert np.array_equal(simple8b.decode(words, offsets, n), values)
        if n > 512:  # one block alone
            first = simple8b.decode(words[: offsets[1]], offsets[:2], simple8b.BLOCK)
            assert np.array_equal(first, values[: simple8b.BLOCK])


def test_archives_in_small_chunks(spark):
    rows = [(1, "http://a/\r\n x", "é" * 500), (2, None, "é" * 500), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", "é" * 500)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    records = warc_records(pages, "page_id", "url", "html")
    chunks = read_warc(write_warc(chunk_table(records, 64), scratch_path(spark, "w")), 64)
    assert {len(r.data) for r in chunks.where("record_id = '1'").collect()} == {64, 40}
    got = {r.record_id: (r.payload_bytes, r.record_type, r.refers_to) for r in payload_index(chunks).collect()}
    assert got == {
        "1": (1000, "response", None), "2": (1000, "revisit", "1"), "3": (0, "response", None),
        "4": (5, "response", None), "5": (5, "response", None), None: (1000, "revisit", "1"),
    }


def test_urls(spark):
    urls = ["http://A.Net/x", None, "no scheme", "http://b.example.net/en/1", "http://net?/", "http://x.net:80/", "s://q.org/fr/a"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id BIGINT, url STRING, host STRING")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), (None, "/", "block")], "host STRING, path STRING, verdict STRING")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got[0] == ("a.net", "net/", "block") and got[1] == got[2] == ("", None, "allow")
    assert got[3][1:] == ("example.net/en/", "allow") and got[4][1] is None and got[5][1] is None
    assert judge_urls(pages, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_pipeline_stages_keep_columns(spark, docs, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, str(tmp_path))
        assert k == 4 or result.columns == docs.columns
        assert result.count() > 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
