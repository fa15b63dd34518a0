"""Prefix tries over few and many partitions against a plain one."""

import collections
import hashlib
import random

import pytest

from tremorline.llm.prefix_trie import compact_forest, prefix_trie, turn_sequences

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _plain(sequences):
    """sequences: conv_id -> tuple of (key, bytes)."""
    members = collections.defaultdict(list)
    for conv, turns in sorted(sequences.items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saving = collections.Counter(), collections.Counter()
    for prefix, convs in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += not children[prefix]
            saving[prefix[:d]] += (len(convs) - 1) * (prefix[-1][1] if prefix else 0)
    out = []
    for prefix, convs in members.items():
        ends = ",".join(str(c) for c in convs if sequences[c] == prefix)
        up = members[prefix[:-1]][0] if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((convs[0], len(prefix), up, len(convs), children[prefix], leaves[prefix], saving[prefix], digest))
    return sorted(out, key=repr)


def _trie(spark, sequences, partitions):
    rows = [(c, [k for k, _ in turns], [b for _, b in turns], 7) for c, turns in sequences.items()]
    table = spark.createDataFrame(rows, "conv_id BIGINT, keys ARRAY<BINARY>, sizes ARRAY<BIGINT>, depth INT")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        nodes = prefix_trie(table)
        assert tuple(nodes.columns) == COLUMNS
        return sorted((tuple(r) for r in nodes.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _random(seed, n, longest, alphabet):
    rng = random.Random(seed)
    letter = lambda k: (bytes([k]) * 16, 3 * k)
    return {rng.randrange(-(10**6), 10**12): tuple(letter(rng.randrange(alphabet)) for _ in range(rng.randrange(longest + 1))) for _ in range(n)}


@pytest.mark.parametrize(("seed", "n", "longest", "alphabet", "partitions"), [(1, 300, 6, 3, 1), (2, 300, 6, 3, 13), (3, 200, 40, 1, 9), (4, 60, 9, 30, 25)])
def test_random_tries(spark, seed, n, longest, alphabet, partitions):
    sequences = _random(seed, n, longest, alphabet)
    assert _trie(spark, sequences, partitions) == _plain(sequences)


def test_hot_groups_cross_partitions(spark):
    a, b, c = ((bytes([k]) * 16, k) for k in (1, 2, 3))
    sequences = {i: (a, b) for i in range(200)}
    sequences |= {1000 + i: (a, b, c) if i % 3 else (a,) for i in range(60)} | {2000 + i: () for i in range(50)}
    sequences[5000] = (a, b, *[c] * 120)
    assert _trie(spark, sequences, 11) == _plain(sequences)


def test_one_row_and_none(spark):
    a = (b"x", 5)
    assert _trie(spark, {7: ()}, 3) == _plain({7: ()}) == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]
    assert _trie(spark, {-7: (a, a)}, 3) == _plain({-7: (a, a)})
    empty = spark.createDataFrame([], "conv_id BIGINT, keys ARRAY<BINARY>, sizes ARRAY<BIGINT>")
    assert prefix_trie(empty).count() == 0


def test_edges_make_branching_nodes_alone():
    depth, parent, low, high = compact_forest([3, 3, 5, 2, 1], [0, 3, 3, 0, 0])
    standing = [(depth[x], low[x], high[x]) for x in range(len(depth)) if parent[x] != -2]
    assert sorted(standing) == [(0, 0, 4), (1, 4, 4), (2, 3, 3), (3, 0, 2), (5, 2, 2)]


def test_sequences_of_odd_rows(spark):
    rows = [
        (1, None, "user", "x", "a"), (1, 0, "user", "é", "a"), (1, 0, "user", "é", "a"), (2, 5, None, None, "b"),
        (2, None, "user", "x", "b"), (None, 0, "user", "x", "c"), (3, 0, "us", "erx", "d"), (4, 0, "user", "x", "e"),
    ]
    table = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, keys STRING")
    got = {r.conv_id: r for r in turn_sequences(table).collect()}
    assert {c: list(r.sizes) for c, r in got.items()} == {1: [1, 2, 2], 2: [1, 0], 3: [3], 4: [1]}
    assert got[1]["keys"][0] == got[2]["keys"][0] == got[4]["keys"][0] != got[3]["keys"][0]
    assert got[1]["keys"][1] == got[1]["keys"][2] and turn_sequences(table.limit(0)).count() == 0
