"""Hard negatives against brute force; the tree alone; odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tremorline.llm import hyperplane_tree
from tremorline.llm.hyperplane_tree import fit_tree, hard_negatives, leaves_of, scores_of, surviving

SHAPE = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, rank STRING"


def _brute(rows, every=10):
    ok = {}
    for i, x, label, *_ in rows:
        if i is not None and x is not None and label is not None and all(c is not None and math.isfinite(c) for c in x):
            ok[i] = (np.floor(256 * np.array(x, np.float32).astype(float)), label)
    width = max((len(x) for x, _ in ok.values()), default=0)
    ids = sorted(ok)
    matrix = np.array([np.pad(ok[i][0], (0, width - len(ok[i][0]))) for i in ids]).reshape(len(ids), width)
    labels, out = np.array([ok[i][1] for i in ids]), set()
    for k, a in enumerate(ids):
        if a % every:
            continue
        scores = (matrix @ matrix[k]).astype(int)
        ranked = sorted((j for j in range(len(ids)) if j != k), key=lambda j: (-scores[j], ids[j]))
        for p in [j for j in ranked if labels[j] == labels[k]][:5]:
            fits = [j for j in ranked if labels[j] != labels[k] and 80 * scores[p] <= 100 * scores[j] <= 100 * scores[p]]
            out |= {(a, ids[p], r, ids[j], scores[p], scores[j]) for r, j in enumerate(fits[:5], 1)}
    return out


def _mined(spark, rows, every=10, partitions=3):
    table = spark.createDataFrame(rows, SHAPE).repartition(partitions)
    return {tuple(r) for r in hard_negatives(table, F.col("vec_id") % every == 0).collect()}


@pytest.mark.parametrize(("seed", "clusters", "spread"), [(1, 40, 0.05), (2, 1, 1.0)])
def test_random_vectors(spark, seed, clusters, spread, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(hyperplane_tree, "_BLOCK_ROWS", 32)
    monkeypatch.setattr(hyperplane_tree, "_BLOCKS_A_SALT", 2)
    centres = rng.normal(size=(clusters, 12))
    rows = [
        (i, [float(c) for c in centres[rng.integers(clusters)] + spread * rng.normal(size=12)], int(rng.integers(3)), "r")
        for i in range(1500)
    ]
    rows += [(5000 + i, rows[20][1], i % 3, "r") for i in range(150)]  # one vector many times
    wanted = _brute(rows)
    assert len(wanted) > 500 and _mined(spark, rows) == wanted


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.5], 1, "r"), (1, [1.0, 0.25], 1, "r"), (2, [1.0, 0.25], 2, "r"), (3, [1.0], 2, "r"), (4, [], 2, "r"),
        (5, [1.0, None], 2, "r"), (6, [inf, 1.0], 2, "r"), (7, [nan, 1.0], 2, "r"), (8, None, 2, "r"), (9, [1.0, 0.5], None, "r"),
        (None, [1.0, 0.25], 2, "r"), (10, [-1.0, 0.0], 1, "r"), (11, [0.0, 0.0], 2, "r"), (12, [-1.0, 0.0], 2, "r"),
        (20, [0.0, 0.0], 2, "r"), (30, [1e30, 0.0], 2, "r"), (3, [1.0], 2, "r"),
    ]
    wanted = _brute([r for r in rows if r[0] != 30])
    assert wanted and _mined(spark, rows) == wanted
    assert _mined(spark, rows[:1]) == set() == _mined(spark, rows[8:9])
    table = spark.createDataFrame(rows, SHAPE)
    assert hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(table, F.lit(None).cast("boolean")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_no_row_inside_an_annulus_is_eliminated(seed):
    rng = np.random.default_rng(seed)
    rows = np.floor(256 * (rng.normal(size=(900, 6)) * rng.choice([0.1, 1, 3], (900, 1))))
    square = float((rows**2).sum(axis=1).max())
    tree = fit_tree(rows[:400], square, fanout=6, leaf_rows=8)
    leaves = leaves_of(tree, rows)
    slack = hyperplane_tree._slack(square, rows)
    for leaf, path in hyperplane_tree._paths(tree).items():
        at = leaves == leaf
        for node, j in path if at.any() else []:
            d = hyperplane_tree._distances(square, rows[at], slack[at], tree.nodes[node])
            k = d.shape[1]
            tree.low[node, :k, j] = np.minimum(tree.low[node, :k, j], d.min(axis=0))
            tree.high[node, :k, j] = np.maximum(tree.high[node, :k, j], d.max(axis=0))
    anchors = rows[::90]
    scores = scores_of(anchors, rows)
    assert np.array_equal(scores, (anchors @ rows.T).astype(int))
    most = np.sort(scores, axis=1)[:, -3].astype(float)
    least = 0.9 * np.abs(most)
    reach = surviving(tree, anchors, least, np.abs(most))
    for a in range(len(anchors)):
        inside = (scores[a] >= least[a]) & (scores[a] <= abs(most[a]))
        assert reach[a, leaves[inside]].all()
    assert reach.mean() < 0.9


def test_large_scores_are_exact():
    big = np.array([[(1 << 24) - 1] * 64, [1] * 64])
    assert scores_of(big, big).tolist() == [[64 * ((1 << 24) - 1) ** 2, 64 * ((1 << 24) - 1)], [64 * ((1 << 24) - 1), 64]]
