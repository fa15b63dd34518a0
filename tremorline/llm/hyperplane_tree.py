"""Hard negatives by an exact multiway hyperplane tree with distance ranges between siblings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import saved

# The tree is fitted on so many rows, those of the least hashed ids, whatever the input.
SAMPLE_ROWS = 4096
FANOUT = 16
# A node with fewer rows of the sample is a leaf.
_LEAF_SAMPLE = 64

# Rows of a block, which lie in one leaf, and anchors that travel together.
_BLOCK_ROWS = 1024
_ANCHORS = 256
# Blocks of a leaf that meet the same copy of its visitors.
_BLOCKS_A_SALT = 16

# Components are integers below this, so that scores are exact in 64 bits.
LARGEST = 1 << 24
_NONE = np.iinfo(np.int64).min


class Node(NamedTuple):
    points: np.ndarray  # split points, float64
    slack: np.ndarray  # their added coordinate
    children: list[int]  # a node, or ~leaf


class Tree(NamedTuple):
    """Split points, and how far rows of each subtree lie from each of them.

    Vectors get one more coordinate, sqrt(square - |x|^2), which makes them all
    equally long; that of an anchor is 0. Then a higher inner product with an
    anchor is a shorter distance, and a range of scores is an annulus.
    """

    square: float  # the largest squared length of a row
    nodes: list[Node]
    leaves: int
    low: np.ndarray  # node, split point, subtree: the least distance
    high: np.ndarray


def _slack(square: float, x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(square - (x * x).sum(axis=1), 0.0))


def _distances(tree_square: float, x: np.ndarray, slack: np.ndarray, node: Node) -> np.ndarray:
    dots = x @ node.points.T + slack[:, None] * node.slack[None, :]
    lengths = (x * x).sum(axis=1) + slack * slack
    return np.sqrt(np.maximum(lengths[:, None] + tree_square - 2.0 * dots, 0.0))


def fit_tree(sample: np.ndarray, square: float, fanout: int = FANOUT, leaf_rows: int = _LEAF_SAMPLE) -> Tree:
    """Split points from a sample: at each node far ones, each row to the nearest."""
    slack, nodes, leaves = _slack(square, sample), [], 0
    rng = np.random.default_rng(11)

    def grow(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf_rows:
            picked = rng.permutation(rows)[: 4 * fanout]
            chosen, far = [picked[0]], np.full(len(picked), np.inf)
            while len(chosen) < fanout:
                last = Node(sample[chosen[-1:]], slack[chosen[-1:]], [])
                far = np.minimum(far, _distances(square, sample[picked], slack[picked], last)[:, 0])
                if far.max() <= 1e-6:
                    break
                chosen.append(picked[int(far.argmax())])
            if len(chosen) > 1:
                at = len(nodes)
                nodes.append(Node(sample[chosen], slack[chosen], []))
                nearest = _distances(square, sample[rows], slack[rows], nodes[at]).argmin(axis=1)
                for j in range(len(chosen)):
                    nodes[at].children.append(grow(rows[nearest == j]))
                return at
        leaves += 1
        return ~(leaves - 1)

    grow(np.arange(len(sample)))
    shape = (len(nodes), fanout, fanout)
    return Tree(square, nodes, leaves, np.full(shape, np.inf), np.full(shape, -np.inf))


def leaves_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of every vector: at each node to the nearest split point."""
    slack, out = _slack(tree.square, x), np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))] if tree.nodes else []
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        nearest = _distances(tree.square, x[rows], slack[rows], tree.nodes[at]).argmin(axis=1)
        for j, child in enumerate(tree.nodes[at].children):
            if child >= 0:
                todo.append((child, rows[nearest == j]))
            else:
                out[rows[nearest == j]] = ~child
    return out


def _paths(tree: Tree) -> dict[int, list[tuple[int, int]]]:
    """Per leaf the (node, child) steps from the root."""
    paths: dict[int, list[tuple[int, int]]] = {} if tree.nodes else {0: []}
    todo = [(0, [])] if tree.nodes else []
    while todo:
        at, path = todo.pop()
        for j, child in enumerate(tree.nodes[at].children):
            if child >= 0:
                todo.append((child, [*path, (at, j)]))
            else:
                paths[~child] = [*path, (at, j)]
    return paths


def surviving(tree: Tree, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which leaves may hold a row whose score with an anchor lies in least..most.

    anchors (n, dims), least and most (n,); -inf and inf are allowed. A subtree
    goes when its range of distances to any split point misses what the triangle
    inequality leaves of the anchor's annulus. Returns (n, leaves) booleans.
    """
    lengths = (anchors * anchors).sum(axis=1)
    inner = np.sqrt(np.maximum(lengths + tree.square - 2.0 * most, 0.0))
    outer = np.sqrt(np.maximum(lengths + tree.square - 2.0 * least, 0.0))
    margin = 1e-5 * (1.0 + np.sqrt(tree.square + lengths))
    out = np.zeros((len(anchors), tree.leaves), dtype=bool)
    if not tree.nodes:
        out[:] = True
    todo = [(0, np.arange(len(anchors)))] if tree.nodes else []
    while todo:
        at, rows = todo.pop()
        node, k = tree.nodes[at], len(tree.nodes[at].children)
        to_points = _distances(tree.square, anchors[rows], np.zeros(len(rows)), node)
        nearest = np.maximum(to_points - outer[rows, None], inner[rows, None] - to_points) - margin[rows, None]
        farthest = to_points + outer[rows, None] + margin[rows, None]
        meets = (tree.low[at, :k, :k] <= farthest[:, :, None]) & (tree.high[at, :k, :k] >= nearest[:, :, None])
        stays = meets.all(axis=1)
        for j, child in enumerate(node.children):
            kept = rows[stays[:, j]]
            if len(kept) and child >= 0:
                todo.append((child, kept))
            elif len(kept):
                out[kept, ~child] = True
    return out


def scores_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of x with all rows of y."""
    if not x.size or not y.size:
        return np.zeros((len(x), len(y)), np.int64)
    if int(np.abs(x).max()) * int(np.abs(y).max()) * x.shape[1] < 1 << 53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x.astype(np.int64) @ y.astype(np.int64).T


def best_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most` entries of each group: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    ordered = group[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < most]


_BLOCK = "leaf INT, first BIGINT, rows INT, ids BINARY, labels BINARY, anchors BINARY, vectors BINARY"


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    return ids, labels, np.frombuffer(row["vectors"], "<i4").reshape(len(ids), -1)


def _pack(vectors: DataFrame, scale: float) -> DataFrame:
    """Rows that take part, as integers: id, label, anchor, length, vector (32 bits a component)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
            sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
            sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, sizes)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(scale * flat)
            bad = np.bincount(owner, ~(np.abs(whole) < LARGEST), minlength=len(sizes)) > 0
            missing = [batch.column(c).is_null().to_numpy(zero_copy_only=False) for c in ("id", "label", "vector")]
            keep = ~(bad | np.logical_or.reduce(missing))
            ends = np.cumsum(sizes)
            whole = np.nan_to_num(whole).clip(-LARGEST, LARGEST).astype("<i4")
            squares = np.bincount(owner, whole.astype(np.float64) ** 2, minlength=len(sizes))
            picked = np.flatnonzero(keep)
            yield pa.RecordBatch.from_pydict(
                {
                    **{c: batch.column(c).filter(pa.array(keep)) for c in ("id", "label", "anchor")},
                    "length": pa.array(sizes[picked], pa.int32()),
                    "square": pa.array(squares[picked]),
                    "vector": pa.array([whole[ends[i] - sizes[i] : ends[i]].tobytes() for i in picked], pa.binary()),
                }
            )

    return vectors.mapInArrow(pack, "id BIGINT, label BIGINT, anchor BOOLEAN, length INT, square DOUBLE, vector BINARY")


def _matrix(column: Iterable[bytes], dims: int) -> np.ndarray:
    """Packed vectors as rows; shorter ones are filled up with zeros."""
    return np.frombuffer(b"".join(v.ljust(4 * dims, b"\0") for v in column), "<i4").reshape(-1, dims)


def _blocks(packed: DataFrame, tree: Tree, dims: int) -> DataFrame:
    """The rows by leaf, packed in blocks that lie in one leaf each."""
    shared = packed.sparkSession.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = leaves_of(shared.value, _matrix(batch.column("vector").to_pylist(), dims).astype(np.float64))
            columns = [batch.column(c) for c in ("id", "label", "anchor", "vector")]
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *columns], ["leaf", "id", "label", "anchor", "vector"])

    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            leaf, ids, labels, anchors, vectors = zip(*held)
            data = {
                "leaf": pa.array(leaf[:1], pa.int32()),
                "first": pa.array(ids[:1], pa.int64()),
                "rows": pa.array([len(ids)], pa.int32()),
                "ids": [np.array(ids, "<i8").tobytes()],
                "labels": [np.array(labels, "<i8").tobytes()],
                "anchors": [np.array(anchors, "u1").tobytes()],
                "vectors": [_matrix(vectors, dims).tobytes()],
            }
            held.clear()
            return pa.RecordBatch.from_pydict(data)

        last = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("leaf", "id", "label", "anchor", "vector"))):
                if row == last:
                    continue
                last = row
                if held and (held[0][0] != row[0] or len(held) == _BLOCK_ROWS):
                    yield block()
                held.append(row)
        if held:
            yield block()

    rows = packed.mapInArrow(place, "leaf INT, id BIGINT, label BIGINT, anchor BOOLEAN, vector BINARY")
    order = ["leaf", "id", "label", "vector", "anchor"]
    return saved(rows.repartitionByRange("leaf", "id").sortWithinPartitions(*order).mapInArrow(bind, _BLOCK), "vector-blocks")


def _with_ranges(blocks: DataFrame, tree: Tree) -> tuple[Tree, dict[int, int]]:
    """The tree with its ranges of distances, from all rows, and the rows of each leaf.

    Numbers of a fixed count come to the driver: (split points of a node) squared
    for each node, whatever the input.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(tree)
    fanout = tree.low.shape[1] if tree.nodes else 1

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        paths, counts, low, high = _paths(tree), np.zeros(tree.leaves, np.int64), tree.low.copy(), tree.high.copy()
        for batch in batches:
            for row in batch.to_pylist():
                counts[row["leaf"]] += row["rows"]
                x = _unpacked(row)[2].astype(np.float64)
                slack = _slack(tree.square, x)
                for node, j in paths[row["leaf"]]:
                    d = _distances(tree.square, x, slack, tree.nodes[node])
                    low[node, : d.shape[1], j] = np.minimum(low[node, : d.shape[1], j], d.min(axis=0))
                    high[node, : d.shape[1], j] = np.maximum(high[node, : d.shape[1], j], d.max(axis=0))
        slots, leaves = np.flatnonzero(low.ravel() <= high.ravel()), np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "slot": pa.array(np.concatenate((slots, -1 - leaves)), pa.int64()),
                "low": pa.array(np.concatenate((low.ravel()[slots], np.zeros(len(leaves))))),
                "high": pa.array(np.concatenate((high.ravel()[slots], np.zeros(len(leaves))))),
                "rows": pa.array(np.concatenate((np.zeros(len(slots), np.int64), counts[leaves]))),
            }
        )

    found = blocks.select("leaf", "rows", "ids", "labels", "vectors").mapInArrow(measure, "slot BIGINT, low DOUBLE, high DOUBLE, rows BIGINT")
    low, high, counts = tree.low.copy().ravel(), tree.high.copy().ravel(), {}
    for slot, least, most, rows in found.groupBy("slot").agg(F.min("low"), F.max("high"), F.sum("rows")).collect():
        if slot < 0:
            counts[-1 - slot] = rows
        else:
            low[slot], high[slot] = least, most
    shape = (len(tree.nodes), fanout, fanout)
    return tree._replace(low=low.reshape(shape), high=high.reshape(shape)), counts


_VISIT = "leaf INT, salt INT, ids BINARY, labels BINARY, vectors BINARY, bounds BINARY"


def _visits(
    tree: Tree, salts: dict[int, int], ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, bounds: np.ndarray, reach: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Anchors to the leaves they have to see; reach: (anchors, leaves)."""
    for leaf in np.flatnonzero(reach.any(axis=0)).tolist():
        rows, times = reach[:, leaf], salts.get(leaf, 0)
        if times:
            packed = {
                "ids": ids[rows].astype("<i8"), "labels": labels[rows].astype("<i8"),
                "vectors": vectors[rows].astype("<i4"), "bounds": bounds[rows].astype("<i8"),
            }
            yield pa.RecordBatch.from_pydict(
                {
                    "leaf": pa.array([leaf] * times, pa.int32()),
                    "salt": pa.array(range(times), pa.int32()),
                    **{name: [value.tobytes()] * times for name, value in packed.items()},
                }
            )


def _meet(visits: DataFrame, blocks: DataFrame, salts: DataFrame) -> DataFrame:
    """Every visit beside every block of its leaf and salt."""
    salted = blocks.join(F.broadcast(salts), F.col("leaf") == F.col("of_leaf")).select(
        F.col("leaf").alias("_leaf"),
        F.pmod(F.xxhash64("first"), F.col("salts")).cast("int").alias("_salt"),
        F.struct("ids", "labels", "vectors").alias("block"),
    )
    visit = F.struct("ids", "labels", "vectors", "bounds").alias("visit")
    return (
        visits.select("leaf", "salt", visit)
        .join(salted, (F.col("leaf") == F.col("_leaf")) & (F.col("salt") == F.col("_salt")))
        .select("visit", "block")
    )


_FOUND = "anchor_id BIGINT, bound BIGINT, id BIGINT, score BIGINT"


def _found(anchor: np.ndarray, bound: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    columns = (anchor, bound, ids, score)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["anchor_id", "bound", "id", "score"])


def _first(found: DataFrame, group: list[str], most: int) -> DataFrame:
    ranks = Window.partitionBy(*group).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
) -> DataFrame:
    """For each anchor and each of its positives the first hard negatives.

    A component x counts as floor(scale * x), a score is an integer inner
    product, higher scores come first, ties by smaller ids. An anchor's positives
    are its first other rows of the same label; the negatives of a positive are
    the first rows of other labels whose score lies between least_percent of the
    positive's and the positive's.

    GNAT-style tree, exact: split points come from a sample of SAMPLE_ROWS rows,
    every row goes to the leaf of its nearest split points, and each split point
    holds the range of its distances to the rows of each sibling's subtree, all
    rows counted. A search is an annulus of distances around its anchor: for
    positives the ball of the best rows found in the anchor's own block, for
    negatives the window of scores. Subtrees whose range misses it are not
    visited; leaves are compared exactly. Rows lie in blocks, anchors travel in
    blocks, and a leaf with many blocks is met by as many copies of its visitors.

    Rows with a null id, label or vector, or a component that is null, not finite
    or at least LARGEST after scaling, take no part; a null anchor condition is
    false. Shorter vectors count as filled up with zeros. Rows that repeat another
    in all columns used count once; rows that share only an id are candidates of
    their own, and as anchors one. An empty table gives no rows.

    Returns anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(label_column).cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    packed = saved(_pack(rows, scale), "packed-vectors")
    longest = packed.agg(F.max("length"), F.max("square")).first()
    dims, square = max(longest[0] or 0, 1), float(longest[1] or 0.0)
    sample = packed.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vector").collect()
    tree = fit_tree(_matrix([bytes(r[0]) for r in sample], dims).astype(np.float64), square)
    blocks = _blocks(packed, tree, dims)
    tree, counts = _with_ranges(blocks, tree)
    salts = {leaf: -(-n // (_BLOCK_ROWS * _BLOCKS_A_SALT)) for leaf, n in counts.items()}
    salt_table = spark.createDataFrame(list(salts.items()), "of_leaf INT, salts INT")
    shared = spark.sparkContext.broadcast((tree, salts))

    def first_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, salts = shared.value
        held: list[tuple] = []

        def go() -> Iterator[pa.RecordBatch]:
            ids, labels, x, floors = (np.concatenate(c) for c in zip(*held))
            held.clear()
            least = np.where(floors == _NONE, -np.inf, floors.astype(np.float64))
            reach = surviving(tree, x.astype(np.float64), least, np.full(len(ids), np.inf))
            yield from _visits(tree, salts, ids, labels, x, floors, reach)

        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, x = _unpacked(row)
                at = np.flatnonzero(np.frombuffer(row["anchors"], "u1"))
                scores = scores_of(x[at], x)
                scores[(labels[at, None] != labels[None, :]) | (ids[at, None] == ids[None, :])] = _NONE
                # The last of the first positives in the anchor's block: all that are searched score as much.
                floors = np.sort(scores, axis=1)[:, -positives] if len(ids) >= positives else np.full(len(at), _NONE)
                held.append((ids[at], labels[at], x[at], floors))
                if sum(len(h[0]) for h in held) >= _ANCHORS:
                    yield from go()
        if held:
            yield from go()

    def same_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for visit, block in zip(batch.column("visit").to_pylist(), batch.column("block").to_pylist()):
                ids, labels, x = _unpacked(visit)
                others, their, y = _unpacked(block)
                scores, floors = scores_of(x, y), np.frombuffer(visit["bounds"], "<i8")
                fits = (labels[:, None] == their[None, :]) & (ids[:, None] != others[None, :]) & (scores >= floors[:, None])
                a, b = np.nonzero(fits)
                best = best_of(ids[a], scores[a, b], others[b], positives)
                a, b = a[best], b[best]
                yield _found(ids[a], np.zeros(len(a)), others[b], scores[a, b])

    visits = blocks.where(F.expr("locate(x'01', anchors) > 0")).select("ids", "labels", "anchors", "vectors").mapInArrow(first_visits, _VISIT)
    near = _meet(visits, blocks, salt_table).mapInArrow(same_label, _FOUND)
    chosen = saved(
        _first(near, ["anchor_id"], positives).select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )

    def window_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, salts = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _ANCHORS):
                part = batch.slice(start, _ANCHORS)
                lists = part.column("scores").to_pylist()
                bounds = np.array([s + [_NONE] * (positives - len(s)) for s in lists], np.int64)
                x = _matrix(part.column("vector").to_pylist(), dims)
                reach = np.zeros((len(x), tree.leaves), dtype=bool)
                for k in range(positives):
                    some = np.flatnonzero(bounds[:, k] >= 0)  # below 0 a window is empty
                    most = bounds[some, k].astype(np.float64)
                    reach[some] |= surviving(tree, x[some].astype(np.float64), most * least_percent / 100.0, most)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
                yield from _visits(tree, salts, ids, labels, x, bounds, reach)

    def in_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for visit, block in zip(batch.column("visit").to_pylist(), batch.column("block").to_pylist()):
                ids, labels, x = _unpacked(visit)
                others, their, y = _unpacked(block)
                bounds = np.frombuffer(visit["bounds"], "<i8").reshape(len(ids), -1)
                scores, differ = scores_of(x, y), labels[:, None] != their[None, :]
                for k in range(positives):
                    bound = bounds[:, k, None]
                    fits = differ & (bound >= 0) & (scores <= bound) & (100 * scores >= least_percent * bound)
                    a, b = np.nonzero(fits)
                    best = best_of(ids[a], scores[a, b], others[b], negatives)
                    a, b = a[best], b[best]
                    yield _found(ids[a], bounds[a, k], others[b], scores[a, b])

    windows = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    anchors = packed.where("anchor").select("id", "label", "vector").distinct()
    visitors = windows.join(anchors, F.col("anchor_id") == F.col("id")).select("id", "label", "vector", "scores")
    hard = _meet(visitors.mapInArrow(window_visits, _VISIT), blocks, salt_table).mapInArrow(in_window, _FOUND)
    ranked = _first(hard, ["anchor_id", "bound"], negatives).withColumnRenamed("anchor_id", "of_anchor")
    return chosen.join(
        ranked, (F.col("anchor_id") == F.col("of_anchor")) & (F.col("positive_score") == F.col("bound"))
    ).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
