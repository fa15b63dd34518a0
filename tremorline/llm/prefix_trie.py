"""Prefix trie of conversations: union-find over LCPs of sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import saved

# Kinds of rows of a partition's forest: final nodes, open nodes, rows that end at open nodes.
_NODE, _OPEN, _END = 0, 1, 2
_FIRST, _LAST = 0, 1
_GONE = -2

_LONG = pa.int64()
_FOREST = pa.schema(
    [("kind", pa.int32()), ("part", pa.int32()), ("side", pa.int32()), ("depth", _LONG), ("key", pa.binary()), ("conv_id", _LONG)]
    + [(name, _LONG) for name in ("parent", "n", "children", "leaves", "saved", "bytes")]
    + [("ends", pa.string())]
)
_FOREST_SHAPE = (
    "kind INT, part INT, side INT, depth BIGINT, key BINARY, conv_id BIGINT, parent BIGINT,"
    " n BIGINT, children BIGINT, leaves BIGINT, saved BIGINT, bytes BIGINT, ends STRING"
)
_MERGED = pa.schema(
    [("part", pa.int32()), ("side", pa.int32()), ("node", _LONG), ("parent_node", _LONG)]
    + [(name, _LONG) for name in ("depth", "conv_id", "n", "children", "leaves", "saved")]
)
_MERGED_SHAPE = (
    "part INT, side INT, node BIGINT, parent_node BIGINT, depth BIGINT, conv_id BIGINT,"
    " n BIGINT, children BIGINT, leaves BIGINT, saved BIGINT"
)
_BATCH_ROWS = 5000


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def common_turns(one: Sequence, other: Sequence) -> int:
    """Length of the longest common prefix."""
    for k, (x, y) in enumerate(zip(one, other)):
        if x != y:
            return k
    return min(len(one), len(other))


def _sha256_of(ids: Iterable[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def compact_forest(lengths: Sequence[int], shared: Sequence[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """The trie of sorted sequences, without its inner nodes of one child.

    lengths[i]: turns of row i; shared[i]: turns that rows i - 1 and i have in
    common. Every row starts as a component with one node. The edges between
    neighbours are taken in descending depth; each joins two components, whose
    top nodes get a common node of the edge's depth: a new one, or one of the two
    if it has this depth, or both made one.

    Returns depth, parent (-1 for the root, which has depth 0), first and last
    row of every node. A node that was made one with another has the parent -2.
    """
    depth, parent = list(lengths), [-1] * len(lengths)
    low, high = list(range(len(lengths))), list(range(len(lengths)))
    component, top = list(low), list(low)
    alias: dict[int, int] = {}

    def find(i: int) -> int:
        root = i
        while component[root] != root:
            root = component[root]
        while component[i] != root:
            component[i], i = root, component[i]
        return root

    def cover(node: int, other: int) -> None:
        low[node], high[node] = min(low[node], low[other]), max(high[node], high[other])

    def hang(child: int, node: int) -> None:
        parent[child] = node
        cover(node, child)

    def new(at: int, like: int) -> int:
        for column, value in ((depth, at), (parent, -1), (low, low[like]), (high, high[like])):
            column.append(value)
        return len(depth) - 1

    edges = np.argsort(-np.asarray(shared[1:], dtype=np.int64), kind="stable") + 1
    for e in edges.tolist():
        a, b, at = find(e - 1), find(e), shared[e]
        x, y = top[a], top[b]
        if depth[x] == at == depth[y]:
            cover(x, y)
            parent[y], alias[y], joint = _GONE, x, x
        elif depth[x] == at:
            hang(y, x)
            joint = x
        elif depth[y] == at:
            hang(x, y)
            joint = y
        else:
            joint = new(at, x)
            hang(x, joint)
            hang(y, joint)
        component[b], top[a] = a, joint
    if lengths and depth[last := top[find(0)]] > 0:
        hang(last, new(0, last))

    def standing(node: int) -> int:
        root = node
        while root in alias:
            root = alias[root]
        while node != root:
            alias[node], node = root, alias[node]
        return root

    return depth, [standing(p) if p >= 0 else p for p in parent], low, high


def _forest_rows(
    part: int, ids: list[int], lengths: list[int], shared: list[int], sizes: np.ndarray, starts: list[int], first: list, last: list
) -> Iterator[tuple]:
    """One partition's forest as rows of _FOREST.

    A node is open if it is a prefix of the partition's first or last row, since
    rows of other partitions may share it. Open nodes are given as two paths, on
    which everything below is contracted to sums. All other nodes are final,
    except that the parent of one may be open: side and depth - 1 then name it.
    """
    depth, parent, low, high = compact_forest(lengths, shared)
    nodes = sorted((x for x in range(len(depth)) if parent[x] != _GONE), key=lambda x: -depth[x])
    bottom, many = len(ids) - 1, len(depth)
    children, leaves, saving, ends = [0] * many, [0] * many, [0] * many, [0] * many
    least: list[int | None] = [None] * many
    # Prefixes of both rows belong to the first path.
    side = [_FIRST if low[x] == 0 else _LAST if high[x] == bottom else None for x in range(many)]

    def per_member(x: int, t: int) -> int:
        """Bytes that a member of node x has in turn t, times the members but one."""
        return (high[x] - low[x]) * int(sizes[starts[low[x]] + t - 1])

    for x in nodes:
        to = parent[x]
        while low[x] + ends[x] <= high[x] and lengths[low[x] + ends[x]] == depth[x]:
            ends[x] += 1
        if ends[x]:
            least[x] = ids[low[x]] if least[x] is None else min(least[x], ids[low[x]])
        if to >= 0:
            least[to] = least[x] if least[to] is None else min(least[to], least[x])
        if side[x] is None:
            leaves[x] = leaves[x] if children[x] else 1
            saving[x] += per_member(x, depth[x])
            above = range(depth[to] + 1, depth[x])
            children[to] += 1
            leaves[to] += leaves[x]
            saving[to] += saving[x] + sum(per_member(x, t) for t in above)

    for x in nodes:
        to, n = parent[x], high[x] - low[x] + 1
        upper = depth[to] if to >= 0 else -1
        total = saving[x]
        for t in range(depth[x], upper, -1):
            own = t == depth[x]
            if side[x] is not None:
                at = starts[low[x]] + t - 1
                key, size = ((first if side[x] == _FIRST else last)[t - 1], int(sizes[at])) if t else (None, 0)
                sums = (children[x], leaves[x], saving[x]) if own else (0, 0, 0)
                yield (_OPEN, part, side[x], t, key, least[x], None, n, *sums, size, None)
                continue
            total += 0 if own else per_member(x, t)
            up, of = (least[x], None) if t > upper + 1 else (least[to], None) if side[to] is None else (None, side[to])
            digest = _sha256_of(ids[low[x] : low[x] + ends[x]]) if own else _NO_ENDS
            yield (_NODE, part, of, t, None, least[x], up, n, children[x] if own else 1, leaves[x], total, None, digest)
        if side[x] is not None:
            for i in ids[low[x] : low[x] + ends[x]]:
                yield (_END, part, side[x], depth[x], None, i, None, None, None, None, None, None, None)


_NO_ENDS = _sha256_of([])


def _partition_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forest rows of one sorted partition (conv_id, keys, sizes)."""
    from pyspark import TaskContext

    ids, lengths, shared, starts, flat, first, before = [], [], [], [], [], None, []
    total = 0
    for batch in batches:
        ids += batch.column("conv_id").to_pylist()
        for keys in batch.column("keys").to_pylist():
            first = keys if first is None else first
            shared.append(common_turns(before, keys) if lengths else 0)
            lengths.append(len(keys))
            starts.append(total)
            total += len(keys)
            before = keys
        flat.append(batch.column("sizes").flatten().to_numpy(zero_copy_only=False))
    if ids:
        part = TaskContext.get().partitionId()
        yield from _batches(_forest_rows(part, ids, lengths, shared, np.concatenate(flat), starts, first, before), _FOREST)


def _merged_rows(paths: Iterator[tuple]) -> Iterator[tuple]:
    """Open nodes of all partitions as one trie, in one pass with a stack.

    paths: (part, side, depth, key, conv_id, n, children, leaves, saved, bytes),
    sorted; the stack is the path to the last row so far. Gives (part, side,
    depth, node) for what went in and, once a node is complete, its sums.
    """
    stack: list[list] = []  # node, key, conv_id, n, children, leaves, saved, bytes
    made = 0

    def close(deeper_than: int) -> Iterator[tuple]:
        while len(stack) - 1 > deeper_than:
            node, _, conv, n, children, leaves, saving, size = stack.pop()
            leaves, saving, t = leaves if children else 1, saving + (n - 1) * size, len(stack)
            if stack:
                up = stack[-1]
                up[4], up[5], up[6] = up[4] + 1, up[5] + leaves, up[6] + saving
            yield None, None, node, stack[-1][0] if stack else None, t, conv, n, children, leaves, saving

    part, same = None, False
    for of, side, depth, key, conv, n, children, leaves, saving, size in paths:
        if of != part:
            part, same = of, True  # from the root on, as long as the keys agree
        elif side == _LAST and len(stack) > depth:
            yield from close(depth - 1)
            same = False
        if side == _FIRST and same and depth < len(stack) and stack[depth][1] == key:
            held = stack[depth]
            held[2], held[3] = min(held[2], conv), held[3] + n
            held[4], held[5], held[6] = held[4] + children, held[5] + leaves, held[6] + saving
        else:
            if len(stack) > depth:
                yield from close(depth - 1)
            same = False
            stack.append([made, key, conv, n, children, leaves, saving, size])
            made += 1
        yield of, side, stack[depth][0], None, depth, None, None, None, None, None
    yield from close(-1)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ("part", "side", "depth", "key", "conv_id", "n", "children", "leaves", "saved", "bytes")
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
    yield from _batches(_merged_rows(rows), _MERGED)


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends) from rows sorted by (node, conv_id): ids are streamed, not held."""

    def rows() -> Iterator[tuple]:
        current, digest = None, None
        for batch in batches:
            for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
                if node != current:
                    if digest is not None:
                        yield current, digest.hexdigest()
                    current, digest = node, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
        if digest is not None:
            yield current, digest.hexdigest()

    yield from _batches(rows(), pa.schema([("node", _LONG), ("ends", pa.string())]))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of all sequences (conv_id, keys, sizes).

    conv_id BIGINT, different in every row and not null; keys ARRAY<BINARY>, one
    per turn, equal where turns are; sizes ARRAY<BIGINT>, the turns' bytes. A
    node is a different prefix, its members the sequences that start with it.

    Sequences are range-partitioned and sorted by (keys, conv_id), so a start
    that many share, or a sequence that many are, is cut over partitions. In each
    partition union-find over the LCPs of neighbours, in descending depth, gives
    a forest. What a partition shares with others, the prefixes of its first and
    last row, is contracted to two paths; one pass over all paths merges them
    (rows: partitions times turns of a sequence, not sequences). Ids that end at
    a shared node are streamed to its digest, 8 bytes each. A sequence is one
    row: 24 bytes a turn.

    Returns one row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. The root has depth
    0 and no parent; sequences without turns are members of the root alone. No
    sequences give no nodes.
    """
    ordered = sequences.select("conv_id", "keys", "sizes").repartitionByRange("keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    forest = saved(ordered.mapInArrow(_partition_forest, _FOREST_SHAPE), "forest")
    paths = forest.where(f"kind = {_OPEN}").select("part", "side", "depth", "key", "conv_id", "n", "children", "leaves", "saved", "bytes")
    merged = saved(paths.repartition(1).sortWithinPartitions("part", "side", "depth").mapInArrow(_merge, _MERGED_SHAPE), "merged")
    places = merged.where("part IS NOT NULL").select("part", "side", "depth", "node")
    joint = merged.where("part IS NULL").drop("part", "side")
    least = joint.select(F.col("node").alias("of"), F.col("conv_id").alias("least"))

    ends = (
        forest.where(f"kind = {_END}")
        .select("part", "side", "depth", "conv_id")
        .join(places, ["part", "side", "depth"])
        .select("node", "conv_id")
        .repartition("node")
        .sortWithinPartitions("node", "conv_id")
        .mapInArrow(_digest_ends, "node BIGINT, ends STRING")
        .withColumnRenamed("node", "of_ends")
    )
    shared_nodes = (
        joint.join(least, F.col("parent_node") == F.col("of"), "left")
        .withColumn("parent", F.col("least"))
        .join(ends, F.col("node") == F.col("of_ends"), "left")
        .withColumn("ends", F.coalesce("ends", F.lit(_NO_ENDS)))
    )
    above = places.join(least, F.col("node") == F.col("of")).select(
        F.col("part").alias("_part"), F.col("side").alias("_side"), (F.col("depth") + 1).alias("_depth"), "least"
    )
    own = forest.where(f"kind = {_NODE}")
    place = (F.col("part") == F.col("_part")) & (F.col("side") == F.col("_side")) & (F.col("depth") == F.col("_depth"))
    own_nodes = own.where("side IS NULL").unionByName(
        own.where("side IS NOT NULL").join(above, place).withColumn("parent", F.col("least")).select(*own.columns)
    )
    columns = {
        "conv_id": "conv_id", "depth": "depth", "parent": "parent_conv_id", "n": "n_convs", "children": "n_children",
        "leaves": "n_leaves", "saved": "saved_tokens", "ends": "ends_sha256",
    }
    picked = [F.col(c).alias(name) for c, name in columns.items()]
    return own_nodes.select(*picked).unionByName(shared_nodes.select(*picked))


def turn_sequences(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    group: Column | None = None,
) -> DataFrame:
    """(conv_id, keys, sizes) of every conversation, its rows in order of turn.

    A turn's key is 16 bytes of the SHA-256 of role and text, its size the UTF-8
    bytes of the text; texts themselves are not shuffled. Null turns come first,
    null role and text are empty, rows of one turn are ordered by their keys and
    all kept; rows without an id take no part. With group, an expression over
    conv_id, rows are partitioned by it and it is a further column, _group.
    """
    role = F.coalesce(F.col(role_column).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    framed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        F.col(id_column).cast("bigint").alias("conv_id"),
        F.col(turn_column).cast("bigint").alias("turn"),
        F.unhex(F.substring(F.sha2(framed, 256), 1, 32)).alias("key"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    ).where("conv_id IS NOT NULL")
    names = ["conv_id"]
    if group is not None:
        rows, names = rows.withColumn("_group", group).repartition("_group"), ["_group", "conv_id"]
    turns = rows.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("turn", "key", "bytes"))).alias("turns"))
    return turns.select(*names, F.col("turns.key").alias("keys"), F.col("turns.bytes").alias("sizes"))
