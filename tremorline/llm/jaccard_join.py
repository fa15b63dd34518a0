"""Similarity join on word shingles by T-occurrence search, DivideSkip fashion."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import forget, in_small_batches, marked, rows_of_ids, saved, without
from tremorline.llm.components import components
from tremorline.llm.words import shingles, slices, split_words, utf8

WIDTH = 5
# Link when 100 * intersection >= PERCENT * union.
PERCENT = 80

# Counters of list lengths: a fixed 8 MB, whatever the input. A counter adds up
# the lists that fall on it; a passage that a share of all documents hold stands
# out of that at any size.
_LENGTH_BITS = 22
_MOST_LENGTH = (1 << 16) - 1
_BLOCK = 4096

# Least bits of a set's outline. An outline has at least as many bits as its set
# has members, by powers of two: enough to tell unrelated sets of any size apart.
_OUTLINE_BITS = 512

# Bits of the first, coarse look inside a list.
_COARSE_LONGS = 8

_A_TO_Z = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _growing(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: joined by a shuffle at any size,
    so that small inputs run, and show, the plan of large ones."""
    return side.hint("merge")


def _sets(batch: pa.RecordBatch, text_column: str, width: int) -> Iterator[np.ndarray]:
    """The sorted different shingles of each text."""
    texts = [t.translate(_A_TO_Z) for t in utf8(batch.column(text_column))]
    hashes, owner = shingles(split_words(texts), len(texts), width)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    for start, end in zip(cuts, cuts[1:]):
        yield np.unique(hashes[start:end])


def _list_array(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([a.view(np.int64) for a in arrays])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _packed_counts(counts: np.ndarray) -> bytes:
    """A block of counters, most of them small: item size, then compressed items."""
    kind = next(k for k in ("<u1", "<u2", "<i4") if counts.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + pa.Codec("zstd").compress(counts.astype(kind).tobytes(), asbytes=True)


def _unpacked_counts(data: bytes) -> np.ndarray:
    kind = {1: "<u1", 2: "<u2", 4: "<i4"}[data[0]]
    items = pa.Codec("zstd").decompress(data[1:], _BLOCK * np.dtype(kind).itemsize, asbytes=True)
    return np.frombuffer(items, kind)


def _list_lengths(texts: DataFrame, width: int) -> np.ndarray:
    """Counters of how many documents hold a shingle, at the shingle's top bits.

    Every document counts. Tasks send blocks of counters, blocks are added up by
    further tasks, and the driver receives the fixed number of counters.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _LENGTH_BITS, dtype=np.int32)
        for batch in slices(batches, "text"):
            found = np.concatenate([*_sets(batch, "text", width), np.zeros(0, np.uint64)])
            np.add.at(counts, (found >> np.uint64(64 - _LENGTH_BITS)).astype(np.int64), 1)
        if counts.any():
            blocks = counts.reshape(-1, _BLOCK)
            data = [_packed_counts(b) for b in blocks]
            yield pa.RecordBatch.from_pydict({"block": pa.array(range(len(blocks)), pa.int32()), "counts": data})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = _unpacked_counts(data)
                sums[block] = sums[block] + values if block in sums else values.astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(sums, pa.int32()),
                    "counts": [np.minimum(v, _MOST_LENGTH).astype("<u2").tobytes() for v in sums.values()],
                }
            )

    shape = "block INT, counts BINARY"
    blocks = texts.select("text").mapInArrow(count, shape).repartition("block").mapInArrow(add, shape)
    lengths = np.zeros(1 << _LENGTH_BITS, dtype=np.uint16)
    for block, data in blocks.collect():
        lengths[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(data, "<u2")
    return lengths


def _short_lists(texts: DataFrame, lengths: np.ndarray, width: int, percent: int) -> DataFrame:
    """Per document: set size, digest of the set, its short lists, an outline.

    With T the least intersection that a link needs, the T - 1 longest lists
    cannot hold a link alone: a linked document stands in one of the others.
    """
    shared = texts.sparkSession.sparkContext.broadcast(lengths)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = shared.value
        for batch in slices(batches, "text"):
            sizes, digests, lists, outlines = [], [], [], []
            for found in _sets(batch, "text", width):
                n = len(found)
                least = -(-percent * n // 100)
                by_length = np.argsort(length[(found >> np.uint64(64 - _LENGTH_BITS)).astype(np.int64)], kind="stable")
                lists.append(found[by_length[: n - least + 1]] if n else found)
                sizes.append(n)
                digests.append(hashlib.sha256(found.tobytes()).digest())
                width_of = max(_OUTLINE_BITS, 1 << (max(n, 1) - 1).bit_length())
                bits = np.bincount((found & np.uint64(width_of - 1)).astype(np.int64), minlength=width_of)
                outlines.append(np.packbits((bits & 1).astype(np.uint8), bitorder="little").view("<i8"))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(sizes, pa.int64()),
                    "digest": pa.array(digests, pa.binary()),
                    "lists": _list_array(lists),
                    "outline": _list_array(outlines),
                }
            )

    return texts.mapInArrow(
        summarise, "doc_id BIGINT, n BIGINT, digest BINARY, lists ARRAY<BIGINT>, outline ARRAY<BIGINT>"
    )


def _sets_of(texts: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, members) for at least the given ids, by reading their texts again."""
    picked = rows_of_ids(texts.select(F.col("doc_id").alias("id"), "text"), ids)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [s.tobytes() for s in _sets(batch, "text", width)]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "members": pa.array(sets, pa.binary())})

    return saved(picked.mapInArrow(members, "id BIGINT, members BINARY"), "sets")


def _linked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the saved pairs (a, b) that link, by probing whole sets."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    sets = _sets_of(texts, ids, width)
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("members_a"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("members_b"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for one, other in zip(batch.column("members_a"), batch.column("members_b")):
                x, y = np.frombuffer(one.as_buffer(), "<u8"), np.frombuffer(other.as_buffer(), "<u8")
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                links.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    both = pairs.join(_growing(right), "b").join(_growing(left), "a")
    links = saved(both.mapInArrow(probe, "a BIGINT, b BIGINT"), "links")
    forget(sets, pairs)
    return links


def jaccard_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """Groups of documents linked by word-shingle Jaccard similarity.

    Words are runs of anything but ASCII white space, A-Z in lower case. Two
    documents link when 100 * intersection >= percent * union of their sets.

    DivideSkip over inverted lists: with T the overlap that a document needs, its
    T - 1 longest lists are set aside, and only the short ones are merged; who
    stands in one of them is a candidate, and the long lists are probed by
    binary search. Which lists are long comes from counters over all documents;
    their number is fixed, so they only order the search and never decide.
    Documents with equal sets are one row from the start.

    Inside a list no all-pairs are made. First each document meets the list's
    most typical one, links are verified, and linked documents get one component.
    Then only lists that still hold several components are searched for pairs
    across components; outlines (parities of hashed members) prove most of them
    too different. No candidate is dropped otherwise.

    Returns one row per input row: doc_id, n_shingles, component_id (smallest
    doc_id reachable). Empty and null texts have 0 shingles and link with
    nothing; rows without an id link with nothing and have a null component;
    rows that repeat an id are taken for one document. An empty table gives none.
    The result is written to the scratch folder, and what led to it removed.
    """
    texts = in_small_batches(docs).select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    lengths = _list_lengths(texts, width)
    found = saved(_short_lists(texts, lengths, width, percent), "short-lists")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    unique = saved(
        found.where(~alone).groupBy("digest").agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "unique-sets"
    )
    # Sets without a copy stay where they are; of the others one row is picked.
    copied = marked(found.where(~alone), unique.where("copies > 1"), "digest", "copied")
    # No semi-join: Spark moves one below the marks, where it would shuffle all sets.
    firsts = unique.select(F.col("id").alias("first_id"))
    picked = copied.where("copied").join(firsts, F.col("doc_id") == F.col("first_id")).drop("first_id")
    lists = copied.where("NOT copied").unionByName(picked).select(F.col("doc_id").alias("id"), F.col("n").cast("int").alias("n"), "lists")
    # A document whose neighbours by size in a list are too small and too large
    # for a link has none in this list.
    by_size = Window.partitionBy("list").orderBy("n", "id")
    shared = saved(
        lists.select("id", "n", F.explode("lists").alias("list"))
        .select("id", "n", "list", F.lag("n").over(by_size).alias("smaller"), F.lead("n").over(by_size).alias("larger"))
        .where(f"smaller * 100L >= n * {percent}L OR n * 100L >= larger * {percent}L")
        .select("id", "list"),
        "shared-lists",
    )
    # The more of its short lists a document shares, the more typical it is.
    shares = shared.groupBy("id").agg(F.count("*").alias("shares"))
    about = saved(
        _growing(shares).join(
            found.select("doc_id", "n", "outline", (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).alias("short")),
            F.col("id") == F.col("doc_id"),
        ).select("id", "n", "outline", (F.col("shares") / F.col("short")).alias("typical")),
        "outlines",
    )

    # Sets that link differ in at most (n + m) * (100 - percent) / (100 + percent)
    # members, and parity outlines in no more bits than sets in members.
    sizes = "one.n * 100 >= other.n * {0} AND other.n * 100 >= one.n * {0}".format(percent)
    bound = f"* {100 + percent} <= (one.n + other.n) * {100 - percent}"
    coarse = " + ".join(f"bit_count(one.coarse[{i}] ^ other.coarse[{i}])" for i in range(_COARSE_LONGS))
    # Where sizes allow a link, one outline is at most twice as wide and is folded.
    fold = "if(size({0}) > size({1}), zip_with(slice({0}, 1, size({1})), slice({0}, size({1}) + 1, size({1})), (p, q) -> p ^ q), {0})"
    x, y = "one.outline", "other.outline"
    apart = f"aggregate(zip_with({fold.format(x, y)}, {fold.format(y, x)}, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c)"

    def near(pairs: DataFrame) -> DataFrame:
        one, other = about.alias("one"), about.alias("other")
        return (
            pairs.join(_growing(one), F.col("a") == F.col("one.id"))
            .join(_growing(other), F.col("b") == F.col("other.id"))
            .where(f"{sizes} AND {apart} {bound}")
            .select("a", "b")
        )

    by_typical = Window.partitionBy("list").orderBy(F.col("typical").desc(), "id")
    stars = (
        shared.join(_growing(about.select("id", "typical")), "id")
        .select(F.first("id").over(by_typical).alias("a"), F.col("id").alias("b"))
        .where("a <> b")
        .distinct()
    )
    first = components(_linked(saved(near(stars), "stars"), texts, width, percent))

    # Folded once more by parity, every outline has the same few bits.
    folded = [
        f"aggregate(filter(outline, (x, k) -> k % {_COARSE_LONGS} = {i}), 0L, (s, x) -> s ^ x)"
        for i in range(_COARSE_LONGS)
    ]
    joined = about.join(_growing(first), "id", "left").select(
        "id",
        "n",
        F.expr(f"array({', '.join(folded)})").alias("coarse"),
        F.coalesce("component", "id").alias("component"),
    )
    placed = shared.join(_growing(joined.select("id", "component")), "id")
    mixed = placed.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_lists = saved(
        shared.join(_growing(mixed.select("list")), "list").join(_growing(joined), "id").select("list", "id", "n", "coarse", "component"),
        "open-lists",
    )
    across = (
        open_lists.alias("one")
        .join(_growing(open_lists.alias("other")), (F.col("one.list") == F.col("other.list")) & (F.col("one.component") < F.col("other.component")) & F.expr(f"{sizes} AND ({coarse}) {bound}"))
        .select(F.col("one.id").alias("a"), F.col("other.id").alias("b"))
        .distinct()
    )
    second = _linked(saved(near(across), "across"), texts, width, percent)
    whole = components(
        first.select(F.col("id").alias("a"), F.col("component").alias("b")).where("a <> b").union(second.select("a", "b"))
    )

    groups = unique.select("digest", "id").join(_growing(whole), "id", "left").select(
        F.col("digest").alias("set_digest"), F.coalesce("component", "id").alias("component")
    )
    named = found.join(_growing(groups), (F.col("digest") == F.col("set_digest")) & ~alone, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
    result = saved(named, "components")
    forget(found, unique, shared, about, first, open_lists, second, whole)
    return result


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents whose id names their group, one row each; rows without an id
    stay. Of rows that repeat an id one stays, any."""
    named = jaccard_components(docs, id_column, **options)
    left = without(docs, named.where("doc_id <> component_id").select("doc_id"), id_column)
    repeated = docs.groupBy(id_column).count().where("count > 1").select(id_column)
    split = marked(left, repeated, id_column, "_repeated")
    once = split.where(F.col("_repeated") & F.col(id_column).isNotNull()).dropDuplicates([id_column])
    others = split.where(~F.col("_repeated") | F.col(id_column).isNull())
    return others.unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])
