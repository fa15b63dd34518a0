"""Benchmark decontamination: n-gram seeds, then local alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import forget, in_small_batches, saved, without
from tremorline.llm.words import Words, slices, split_words, windows

SEED_WORDS = 3

# Least alignment score, as a part of what an exact copy of the item scores.
LEAST_SCORE = 0.5

_MATCH, _MISMATCH, _GAP = 2, -1, -1

# No seeds: of an item's n-grams the most frequent, one in _SET_ASIDE at most, and only
# those that occur _FREQUENT times as often as its median one, which copies raise too.
_SET_ASIDE, _FREQUENT = 8, 16

# Bits of the filter that a task sees of all seeds: a fixed 512 KB.
_FILTER_BITS = 22

_PUNCTUATION_OUT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _words(column: pa.Array) -> Words:
    """Words in lower case, ASCII punctuation taken for space."""
    texts = ["" if t is None else t.lower() for t in column.to_pylist()]
    return split_words([t.encode("utf-8", "surrogatepass").translate(_PUNCTUATION_OUT) for t in texts])


def _grams(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the n-grams that lie in one text."""
    runs = windows(words.hashes, width)
    at = np.flatnonzero(words.doc[: len(runs)] == words.doc[width - 1 :]) if len(runs) else np.zeros(0, np.int64)
    return runs[at], at


def _filter(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the hashes' top bits, of fixed size; true where one is."""
    slot = F.shiftrightunsigned("hash", 64 - _FILTER_BITS)
    rows = (
        hashes.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))
        .collect()
    )
    # Spark puts slot 0 in bucket 0 and 32768 slots from 1 on in each bucket after.
    known = np.zeros((1 << _FILTER_BITS) + 65536, dtype=bool)
    for bucket, bitmap in rows:
        bits = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")
        first = max(0, (bucket - 1) * 32768 + 1)
        known[first : first + len(bits)] |= bits.astype(bool)
    return known[: 1 << _FILTER_BITS]


def _alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman over word hashes: best score, and the word behind its end."""
    columns = np.arange(len(passage) + 1) * -_GAP
    row = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, _MATCH, _MISMATCH)
        now = np.zeros_like(row)
        now[1:] = np.maximum(row[:-1] + step, row[1:] + _GAP)
        np.maximum(now, 0, out=now)
        # Gaps along the row: the best start to the left, less its distance.
        row = np.maximum.accumulate(now + columns) - columns
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def contaminated_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    seed_words: int = SEED_WORDS,
    least_score: float = LEAST_SCORE,
) -> DataFrame:
    """Documents that hold a copy of a benchmark item, exact, edited or paraphrased.

    How often each n-gram of the items occurs is counted over all documents. All
    that occur are seeds, but for the most frequent eighth of an item's n-grams
    where they occur far more often than its median one. So a copy that keeps more
    than an eighth of the item's n-grams has a seed, however often the item leaked:
    with every 4th word replaced a quarter is kept. Copies without a common n-gram
    (every 3rd word replaced, for a score near 0.5) are not found. A filter of
    fixed size, all that tasks hold of the benchmark, finds possible seeds; around
    them a passage is cut with room for the longest item on both sides. Passages
    meet items by seed in a join, and each pair that has enough words in common is
    aligned by Smith-Waterman over words (match 2, mismatch and gap -1). Scores are
    divided by the score of an exact copy.

    Returns doc_id, item_id, score, end_word (word of the document behind the
    alignment), the best passage for each pair, where score >= least_score.
    Documents without such a passage have no row. Null texts are empty; rows that
    repeat an id count as one document; a null id is reported as null. Items with
    fewer words than a seed, or without id or text, match nothing. Empty tables
    give no rows. The result is written to the scratch folder.
    """
    spark = docs.sparkSession
    texts = in_small_batches(docs).select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    listed = benchmark.select(
        F.col(item_column).alias("item_id"), F.col(item_text_column).cast("string").alias("text")
    ).dropna()

    def item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = _words(batch.column("text"))
            grams, at = _grams(words, seed_words)
            cuts = np.searchsorted(words.doc, np.arange(batch.num_rows + 1))
            seed_cuts = np.searchsorted(at, cuts)
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": batch.column("item_id"),
                    "item": pa.array([words.hashes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    "grams": pa.array([grams[a:b].view(np.int64) for a, b in zip(seed_cuts, seed_cuts[1:])], pa.list_(pa.int64())),
                }
            )

    items = saved(listed.mapInArrow(item_words, f"item_id {listed.schema['item_id'].dataType.simpleString()}, item BINARY, grams ARRAY<BIGINT>"), "items")
    grams = items.select("item_id", F.explode(F.array_distinct("grams")).alias("hash"))
    longest = (items.agg(F.max(F.length("item"))).first()[0] or 0) // 8
    possible = spark.sparkContext.broadcast(_filter(grams))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            runs, _ = _grams(_words(batch.column("text")), seed_words)
            hit = runs[possible.value[(runs >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]]
            found, times = np.unique(hit, return_counts=True)
            yield pa.RecordBatch.from_pydict({"hash": pa.array(found.view(np.int64)), "times": pa.array(times)})

    counts = texts.mapInArrow(count, "hash BIGINT, times BIGINT").groupBy("hash").agg(F.sum("times").alias("times"))
    counted = saved(
        grams.join(counts, "hash", "left").select("item_id", "hash", F.coalesce("times", F.lit(0)).alias("times")), "gram-counts"
    )
    of_item = Window.partitionBy("item_id")
    ranked = counted.select(
        "*",
        F.row_number().over(of_item.orderBy(F.desc("times"), "hash")).alias("rank"),
        F.count("*").over(of_item).alias("n"),
        F.percentile("times", F.lit(0.5)).over(of_item).alias("median"),
    )
    set_aside = f"rank <= n div {_SET_ASIDE} AND times > {_FREQUENT} * (median + 1)"
    seeds = saved(ranked.where(f"times > 0 AND NOT ({set_aside})").select("hash", "item_id"), "seeds")
    seeded = spark.sparkContext.broadcast(_filter(seeds))
    room = longest + longest // 4 + seed_words

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = _words(batch.column("text"))
            runs, at = _grams(words, seed_words)
            keep = np.flatnonzero(seeded.value[(runs >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            if not keep.size:
                continue
            hit, place = runs[keep], at[keep]
            owner = words.doc[place]
            apart = np.flatnonzero((np.diff(place) > room) | (np.diff(owner) != 0)) + 1
            cuts = [0, *apart.tolist(), len(place)]
            first = np.searchsorted(words.doc, np.arange(batch.num_rows + 1))
            rows, starts, texts_, hashes = [], [], [], []
            for a, b in zip(cuts, cuts[1:]):
                doc = owner[a]
                start = max(first[doc], place[a] - room)
                end = min(first[doc + 1], place[b - 1] + seed_words + room)
                rows.append(doc)
                starts.append(start - first[doc])
                texts_.append(words.hashes[start:end].tobytes())
                hashes.append(np.unique(hit[a:b]).view(np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(rows)),
                    "start": pa.array(starts, pa.int64()),
                    "passage": pa.array(texts_, pa.binary()),
                    "hashes": pa.array(hashes, pa.list_(pa.int64())),
                }
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    cut = saved(
        texts.mapInArrow(passages, f"doc_id {id_type}, start BIGINT, passage BINARY, hashes ARRAY<BIGINT>").withColumn(
            "place", F.xxhash64("doc_id", "start", "passage")
        ),
        "passages",
    )
    candidates = cut.select("place", F.explode("hashes").alias("hash")).join(seeds, "hash").select("place", "item_id").distinct()
    pairs = (
        cut.drop("hashes")
        .join(candidates, "place")
        .join(items.select("item_id", "item"), "item_id")
        .select("doc_id", "item_id", "start", "passage", "item")
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, ends = [], []
            starts = batch.column("start").to_pylist()
            for start, item, passage in zip(starts, batch.column("item").to_pylist(), batch.column("passage").to_pylist()):
                wanted, found = np.frombuffer(item, np.uint64), np.frombuffer(passage, np.uint64)
                # No score is above the part of the item's words that the passage holds.
                near = np.isin(wanted, found).sum() >= least_score * len(wanted)
                best, end = _alignment(wanted, found) if near else (0, 0)
                scores.append(best / (_MATCH * len(wanted)))
                ends.append(start + end)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array(scores, pa.float64()), pa.array(ends, pa.int64())],
                names=["doc_id", "item_id", "score", "end_word"],
            )

    item_type = items.schema["item_id"].dataType.simpleString()
    found = (
        pairs.mapInArrow(align, f"doc_id {id_type}, item_id {item_type}, score DOUBLE, end_word BIGINT")
        .where(F.col("score") >= least_score)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("score", (-F.col("end_word")).alias("back"))).alias("best"))
        .select("doc_id", "item_id", F.col("best.score").alias("score"), (-F.col("best.back")).alias("end_word"))
    )
    result = saved(found, "contaminated")
    forget(items, counted, seeds, cut)
    return result


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """The documents without a contaminated passage; rows without an id stay."""
    return without(docs, contaminated_passages(docs, benchmark, id_column, **options).select("doc_id"), id_column)
