"""Language-model scores from a probabilistic suffix tree.

The tree predicts the next word from the bytes before it: its contexts are
suffixes of what precedes, of no to DEPTH bytes, so the end of an unknown word
still tells something. A frequent word is a symbol of its own; the others share
a symbol by their last two bytes and are told apart by their counts.

Symbols are few whatever the corpus: more words of their own, 19,203 instead of 325
on the fixture, told held-out texts worse, 12.97 bits a token instead of 12.72.
Pairs of context and symbol are as many as the divergence test keeps. They are a
distributed table: the part that is most often asked for goes to every task, the
rest is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import forget, in_small_batches, saved
from tremorline.llm.words import _STEP, Words, mixed, slices, split_words, utf8

# Longest context in bytes, behind the space that ends the last word; 7 fit in a number.
DEPTH = 5

# A word with at least this part of all tokens is a symbol of its own, so there
# are at most 4096 of them.
_OWN_SYMBOL = 2.0**-12

# Symbols for the other words.
_ENDINGS = 1024

# A pair of context and symbol is told by its context when seen so often.
_LEAST_PAIR = 2

# A context stays when telling its next symbols by the next shorter one would
# cost at least so many bits more over the training texts.
LEAST_GAIN_BITS = 64.0

# Least weight, in symbols, of the shorter context in a context's distribution;
# the number of different next symbols if that is more.
_PRIOR = 8.0

# Most frequent words whose counts every task holds: 8 MB; most frequent pairs: 24 MB.
# The others are joined.
HEAD_WORDS = 1 << 19
HEAD_PAIRS = 1 << 21

# Slots of the filter that tells whether a pair may be among the others: 16 MB.
_SLOTS = 1 << 27

# Different words, or pairs, that a task counts before it passes them on.
_PENDING = 1 << 20

_A_TO_Z = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_END_WORD = np.uint64(0)
_LINE_FEED = 10


class TextModel(NamedTuple):
    words: DataFrame  # (hash, times, ending) of all training words
    train_tokens: int
    train_words: int  # different ones
    own: np.ndarray  # sorted hashes of the words with a symbol of their own
    endings: np.ndarray  # log10 of the counts that share each ending
    root: np.ndarray  # log10 probability of every symbol without a context
    mass: float  # what (count + 0.5) sums to over all symbols
    states: list[np.ndarray]  # by depth from 1: sorted contexts that are kept
    escapes: list[np.ndarray]  # by depth: log10 weight of the shorter context
    pairs: DataFrame  # (depth, key, times, cost) of kept pairs; key: hash of context and symbol


def _words(column: pa.Array) -> Words:
    """A-Z in lower case, words parted by one space, a line feed behind each text."""
    return split_words([b" ".join(t.translate(_A_TO_Z).split()) for t in utf8(column)])


def _ending(raw: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The ending of tokens whose last byte lies at `last`."""
    tail = raw[last].astype(np.uint64) | (raw[last - 1].astype(np.uint64) << np.uint64(8))
    return (mixed(tail) % np.uint64(_ENDINGS)).astype(np.int64)


def _tokens(words: Words, texts: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token, ends of texts included and in order: word hash, text,
    symbol, and the DEPTH bytes before it.

    A context does not reach beyond the text: a line feed stands for its start.
    """
    raw = np.frombuffer(words.data, np.uint8)
    ends = np.flatnonzero(raw[1:-8] == _LINE_FEED)[:texts] + 1
    at = np.concatenate((words.starts, ends))
    doc = np.concatenate((words.doc, np.arange(texts)))
    hashes = np.concatenate((words.hashes, np.full(texts, _END_WORD)))
    last = np.concatenate((words.ends, ends)) - 1
    place = np.minimum(np.searchsorted(own, hashes), max(0, len(own) - 1))
    is_own = own[place] == hashes if len(own) else np.zeros(len(hashes), dtype=bool)
    symbol = np.where(is_own, place, len(own) + _ending(raw, last))
    # What stands before a word is a space, before the end of a text its last word.
    shift = np.concatenate((np.full(len(words.starts), 2), np.full(texts, 1)))
    context = np.zeros(len(at), dtype=np.int64)
    open_ = np.ones(len(at), dtype=bool)
    for back in range(DEPTH):
        byte = raw[np.maximum(at - shift - back, 0)].astype(np.int64)
        if back == 0:
            first = raw[at - 1] == _LINE_FEED
            byte = np.where(first, _LINE_FEED, byte)
        context += np.where(open_, byte, 0) << (8 * back)
        open_ &= byte != _LINE_FEED
    order = np.argsort(doc, kind="stable")
    return hashes[order], doc[order], symbol[order], context[order]


def _pair_key(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mixed(context.view(np.uint64) * _STEP + symbol.view(np.uint64)).view(np.int64)


def _counted(texts: DataFrame, found_in, keys: list[str], marks: list[str]) -> DataFrame:
    """(keys, times, marks) of what found_in finds in all texts: a number that stands
    for the keys, then keys and marks."""
    columns = [*keys, *marks]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [np.zeros(0, np.int64)] * (2 + len(columns))
        held = none

        def batch_of(held: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(dict(zip(("times", *columns), map(pa.array, held[1:]))))

        for batch in slices(batches, "text"):
            number, *rest = found_in(_words(batch.column("text")), batch.num_rows)
            found, at, n = np.unique(number, return_index=True, return_counts=True)
            number, times, *rest = [np.concatenate(c) for c in zip(held, (found, n, *(c[at] for c in rest)))]
            order = np.argsort(number, kind="stable")
            firsts = np.flatnonzero(np.concatenate(([True], np.diff(number[order]) != 0)))
            held = [number[order[firsts]], np.add.reduceat(times[order], firsts), *(c[order[firsts]] for c in rest)]
            if len(held[0]) > _PENDING:
                yield batch_of(held)
                held = none
        yield batch_of(held)

    counts = texts.mapInArrow(count, ", ".join(f"{c} BIGINT" for c in ("times", *columns)))
    return counts.groupBy(*keys).agg(F.sum("times").alias("times"), *(F.min(c).alias(c) for c in marks))


def train(docs: DataFrame, text_column: str = "text") -> TextModel:
    """Count all words, then all contexts with their next symbols, of all texts.

    Word counts, contexts and pairs are distributed tables, and so is the work on
    them. The driver receives a number for each symbol, of which there are at most
    5120, and the kept contexts, each of which saves LEAST_GAIN_BITS.
    """
    spark = docs.sparkSession
    texts = in_small_batches(docs).select(F.col(text_column).cast("string").alias("text"))

    def word_keys(words: Words, n: int) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(words.data, np.uint8)
        ends = np.flatnonzero(raw[1:-8] == _LINE_FEED)[:n] + 1
        last = np.concatenate((words.ends, ends)) - 1
        hashes = np.concatenate((words.hashes, np.full(n, _END_WORD))).view(np.int64)
        return hashes, hashes, _ending(raw, last)

    counted = saved(_counted(texts, word_keys, ["hash"], ["ending"]), "word-counts")
    tokens, different = counted.agg(F.coalesce(F.sum("times"), F.lit(0)), F.count("*")).first()
    is_own = F.col("times") >= max(1.0, tokens * _OWN_SYMBOL)
    frequent = counted.where(is_own).select("hash").toArrow()
    own = np.sort(frequent.column("hash").to_numpy().view(np.uint64))
    shared = spark.sparkContext.broadcast(own)
    size = len(own) + _ENDINGS

    def pair_keys(words: Words, n: int) -> tuple[np.ndarray, ...]:
        _, _, symbol, context = _tokens(words, n, shared.value)
        return _pair_key(context, symbol), context, symbol

    pairs = saved(_counted(texts, pair_keys, ["context", "symbol"], []), "context-counts")
    # What (count + 0.5) sums to over the words of each ending, an unknown one included.
    endings = np.full(_ENDINGS, 0.5)
    for row in counted.where(~is_own).groupBy("ending").agg(F.sum(F.col("times") + 0.5).alias("sum")).collect():
        endings[row["ending"]] += row["sum"]
    levels = _levels(pairs)
    symbols = saved(levels[0].groupBy("symbol").agg(F.sum("times").alias("times")), "symbol-counts")
    times = symbols.toArrow()
    root = np.full(size, 0.5)
    root[times.column("symbol").to_numpy()] += times.column("times").to_numpy()
    mass = float(root.sum())
    shorter = symbols.select(
        F.lit(0).cast("bigint").alias("suffix"), F.col("symbol").alias("suffix_symbol"), F.log10((F.col("times") + 0.5) / mass).alias("short")
    )
    states, escapes, kept = _grown(levels, shorter)
    forget(*levels)
    return TextModel(counted, tokens, different, own, np.log10(endings), np.log10(root / mass), mass, states, escapes, kept)


def _suffix(depth: int) -> Column:
    return F.col("context").bitwiseAND(F.lit((1 << (8 * depth)) - 1).cast("bigint"))


def _levels(pairs: DataFrame) -> list[DataFrame]:
    """(context, symbol, times) by depth from 1; each is summed from the next deeper one."""
    levels = [pairs]
    for depth in range(DEPTH - 1, 0, -1):
        sums = levels[0].groupBy(_suffix(depth).alias("context"), "symbol").agg(F.sum("times").alias("times"))
        levels.insert(0, saved(sums, "level-counts"))
    return levels


def _grown(levels: list[DataFrame], shorter: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], DataFrame]:
    """Keep contexts by their divergence; smooth each by its suffix.

    P(symbol | context) = (count + weight * P(symbol | suffix)) / (total + prior),
    where the count of a pair seen less than _LEAST_PAIR times is 0, and weight is
    the prior and all such counts: the probabilities of a context add up to 1. A
    context that is not kept is told by its suffix.

    A pair seen so seldom counts in its context's total alone, and what is longer
    is seen no more often: such pairs need no row of their own here. Contexts are
    few beside pairs and go to every task.
    """
    often = F.col("times") >= _LEAST_PAIR
    states, escapes, kept_pairs, done = [], [], [], []
    for depth, counted in enumerate(levels, 1):
        of_context = counted.groupBy("context").agg(
            F.sum("times").alias("total"),
            F.sum(F.when(often, F.col("times")).otherwise(0)).alias("held"),
            F.greatest(F.lit(_PRIOR), F.count_if(often).cast("double")).alias("more"),
        )
        bottom, weight = F.col("total") + F.col("more"), F.col("total") - F.col("held") + F.col("more")
        level = saved(
            counted.where(often)
            .join(shorter, (_suffix(depth - 1) == F.col("suffix")) & (F.col("symbol") == F.col("suffix_symbol")))
            .join(F.broadcast(of_context.where("held > 0")), "context")
            .withColumn("escape", F.log10(weight / bottom))
            .withColumn("cost", F.log10((F.col("times") + weight * F.pow(F.lit(10.0), "short")) / bottom))
            .withColumn("rest", F.col("total") - F.col("held"))
            .select("context", "symbol", "times", "rest", "short", "escape", "cost"),
            "tree-level",
        )
        gain = F.sum(F.col("times") * (F.col("cost") - F.col("short"))) + F.first("rest") * F.first("escape")
        of_level = level.groupBy("context").agg(F.first("escape").alias("escape"), (gain * float(np.log2(10))).alias("gain"))
        kept = saved(of_level.where(F.col("gain") >= LEAST_GAIN_BITS).select("context", "escape"), "tree-contexts")
        found = kept.toArrow()
        order = np.argsort(found.column("context").to_numpy())
        states.append(found.column("context").to_numpy()[order])
        escapes.append(found.column("escape").to_numpy()[order])
        done += [level, kept]
        marked = level.drop("escape").join(F.broadcast(kept.select("context", F.lit(True).alias("kept"))), "context", "left")
        kept_pairs.append(marked.where("kept").select(F.lit(depth).alias("depth"), "context", "symbol", "times", "cost"))
        shorter = marked.select(
            F.col("context").alias("suffix"),
            F.col("symbol").alias("suffix_symbol"),
            F.when(F.col("kept"), F.col("cost")).otherwise(F.col("short")).alias("short"),
        )

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = _pair_key(batch.column("context").to_numpy(), batch.column("symbol").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("depth"), pa.array(key), *batch.columns[3:]], ["depth", "key", "times", "cost"])

    every = kept_pairs[0]
    for pairs in kept_pairs[1:]:
        every = every.unionByName(pairs)
    every = saved(every.mapInArrow(keyed, "depth INT, key BIGINT, times BIGINT, cost DOUBLE"), "tree-pairs")
    forget(*done)
    return states, escapes, every


def _look_up(context, symbol, root, states, escapes, pairs, costs, others) -> tuple[np.ndarray, list[tuple]]:
    """log10 probability of each symbol behind each context of DEPTH bytes.

    The longest kept suffix tells; what it has not kept costs its escape and is
    told by the next shorter one, at last without a context. pairs and costs are
    the most frequent ones by depth; a pair that is not found may still be among
    the others where their filter, if there are any, says so. Also gives these
    doubts: (token, depth, key, what the pair's cost has to be raised by to
    replace the result).
    """
    out = np.zeros(len(context))
    open_, doubts = np.arange(len(context)), []
    for depth in range(len(states), 0, -1):
        if not len(states[depth - 1]) or not len(open_):
            continue
        suffix = context[open_] & ((1 << (8 * depth)) - 1)
        at = np.minimum(np.searchsorted(states[depth - 1], suffix), len(states[depth - 1]) - 1)
        there = np.flatnonzero(states[depth - 1][at] == suffix)
        token = open_[there]
        wanted = _pair_key(suffix[there], symbol[token])
        found = np.zeros(len(there), dtype=bool)
        if len(pairs[depth - 1]):
            place = np.minimum(np.searchsorted(pairs[depth - 1], wanted), len(pairs[depth - 1]) - 1)
            found = pairs[depth - 1][place] == wanted
            out[token[found]] += costs[depth - 1][place[found]]
        if others is not None:
            slot = wanted & (_SLOTS - 1)
            doubted = np.flatnonzero(~found & ((others[slot >> 3] >> (slot & 7).astype(np.uint8) & 1) == 1))
            doubts.append((token[doubted], depth, wanted[doubted], out[token[doubted]].copy()))
        out[token[~found]] += escapes[depth - 1][at[there[~found]]]
        told = np.zeros(len(open_), dtype=bool)
        told[there[found]] = True
        open_ = open_[~told]
    out[open_] += root[symbol[open_]]
    return out, [(token, depth, key, before - out[token]) for token, depth, key, before in doubts]


def _cut(table: DataFrame, limit: int) -> Column:
    """The condition for the most frequent rows, at most limit of them.

    The cut is a power of 2 ** 0.25 taken from a table of at most 256 rows.
    """
    step = F.floor(F.log2(F.col("times").cast("double")) * 4).cast("int")
    steps = table.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    cut, room = 1 << 30, limit
    for row in sorted(steps, reverse=True):
        if row["n"] > room:
            break
        cut, room = row["step"], room - row["n"]
    return step >= cut


def _head(words: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words, at most limit, by hash."""
    head = words.where(_cut(words, limit)).select("hash", "times").toArrow()
    hashes = head.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], head.column("times").to_numpy()[order]


def _head_pairs(pairs: DataFrame, limit: int) -> tuple[list[np.ndarray], list[np.ndarray], DataFrame | None, np.ndarray | None]:
    """Keys and costs by depth of the most frequent pairs; the others, if there are
    any, and a filter of as many bits as there are slots: those of their keys are set."""
    frequent = _cut(pairs, limit)
    head = pairs.where(frequent).select(F.col("depth").cast("tinyint").alias("depth"), "key", F.col("cost").cast("float").alias("cost")).toArrow()
    depth, key, cost = (head.column(c).to_numpy() for c in ("depth", "key", "cost"))
    keys, costs = [], []
    for d in range(1, DEPTH + 1):
        mine = np.flatnonzero(depth == d)
        mine = mine[np.argsort(key[mine])]
        keys.append(key[mine])
        costs.append(cost[mine])
    rest = pairs.where(~frequent)
    if rest.isEmpty():
        return keys, costs, None, None
    # Bit positions count from 1.
    slot = F.pmod("key", F.lit(_SLOTS)) + 1
    bitmaps = (
        rest.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bitmap"))
        .toArrow()
    )
    filter_ = np.zeros(_SLOTS // 8, np.uint8)
    for bucket, bitmap in zip(bitmaps.column("bucket").to_pylist(), bitmaps.column("bitmap")):
        bits = np.frombuffer(bitmap.as_buffer(), np.uint8)
        filter_[(bucket - 1) * len(bits) : bucket * len(bits)] = bits
    return keys, costs, rest, filter_


def score(
    docs: DataFrame,
    model: TextModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    head_words: int = HEAD_WORDS,
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """Score whole texts under the tree and under the word counts.

    Every word, and the end of the text, is told by the longest kept suffix of
    what precedes it. The counts of frequent words and the costs of frequent pairs
    are at hand in the task; the other words of each text meet the table of counts
    in a join on their hash, pairs in doubt that of pairs, and are summed per row. A null text is empty: its only token is its end.

    Returns the other columns of docs with n_tokens, n_known, train_tokens,
    base_score and score added, replacing columns of those names. Repeated rows
    are scored each; an empty table gives no rows; without training texts base
    scores are 0 and all symbols alike.
    """
    spark = docs.sparkSession
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    mass = model.mass
    kept = [c for c in docs.columns if c.lower() not in {*added, text_column.lower()}]
    head = _head(model.words, head_words)
    keys, costs, other_pairs, others = _head_pairs(model.pairs, head_pairs)
    tree = (model.root, model.states, model.escapes, keys, costs, others)
    shared = spark.sparkContext.broadcast((*head, model.own, model.endings, *tree))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, own, endings, *tree = shared.value
        logs = np.log10(counts + 0.5)
        own_logs = tree[0] + np.log10(mass)
        for batch in slices(batches, "text"):
            n = batch.num_rows
            hashes, doc, symbol, context = _tokens(_words(batch.column("text")), n, own)
            cost, doubts = _look_up(context, symbol, *tree)
            token, depth, key, change = (
                np.concatenate([np.zeros(0, kind), *(np.broadcast_to(d[i], len(d[0])) for d in doubts)], dtype=kind)
                for i, kind in enumerate((np.int32, np.int32, np.int64, np.float32))
            )
            by_text = np.argsort(doc[token], kind="stable")
            token, depth, key, change = token[by_text], depth[by_text], key[by_text], change[by_text]
            shares = symbol >= len(own)
            cost[shares] -= endings[symbol[shares] - len(own)]
            count, common = np.zeros(len(hashes)), ~shares
            count[common] = own_logs[symbol[common]]
            if len(known):
                place = np.flatnonzero(shares)
                at = np.minimum(np.searchsorted(known, hashes[place]), len(known) - 1)
                here = known[at] == hashes[place]
                common[place[here]] = True
                count[place[here]] = logs[at[here]]
            # Words with a symbol of their own count in the base alone.
            told = np.where(shares, count, 0.0)
            rare, cuts = hashes[~common], np.searchsorted(doc[~common], np.arange(n + 1))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"),
                    "n_tokens": pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                    "seen": pa.array(np.bincount(doc[common], minlength=n).astype(np.int64)),
                    "base": pa.array(np.bincount(doc, weights=count, minlength=n)),
                    "score": pa.array(np.bincount(doc, weights=cost + told, minlength=n)),
                    "rare": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(rare.view(np.int64))),
                    "doubts": pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(doc[token], np.arange(n + 1)), pa.int32()),
                        pa.StructArray.from_arrays(list(map(pa.array, (token, depth, key, change))), ["token", "depth", "key", "change"]),
                    ),
                }
            )

    numbered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("other"), F.col(text_column).cast("string").alias("text")
    ).withColumn("row", F.struct(F.monotonically_increasing_id().alias("id"), "other"))
    row_type = numbered.schema["row"].dataType.simpleString()
    judged = saved(
        numbered.select("row", "text").mapInArrow(
            judge,
            f"row {row_type}, n_tokens BIGINT, seen BIGINT, base DOUBLE, score DOUBLE, rare ARRAY<BIGINT>,"
            " doubts ARRAY<STRUCT<token: INT, depth: INT, key: BIGINT, change: FLOAT>>",
        ),
        "judged",
    )
    rare = judged.select(F.col("row.id").alias("id"), F.explode("rare").alias("hash"))
    found = rare.join(model.words, "hash", "left").groupBy("id").agg(
        F.count("times").alias("rare_seen"),
        F.sum(F.log10(F.coalesce("times", F.lit(0)) + 0.5)).alias("rare_base"),
    )
    if other_pairs is not None:
        # Of a token's pairs that are there after all, the deepest tells.
        asked = judged.select(F.col("row.id").alias("id"), F.explode("doubts").alias("doubt")).select("id", "doubt.*")
        there = asked.join(other_pairs.select("depth", "key", "cost"), ["depth", "key"])
        change = F.col("cost") + F.col("change")
        told = there.groupBy("id", "token").agg(*(F.max(F.when(F.col("depth") == d, change)).alias(f"at_{d}") for d in range(1, DEPTH + 1)))
        told = told.select("id", F.coalesce(*(f"at_{d}" for d in range(DEPTH, 0, -1))).alias("change"))
        changes = told.groupBy(F.col("id").alias("changed")).agg(F.sum("change").alias("change"))
        judged = judged.join(changes, F.col("row.id") == F.col("changed"), "left").withColumn(
            "score", F.col("score") + F.coalesce("change", F.lit(0.0))
        )
    rare_base = F.coalesce("rare_base", F.lit(0.0))
    size = float(np.log10(model.train_tokens + 0.5 * (model.train_words + 1)))
    return judged.join(found, F.col("row.id") == F.col("id"), "left").select(
        *[F.col(f"row.other.`{c}`").alias(c) for c in kept],
        "n_tokens",
        (F.col("seen") + F.coalesce("rare_seen", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + rare_base - F.col("n_tokens") * size).alias("base_score"),
        (F.col("score") + rare_base).alias("score"),
    )
