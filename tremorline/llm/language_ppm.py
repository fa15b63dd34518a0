"""Language identification by prediction by partial matching."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.llm.common import in_small_batches
from tremorline.llm.words import slices

# Training texts per language, chosen by hash, and languages, those with the most
# labelled rows: the bounds of the labelled sample.
DOCUMENTS_PER_LANGUAGE = 2000
MOST_LANGUAGES = 200

# Longest context in bytes.
ORDER = 3

# Different bytes that get a symbol of their own; others share one.
_OWN_BYTES = 95

# A context of the longest order is kept when seen this often in some language.
_LEAST_SEEN = 2

UNKNOWN = "und"

_LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_WORD_CHARACTER = re.compile(r"[^\W\d_]")


class PpmModel(NamedTuple):
    languages: list[str]
    symbols: np.ndarray  # byte -> symbol
    rows: np.ndarray  # the last ORDER symbols -> row of bits
    bits: np.ndarray  # (row * symbols + symbol, language) -> code length


def _normal(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS_ONLY)


def _has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _WORD_CHARACTER.finditer(text))


def _contexts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts behind ORDER spaces each; where each begins and ends."""
    lead = b" " * ORDER
    data = np.frombuffer(lead + lead.join(texts), np.uint8)
    ends = np.cumsum([len(t) + ORDER for t in texts])
    return data, ends - np.array([len(t) for t in texts]), ends


def train(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    documents_per_language: int = DOCUMENTS_PER_LANGUAGE,
    most_languages: int = MOST_LANGUAGES,
) -> PpmModel:
    """Count contexts over a bounded sample of labelled rows.

    Of each language, the rows are used whose hashed id lies below the cut that
    leaves documents_per_language of all its rows, give or take the hash's
    chance; all, if it has no more. Rows are filtered where they lie: no task
    sees a language whole. Texts are used whole, rows that repeat an id once;
    rows with a null id, text or language are not used, and neither are
    languages beyond the most_languages with the most rows. Counts are summed by
    Spark; the driver receives the different n-grams of the sample, so what it
    holds is bounded by the sample.
    """
    rows = in_small_batches(labelled).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(language_column).alias("language")
    ).dropna()
    sizes = rows.groupBy("language").count().orderBy(F.desc("count"), "language").limit(most_languages).collect()
    cuts = [
        (r.language, min(2**63 - 1, -(2**63) + 2**64 * documents_per_language // max(1, r["count"]))) for r in sizes
    ]
    # One row a language.
    cut = rows.sparkSession.createDataFrame(cuts, "language STRING, cut BIGINT")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names = batch.column("language").to_pylist()
            texts = [_normal(t) for t in batch.column("text").to_pylist()]
            for name in sorted(set(names)):
                data, starts, ends = _contexts([t for t, n in zip(texts, names) if n == name])
                wide = data.astype(np.uint32)
                grams = wide[ORDER:].copy()
                for back in range(1, ORDER + 1):
                    grams += wide[ORDER - back : len(wide) - back] << np.uint32(8 * back)
                own = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(own, starts, 1)
                np.add.at(own, ends, -1)
                found, times = np.unique(grams[np.cumsum(own)[ORDER:-1] > 0], return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "language": pa.array([name] * len(found), pa.string()),
                        "gram": pa.array(found.astype(np.int64)),
                        "times": pa.array(times.astype(np.int64)),
                    }
                )

    sample = rows.join(F.broadcast(cut), "language").where(F.xxhash64("id") <= F.col("cut")).dropDuplicates(["id", "language"])
    counted = (
        sample.select("id", "text", "language").mapInArrow(count, "language STRING, gram BIGINT, times BIGINT")
        .groupBy("language", "gram")
        .agg(F.sum("times").alias("times"))
        .toArrow()
    )
    return _compiled(
        counted.column("language").to_pylist(),
        counted.column("gram").to_numpy().astype(np.uint32),
        counted.column("times").to_numpy().astype(np.float64),
    )


def _compiled(language: list[str], grams: np.ndarray, times: np.ndarray) -> PpmModel:
    """Code lengths of every symbol in every kept context, escapes included.

    An unseen symbol costs the escape of its context and then its length in the
    next shorter one; escapes have the weight of the different symbols seen.
    """
    languages = sorted(set(language))
    which = np.searchsorted(languages, language) if languages else np.zeros(0, int)
    parts = np.stack([(grams >> np.uint32(8 * (ORDER - i))) & np.uint32(255) for i in range(ORDER + 1)]).astype(np.int64)
    seen = np.bincount(parts[-1], weights=times, minlength=256)
    own = np.argsort(-seen, kind="stable")[: min(_OWN_BYTES, int((seen > 0).sum()))]
    size = len(own) + 1
    symbols = np.full(256, size - 1, dtype=np.int64)
    symbols[own] = np.arange(len(own))
    parts = symbols[parts]
    rest = np.ones(size)
    rest[-1] = 256 - len(own)

    short = size ** (ORDER - 1)
    context = np.zeros(len(grams), dtype=np.int64)
    for i in range(ORDER):
        context = context * size + parts[i]
    kept = np.unique(context)
    place = np.searchsorted(kept, context)
    enough = np.zeros(len(kept), dtype=bool)
    table = np.zeros((len(languages), len(kept) + short, size), dtype=np.float32)
    for k in range(len(languages)):
        mine = which == k
        lower = np.full((1, size), 1.0 / size)
        for order in range(ORDER + 1):
            if order < ORDER:
                of = context[mine] % size**order
                cells = size**order
                parent = np.arange(cells) % max(1, size ** max(0, order - 1))
            else:
                of, cells, parent = place[mine], len(kept), kept % short
            counts = np.bincount(of * size + parts[-1][mine], weights=times[mine], minlength=cells * size).reshape(cells, size)
            total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
            base = lower[parent] if order else lower
            weight = np.maximum(total + kinds, 1)
            escape = np.where(total > 0, kinds / weight, 1.0)
            chance = np.where(counts > 0, counts / weight, escape * base)
            if order == ORDER:
                enough |= total[:, 0] >= _LEAST_SEEN
                table[k, : len(kept)] = -np.log2(chance / rest)
            elif order == ORDER - 1:
                table[k, len(kept) :] = -np.log2(chance / rest)
            lower = chance
    rows = len(kept) + np.arange(size**ORDER, dtype=np.int64) % short
    rows[kept[enough]] = np.flatnonzero(enough)
    used = np.concatenate((np.flatnonzero(enough), len(kept) + np.arange(short)))
    number = np.zeros(len(kept) + short, dtype=np.int32)
    number[used] = np.arange(len(used))
    bits = np.ascontiguousarray(table[:, used].transpose(1, 2, 0)).reshape(len(used) * size, len(languages))
    return PpmModel(languages, symbols, number[rows], bits)


def identify(docs: DataFrame, model: PpmModel, text_column: str = "text", with_length: bool = False) -> DataFrame:
    """Add lang_pred and score: the language with the shortest code length.

    with_length: also add code_bits, that length, and code_bytes, the bytes coded.

    score is that language's posterior under equal priors. Texts that are null or
    have no letter, and all texts under a model without languages, are `und`
    with score 0. Ties go to the smaller language. Columns of docs named like the
    added ones are replaced; an empty table gives no rows. A text is scored
    whole, by itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # plain: workers need no class
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    if with_length:
        added += [T.StructField("code_bits", T.DoubleType()), T.StructField("code_bytes", T.LongType())]
    kept = [f for f in docs.schema.fields if f.name.lower() not in {a.name for a in added}]
    names = [f.name for f in kept]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, symbols, rows, bits = shared.value
        size = int(round(len(rows) ** (1 / ORDER)))
        for batch in slices(batches, text_column):
            raw = [t or "" for t in batch.column(text_column).to_pylist()]
            data, starts, ends = _contexts([_normal(t) for t in raw])
            sym = symbols[data]
            state = np.zeros(max(0, len(sym) - ORDER), dtype=np.int64)
            for back in range(ORDER, 0, -1):
                state = state * size + sym[ORDER - back : len(sym) - back]
            cell = rows[state].astype(np.int64) * size + sym[ORDER:]
            labels, scores, spent, sizes = [], [], [], (ends - starts).tolist()
            for text, start, end in zip(raw, starts - ORDER, ends - ORDER):
                if not languages or not _has_letter(text):
                    labels.append(UNKNOWN)
                    scores.append(0.0)
                    spent.append(None)
                    continue
                lengths = bits[cell[start:end]].sum(axis=0, dtype=np.float64)
                best = int(lengths.argmin())
                labels.append(languages[best])
                spent.append(float(lengths[best]))
                scores.append(float(1 / np.exp2(np.maximum(lengths[best] - lengths, -1000)).sum()))
            columns = [batch.column(n) for n in names] + [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            if with_length:
                columns += [pa.array(spent, pa.float64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *(f.name for f in added)])

    return in_small_batches(docs).mapInArrow(score, T.StructType([*kept, *added]))


# How many times the usual code length a text may have, and bits on top for short ones.
LOOSENESS = 2.0
SLACK_BITS = 64.0
_USUAL = 0.99


def usual_lengths(judged: DataFrame, language_column: str = "lang") -> dict[str, float]:
    """Per language the code length a byte that 99 of 100 of its labelled texts keep to.

    judged: labelled rows that the model was not trained on, with their lengths;
    all of them count. One number a language comes to the driver.
    """
    right = judged.where((F.col(language_column) == F.col("lang_pred")) & (F.col("code_bytes") > 0))
    usual = F.percentile_approx(F.col("code_bits") / F.col("code_bytes"), _USUAL, 10_000)
    return {r[0]: r[1] for r in right.groupBy("lang_pred").agg(usual).collect()}


def readable_documents(
    docs: DataFrame,
    least_score: float = 0.5,
    looseness: float = LOOSENESS,
    slack_bits: float = SLACK_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    **options,
) -> DataFrame:
    """The documents whose language is recognised, with the columns they have.

    Rejected are texts without a letter, those of which no learned language has
    at least least_score, and those whose code is longer than looseness times
    what is usual for the predicted language, plus slack_bits: keyboard noise
    and languages that were not learned. The model is trained on the labelled
    ones among the documents but for a quarter, by crc32 of the id, which tells
    what is usual. A language with no text in that quarter has no such bound;
    without labelled documents only texts without a letter are rejected. Null
    texts and languages are no labelled rows, repeated rows are judged alike.
    """
    added = {"lang_pred", "score", "code_bits", "code_bytes"}
    clash = {c: f"_kept_{c}" for c in docs.columns if c.lower() in added}
    held_out = F.coalesce(F.crc32(F.col(id_column).cast("string")) % 4 == 2, F.lit(False))
    model = train(docs.where(~held_out), id_column, text_column, language_column, **options)
    if not model.languages:
        return docs.where(F.col(text_column).rlike(r"\p{L}"))
    narrow = docs.where(held_out & F.col(language_column).isin(model.languages)).select(
        F.col(text_column).alias("text"), F.col(language_column).alias("lang")
    )
    usual = usual_lengths(identify(narrow, model, with_length=True))
    most = [slack_bits + looseness * usual[name] * F.col("code_bytes") for name in model.languages if name in usual]
    bound = F.lit(float("inf"))
    for name, bits in zip([n for n in model.languages if n in usual], most):
        bound = F.when(F.col("lang_pred") == name, bits).otherwise(bound)
    judged = identify(docs.withColumnsRenamed(clash), model, text_column, with_length=True)
    known = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score) & (F.col("code_bits") <= bound))
    return known.select(*[F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns])
