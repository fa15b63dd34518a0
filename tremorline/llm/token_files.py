"""Token files: texts encoded to ids, packed by Simple-8b, in order of documents."""

from __future__ import annotations

import importlib.util
import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import in_small_batches, saved, shuffle_partitions
from tremorline.llm.simple8b import decode as unpack
from tremorline.llm.simple8b import encode as pack
from tremorline.llm.words import SLICE_BYTES, marks, same_words, slices, split_words, utf8
from tremorline.session import scratch_path

END_ID = 1

# Words whose ids a worker remembers: about 130 MB of arrays.
_REMEMBERED = 2_000_000

# A file is a run of groups, each a header and four arrays: the documents' ids,
# which of them are null, their token counts, block offsets, packed words.
_MAGIC = b"S8BT"
_HEADER = "<4sqqqq"


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


# How a lower-case tokenizer of whole words prepares its input.
_LOWER_CASE = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
_WHOLE_WORDS = [("Split", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"), ("ByteLevel", None)]

# A word of Latin letters, perhaps with one full stop or comma behind it.
_LATIN_WORD = r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)"


def _parts(config: dict | None, inner: str) -> list[tuple[str, str | None]]:
    steps = (config or {}).get(inner, [])
    return [(step["type"], (step.get("pattern") or {}).get("Regex")) for step in steps]


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 as it is, other bytes from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


def _tokenizer(tokenizer_path: str):
    """The tokenizer, and whether it takes runs of letters whole and drops white
    space before anything else: then a text's ids are those of its words in turn."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    config = json.loads(tokenizer.to_str())
    by_words = (
        _parts(config["normalizer"], "normalizers") == _LOWER_CASE
        and _parts(config["pre_tokenizer"], "pretokenizers") == _WHOLE_WORDS
        and not any(t["content"].isalpha() for t in config["added_tokens"])
    )
    return tokenizer, by_words


def _encoder_of_words(tokenizer) -> Callable[[list[str]], list[list[int]]]:
    """A function from words, free of white space, to the ids of each.

    For tokenizers that lower case and take runs of letters whole: a Latin word
    needs no more than the library's BPE model itself, lowered, in byte letters.
    Everything else goes through the whole tokenizer.
    """
    import re

    latin, letters = re.compile(_LATIN_WORD), _byte_letters()
    stops = {m: tokenizer.encode(m, add_special_tokens=False).ids if m else [] for m in ("", ".", ",")}

    def whole(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]

    def encode(words: list[str]) -> list[list[int]]:
        remembered: dict[str, list[int]] = {}
        out: list = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            match = latin.fullmatch(word)
            if match is None:
                rest.append(i)
                continue
            core, stop = match.groups()
            core = core.lower()
            ids = remembered.get(core)
            if ids is None:
                spelt = core if core.isascii() else core.encode().decode("latin-1").translate(letters)
                ids = remembered[core] = [t.id for t in tokenizer.model.tokenize(spelt)]
            out[i] = ids + stops[stop] if stop else ids
        for i, ids in zip(rest, whole([words[i] for i in rest])):
            out[i] = ids
        return out

    return encode


def text_encoder(tokenizer_path: str, remembered: int = _REMEMBERED) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """A function from texts to (all ids, ids of each text), special tokens not added.

    Where the tokenizer works by words, each different word is encoded once. Words
    are told apart by their hash, length, first and last eight bytes, those of
    earlier batches too, about as many as are remembered. Any other tokenizer
    encodes every text whole.
    """
    tokenizer, by_words = _tokenizer(tokenizer_path)
    return _by_words(tokenizer, remembered) if by_words else _by_texts(tokenizer)


def _flat(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, count=len(found))
    return np.fromiter(itertools.chain.from_iterable(found), np.uint32, count=int(sizes.sum())), sizes


def _by_texts(tokenizer) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([e.ids for e in tokenizer.encode_batch([t.decode("utf-8") for t in texts], add_special_tokens=False)])

    return encode


def _by_words(tokenizer, remembered: int) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    encode_words = _encoder_of_words(tokenizer)
    known, places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts, lengths, ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    looks = np.zeros((0, 3), np.uint64)

    def one_by_one(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([[i for w in encode_words([w.decode("utf-8") for w in t.split()]) for i in w] for t in texts])

    def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        nonlocal known, places, starts, lengths, ids, looks
        words = split_words(texts)
        unique, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        if not same_words(words, first[inverse]):
            return one_by_one(texts)
        if len(known) > remembered:
            known, places, starts, lengths, ids, looks = known[:0], places[:0], starts[:0], lengths[:0], ids[:0], looks[:0]
        at = np.minimum(np.searchsorted(known, unique), max(0, len(known) - 1))
        seen = known[at] == unique if len(known) else np.zeros(len(unique), dtype=bool)
        if not np.array_equal(looks[places[at[seen]]], marks(words, first[seen])):
            return one_by_one(texts)
        new = np.flatnonzero(~seen)
        if len(new):
            data = words.data
            spelt = [data[a:b].decode("utf-8") for a, b in zip(words.starts[first[new]], words.ends[first[new]])]
            found, sizes = _flat(encode_words(spelt))
            places = np.concatenate((places, len(lengths) + np.arange(len(new))))
            starts = np.concatenate((starts, len(ids) + np.cumsum(sizes) - sizes))
            lengths = np.concatenate((lengths, sizes))
            ids = np.concatenate((ids, found))
            looks = np.concatenate((looks, marks(words, first[new])))
            known = np.concatenate((known, unique[new]))
            order = np.argsort(known)
            known, places = known[order], places[order]
            at = np.searchsorted(known, unique)
        place = places[at][inverse] if len(known) else np.zeros(0, np.int64)
        size = lengths[place]
        ends = np.cumsum(size)
        flat = ids[np.repeat(starts[place] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        in_text = np.cumsum(np.concatenate(([0], np.bincount(words.doc, minlength=len(texts)))))
        return flat, np.diff(np.concatenate(([0], ends))[in_text])

    return encode


_ENCODERS: dict[tuple[str, int], Callable] = {}


def lasting_encoder(tokenizer_path: str, remembered: int = _REMEMBERED) -> Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]:
    """text_encoder, kept for later tasks of a worker on which this package is installed."""
    if importlib.util.find_spec("tremorline") is None:
        return text_encoder(tokenizer_path, remembered)
    installed = importlib.import_module("tremorline.llm.token_files")
    if (tokenizer_path, remembered) not in installed._ENCODERS:
        installed._ENCODERS[tokenizer_path, remembered] = installed.text_encoder(tokenizer_path, remembered)
    return installed._ENCODERS[tokenizer_path, remembered]


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    slice_bytes: int = 2 * SLICE_BYTES,
    remembered: int = _REMEMBERED,
) -> DataFrame:
    """Encode texts and write their ids to files in ascending order of ids.

    Documents are range-partitioned and sorted by id; each task writes one file,
    group by group, so it holds a slice of texts at a time, and what it remembers
    of words: less of both takes less memory and more time. Every document ends
    with end_id, also an empty or null one. Null ids come first, rows that repeat
    an id stay together. A task that is run again writes a file of another name;
    the files that count are those of the returned manifest, which is itself
    written to the scratch folder: file, place, documents, ids.
    """
    rows = in_small_batches(docs).select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sink, first, documents, total = f"{uuid.uuid4().hex}.s8b", None, None, 0, 0
        # Each slice's new words are sorted in among the remembered ones: rather fewer slices.
        for batch in slices(batches, "text", slice_bytes):
            if sink is None:
                encode = lasting_encoder(tokenizer_path, remembered)
                store, path = store_of(folder)
                store.create_dir(path, recursive=True)
                sink = store.open_output_stream(f"{path}/{name}")
                first = batch.column("doc_id")[0].as_py()
            flat, sizes = encode(utf8(batch.column("text")))
            ends = np.cumsum(sizes)
            tokens = np.insert(flat.astype(np.uint64), ends, np.uint64(end_id))
            words, offsets = pack(tokens)
            column = batch.column("doc_id")
            sink.write(struct.pack(_HEADER, _MAGIC, batch.num_rows, len(tokens), len(offsets), len(words)))
            for array in (
                column.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"),
                column.is_null().to_numpy(zero_copy_only=False).astype("u1"),
                (sizes + 1).astype("<i8"),
                offsets.astype("<i8"),
                words.astype("<u8"),
            ):
                sink.write(array.tobytes())
            documents, total = documents + batch.num_rows, total + len(tokens)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "file": [f"{folder}/{name}"],
                    "first_id": pa.array([first], pa.int64()),
                    "documents": pa.array([documents], pa.int64()),
                    "ids": pa.array([total], pa.int64()),
                }
            )

    ordered = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    written = saved(ordered.mapInArrow(write, "file STRING, first_id BIGINT, documents BIGINT, ids BIGINT"), "token-manifest")
    # One row per file: the running total over files is small.
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) from the files of a manifest.

    tokens are the ids as little-endian unsigned 32-bit numbers; start counts the
    ids of all documents before. A task reads a file group by group.
    """
    files = shuffle_partitions(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                store, path = store_of(file)
                with store.open_input_stream(path) as source:
                    while header := source.read(struct.calcsize(_HEADER)):
                        magic, documents, total, marks, words = struct.unpack(_HEADER, header)
                        if magic != _MAGIC:
                            raise ValueError(f"{file} is not a token file")
                        ids, null, sizes, offsets, packed = (
                            np.frombuffer(source.read(n * np.dtype(kind).itemsize), kind)
                            for n, kind in ((documents, "<i8"), (documents, "u1"), (documents, "<i8"), (marks, "<i8"), (words, "<u8"))
                        )
                        tokens = unpack(packed, offsets, total).astype("<u4")
                        ends = np.cumsum(sizes)
                        yield pa.RecordBatch.from_pydict(
                            {
                                "doc_id": pa.array(ids, mask=null.astype(bool)),
                                "start": pa.array(start + ends - sizes),
                                "n_tokens": pa.array(sizes),
                                "tokens": pa.array([tokens[e - s : e].tobytes() for s, e in zip(sizes, ends)], pa.binary()),
                            }
                        )
                        start += total

    return (
        manifest.select("file", "start")
        .repartition(files)
        .mapInArrow(read, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, tokens BINARY")
    )


def token_index(docs: DataFrame, tokenizer_path: str, folder: str | None = None, **options) -> DataFrame:
    """Write the documents' token files and return what reading them back gives:
    doc_id, start, n_tokens and ids_crc32 of every document. An empty table
    writes no file and gives no rows."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    tokens = read_token_files(write_token_files(docs, folder, tokenizer_path, **options))
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))
