"""Words and shingles as 64-bit hashes, whole batches at a time (numpy in tasks)."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes of text worked on at once; a longer text is worked on by itself.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_LONG_WORD = 4096
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, one per word
    doc: np.ndarray  # index of the word's text
    starts: np.ndarray  # byte range of the word in data
    ends: np.ndarray
    data: bytes


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return memory that earlier work freed, but that this worker still holds, to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of bounded text."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)
    give_back()


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes; null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def split_words(texts: list[bytes]) -> Words:
    """Words of all texts, by ASCII white space, hashed as they are."""
    data = b"\n" + b"\n".join(texts) + b"\n" + bytes(8)
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[raw[:-8]]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    doc_starts = 1 + np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else lengths
    doc = np.searchsorted(doc_starts, starts, side="right") - 1

    eight = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    size = ends - starts
    hashes = mixed((eight[starts] & _KEEP[np.minimum(size, 8)]) + size.astype(np.uint64) * _STEP)
    more, at = np.flatnonzero((size > 8) & (size <= _LONG_WORD)), 8
    while more.size:
        part = eight[starts[more] + at] & _KEEP[np.minimum(size[more] - at, 8)]
        hashes[more] = mixed(hashes[more] * _STEP + part)
        at += 8
        more = more[size[more] > at]
    for i in np.flatnonzero(size > _LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return Words(hashes, doc, starts, ends, data)


def marks(words: Words, at: np.ndarray) -> np.ndarray:
    """Length, first and last eight bytes of the words at `at`, one row a word."""
    starts, ends = words.starts[at], words.ends[at]
    size = ends - starts
    eight = np.ndarray((len(words.data) - 7,), dtype="<u8", buffer=words.data, strides=(1,))
    head = eight[starts] & _KEEP[np.minimum(size, 8)]
    tail = np.where(size > 8, eight[np.maximum(ends - 8, 0)], 0)
    return np.stack((size.astype(np.uint64), head, tail), axis=1) if len(at) else np.zeros((0, 3), np.uint64)


def same_words(words: Words, other: np.ndarray) -> bool:
    """Whether every word equals the one at `other`: length, first and last bytes."""
    own = marks(words, np.arange(len(words.starts)))
    return np.array_equal(own, own[other])


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` words, whatever texts they lie in."""
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = mixed(out * _STEP + hashes[k : k + n])
    return out


def shingles(words: Words, texts: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of all shingles, in order of texts, repeats included.

    A text with fewer words than width gives its whole sequence as one; one
    without words gives none.
    """
    runs = windows(words.hashes, width)
    doc = words.doc
    inside = doc[: len(runs)] == doc[width - 1 :] if len(runs) else np.zeros(0, dtype=bool)
    counts = np.bincount(doc, minlength=texts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    firsts = np.concatenate(([0], np.cumsum(counts)))
    whole = np.array(
        [windows(words.hashes[firsts[i] : firsts[i + 1]], int(counts[i]))[0] for i in short], dtype=np.uint64
    )
    hashes = np.concatenate((runs[inside], whole))
    owner = np.concatenate((doc[: len(runs)][inside], short))
    order = np.argsort(owner, kind="stable")
    return hashes[order], owner[order]
