"""Simple-8b: numbers packed into 64-bit words, each word led by a selector.

A selector of four bits tells how many numbers share the other 60 bits. Blocks
of BLOCK numbers are packed by themselves, so a block can be decoded alone.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512

# Fixed values of the code: numbers in a word, and bits of each, by selector.
# Selector 0 is the escape: the next word is one number of up to 64 bits.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
_LAST = 14  # selector 15 is not used

_SHIFT = np.uint64(60)
_NEAR = 8  # numbers that most words hold at most


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits of each number; 0 needs 1."""
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.maximum(np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]), 1).astype(np.int8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of each block and the end) of uint64 values.

    All blocks advance together, one word a step: each takes the selector that
    packs most of its next numbers.
    """
    total = len(values)
    blocks = -(-total // BLOCK)
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    ends = np.minimum(at + BLOCK, total)
    # Behind a block's end, numbers count as narrow: the last word may be short.
    bits = np.zeros(total + 64, dtype=np.int8)
    bits[:total] = _bit_lengths(values)
    padded = np.concatenate((values.astype(np.uint64), np.zeros(64, np.uint64)))
    owners, packed = [], []
    live = np.arange(blocks)
    ahead = np.arange(60)
    while live.size:
        start, left = at[live], ends[live] - at[live]
        near = bits[start[:, None] + ahead[:_NEAR]] * (ahead[:_NEAR] < left[:, None])
        widest = np.maximum.accumulate(near, axis=1)
        selector = np.full(len(live), _LAST)
        for s in range(_LAST - 1, 6, -1):
            selector[widest[:, COUNTS[s] - 1] <= WIDTHS[s]] = s
        dense = np.flatnonzero(widest[:, _NEAR - 1] <= WIDTHS[6])
        if dense.size:
            far = bits[start[dense, None] + ahead] * (ahead < left[dense, None])
            far = np.maximum.accumulate(far, axis=1)
            for s in range(6, 0, -1):
                selector[dense[far[:, COUNTS[s] - 1] <= WIDTHS[s]]] = s
        selector[widest[:, 0] > WIDTHS[_LAST]] = 0
        word = np.zeros(len(live), dtype=np.uint64)
        took = np.minimum(np.maximum(COUNTS[selector], 1), left)
        for s in np.unique(selector):
            rows = np.flatnonzero(selector == s)
            if s == 0:
                continue
            count, width = int(COUNTS[s]), int(WIDTHS[s])
            group = padded[start[rows, None] + ahead[:count]]
            group = np.where(ahead[:count] < left[rows, None], group, np.uint64(0))
            shifts = (np.arange(count) * width).astype(np.uint64)
            word[rows] = np.bitwise_or.reduce(group << shifts, axis=1) | (np.uint64(s) << _SHIFT)
        owners.append(live)
        packed.append(word)
        escaped = np.flatnonzero(selector == 0)
        if escaped.size:
            owners.append(live[escaped])
            packed.append(padded[start[escaped]])
        at[live] += took
        live = live[at[live] < ends[live]]
    owner = np.concatenate([*owners, np.zeros(0, np.int64)]).astype(np.int64)
    words = np.concatenate([*packed, np.zeros(0, np.uint64)])
    order = np.argsort(owner, kind="stable")
    return words[order], np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=blocks)))).astype(np.int64)


def _raw_words(selectors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True for words that an escape announces."""
    raw = np.zeros(len(selectors), dtype=bool)
    for i in np.flatnonzero(selectors == 0):
        if not raw[i]:
            raw[i + 1] = True
    return raw


def decode(words: np.ndarray, offsets: np.ndarray, total: int) -> np.ndarray:
    """The values again; offsets as encode gave them."""
    blocks = len(offsets) - 1
    selectors = (words >> _SHIFT).astype(np.int64)
    escapes = bool((selectors == 0).any())
    raw = _raw_words(selectors, offsets) if escapes else np.zeros(len(words), dtype=bool)
    counts = np.where(raw, 1, COUNTS[selectors])
    sizes = np.full(blocks, BLOCK)
    if blocks:
        sizes[-1] = total - BLOCK * (blocks - 1)
        # The last word of a block may hold fewer numbers than its selector says.
        counts[offsets[1:] - 1] -= np.add.reduceat(counts, offsets[:-1]) - sizes
    place = np.cumsum(counts) - counts
    out = np.zeros(total, dtype=np.uint64)
    out[place[raw]] = words[raw]
    for s in np.unique(selectors[~raw]):
        rows = np.flatnonzero((selectors == s) & ~raw)
        if s == 0:
            continue
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        shifts = (np.arange(count) * width).astype(np.uint64)
        group = (words[rows, None] >> shifts) & np.uint64((1 << width) - 1)
        inside = np.arange(count) < counts[rows, None]
        out[(place[rows, None] + np.arange(count))[inside]] = group[inside]
    return out
