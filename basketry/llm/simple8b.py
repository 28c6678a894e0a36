"""Simple-8b: whole numbers packed into 64-bit words, as many to a word as their size allows, over numpy arrays.

The upper four bits of a word select a shape, a number of ids and the bits each takes of the other sixty. A number that
doesn't fit its shape is written as all ones, an escape, and stands in a list beside the words. Each word takes the
shape that costs the fewest bits per id, escapes included. Decoding handles all words of one shape at once.
"""

from __future__ import annotations

import numpy as np

#: Ids in a word and bits of each, by selector from 1 on; 0 selects nothing, so that blank space is no word.
SHAPES = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30),
          (1, 60))
COUNTS = np.array([0, *(count for count, _ in SHAPES), 0], np.int64)
#: From this number on an id is an escape in a word of that selector.
LIMITS = np.array([0, *((1 << bits) - 1 for _, bits in SHAPES), 0], np.uint64)
ESCAPE_BITS = 32


def _selectors(padded: np.ndarray, n: int) -> np.ndarray:
    """The cheapest selector for a word that begins at each of the first ``n`` numbers; of equal ones the fullest."""
    best = np.full(n, np.iinfo(np.int32).max, np.int32)
    escapes = np.zeros(len(padded) + 1, np.int32)
    for k, (count, _) in enumerate(SHAPES, 1):
        np.cumsum(padded >= int(LIMITS[k]), out=escapes[1:])
        # bits per id as a whole number (the counts divide 840), the selector in the lowest four bits
        cost = escapes[count:count + n] - escapes[:n]
        cost *= ESCAPE_BITS * (840 // count) << 4
        cost += (64 * (840 // count) << 4) + k
        np.minimum(best, cost, out=best)
        if not escapes[-1]:
            break  # all fit: a wider shape only holds fewer
    return best & 15


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (64 bits) and escapes (32 bits) of ``ids`` below 2**32; the last word may be filled up with zeros."""
    n = len(ids)
    padded = np.zeros(n + int(COUNTS.max()), np.uint32)
    padded[:n] = ids
    best = _selectors(padded, n)
    follows, at, starts = (np.arange(n) + COUNTS[best]).tolist(), 0, []
    while at < n:
        starts.append(at)
        at = follows[at]
    starts = np.array(starts, np.int64)
    selectors = best[starts].astype(np.int64)
    words = selectors.astype(np.uint64) << np.uint64(60)
    for k in np.unique(selectors).tolist():
        count, bits = SHAPES[k - 1]
        of = np.flatnonzero(selectors == k)
        values = np.minimum(padded[starts[of][:, None] + np.arange(count)].astype(np.uint64), LIMITS[k])
        words[of] |= np.bitwise_or.reduce(values << (np.arange(count) * bits).astype(np.uint64), axis=1)
    limits = LIMITS[np.repeat(selectors, COUNTS[selectors])[:n]]
    return words, ids[padded[:n] >= limits].astype(np.uint32)


def decode(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``words`` and ``escapes``, as unsigned 32-bit numbers."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    ends = np.cumsum(counts)
    if not counts.all() or len(words) and not ends[-1] - counts[-1] < n <= ends[-1] or not len(words) and n:
        raise ValueError("these words don't hold that many ids")
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    escaped = np.zeros(len(out), bool)
    for k in np.unique(selectors).tolist():
        count, bits = SHAPES[k - 1]
        of = np.flatnonzero(selectors == k)
        values = (words[of][:, None] >> (np.arange(count) * bits).astype(np.uint64)) & LIMITS[k]
        at = (ends[of] - count)[:, None] + np.arange(count)
        out[at], escaped[at] = values, values == LIMITS[k]
    where = np.flatnonzero(escaped[:n])
    if len(where) != len(escapes):
        raise ValueError("the escapes don't match the words")
    out = out[:n].astype(np.uint32)
    out[where] = escapes
    return out
