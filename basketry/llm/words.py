"""Words, lines and rolling hashes over a whole batch of texts at once, in numpy.

A word is a run of bytes other than space and tab to carriage return. Words and lines of a batch are told apart by their
bytes, and each distinct one is hashed once (XXH3). Windows of words are hashed as polynomials modulo 2**64 over these
hashes, taken from running sums, so that any window costs two look-ups (the Rabin-Karp identity). Such a polynomial is
safe only over values that are themselves well mixed, and is never taken over bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

WORD_BASE = 0xD6E8FEB86659FD93
#: Windows of at most so many words are hashed word by word.
FEW = 8

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd ``base`` modulo 2**64, and of its inverse."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())

        def table(b: int) -> np.ndarray:
            out = np.ones(size, np.uint64)
            done = 1
            while done < size:  # doubling: the second half is the first times base**done
                out[done:2 * done] = out[:done] * np.uint64(pow(b, done, 1 << 64))
                done *= 2
            return out

        have = table(base), table(pow(base, -1, 1 << 64))
        if size <= 1 << 21:  # a longer text gets tables of its own, which go with it
            _powers[base] = have
    return have[0][:n], have[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def sums_before(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=out[1:])
    return out


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[starts[i]:ends[i]]``, the same wherever the stretch lies."""
    up, down = powers(base, len(values) + 1)
    sums = sums_before(values * up[:len(values)])
    return (sums[ends] - sums[starts]) * down[starts]


def spans(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word; ``space`` says which bytes are between words."""
    solid = ~space[data]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the parts between line feeds."""
    breaks = np.flatnonzero(data == 0x0A)
    ends = np.concatenate([breaks, offsets[1:]])
    doc = np.concatenate([np.searchsorted(offsets, breaks, "right") - 1, np.arange(len(offsets) - 1)])
    order = np.lexsort((ends, doc))
    doc, ends = doc[order], ends[order]
    starts = np.empty_like(ends)
    starts[1:] = ends[:-1] + 1
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    starts[first] = offsets[doc[first]]
    return starts, ends, doc


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct stretches of bytes, and which of them each stretch is. Stretches are in order and don't overlap."""
    solid, offsets = data, sums_before(ends - starts)
    if offsets[-1] < len(data):
        edges, real = np.zeros(len(data) + 1, np.int8), ends > starts
        edges[starts[real]] += 1
        edges[ends[real]] -= 1
        solid = data[np.cumsum(edges[:-1], dtype=np.int8).view(bool)]
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(solid))]
    ).dictionary_encode()
    values = found.dictionary
    at = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1].tolist()
    whole = values.buffers()[2].to_pybytes() if at[-1:] and at[-1] else b""
    return [whole[a:b] for a, b in zip(at, at[1:])], found.indices.to_numpy().astype(np.int64)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes."""
    values, which = distinct(data, starts, ends)
    return np.array([xxhash.xxh3_64_intdigest(v) for v in values], np.uint64)[which]


def chained(word_hashes: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of ``sizes[i]`` words from ``first[i]`` on, mixed word by word; for sequences of a few words."""
    out = np.zeros(len(first), np.uint64)
    for k in range(int(sizes.max(initial=0))):
        on = np.flatnonzero(sizes > k)
        out[on] = mixed(out[on] * np.uint64(WORD_BASE) + word_hashes[first[on] + k] + np.uint64(1))
    return out


def window_hashes(word_hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of ``width`` words that lies in one text."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(doc[:n] == doc[width - 1:])
    if width <= FEW:
        return starts, chained(word_hashes, starts, np.full(len(starts), width))
    return starts, mixed(stretch_hashes(word_hashes, starts, starts + width, WORD_BASE))


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    sums = sums_before(flags.astype(np.int64))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeats(doc: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: whether its key occurs again in its text, and whether it occurred earlier in it."""
    again, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys):
        order = np.lexsort((keys, doc))
        same = (doc[order][1:] == doc[order][:-1]) & (keys[order][1:] == keys[order][:-1])
        again[order[1:][same]] = True
        earlier[order[1:][same]] = True
        again[order[:-1][same]] = True
    return again, earlier
