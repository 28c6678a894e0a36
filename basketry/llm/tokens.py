"""Token ids of many short fragments, each distinct fragment encoded once per worker.

A 64-bit hash finds a fragment in an open hash table held in numpy arrays, its bytes confirm it. So a million fragments
take little memory and look-ups run over whole batches.
"""

from __future__ import annotations

import os

import numpy as np
import xxhash

from basketry.llm import words as w
from basketry.llm.words import sums_before

#: Distinct fragments a worker remembers; beyond that it starts anew.
REMEMBERED = 1_000_000
SLOTS = 1 << 21


def ragged(offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists laid end to end (``offsets``), where the items of the lists ``rows`` are, and the lists' sizes."""
    sizes = offsets[rows + 1] - offsets[rows]
    ahead = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(offsets[rows] - ahead, sizes), sizes


class Growing:
    """A numpy array that grows at its end, by doubling."""

    def __init__(self, kind) -> None:
        self.data, self.size = np.zeros(1024, kind), 0

    def extend(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            bigger = np.zeros(max(2 * len(self.data), end), self.data.dtype)
            bigger[:self.size] = self.data[:self.size]
            self.data = bigger
        self.data[self.size:end] = values
        self.size = end

    @property
    def values(self) -> np.ndarray:
        return self.data[:self.size]


class FragmentIds:
    """Ids of byte fragments by a tokenizer of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)  # 0: free
        self.rows = np.zeros(SLOTS, np.int32)
        self.bytes, self.ends = Growing(np.uint8), Growing(np.int64)
        self.ids, self.offsets = Growing(np.int32), Growing(np.int64)
        for growing in (self.ends, self.offsets):
            growing.extend(np.zeros(1, np.int64))

    @property
    def known(self) -> int:
        return self.ends.size - 1

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for unknown ones."""
        found = np.full(len(keys), -1, np.int64)
        left, slot = np.arange(len(keys)), (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        while len(left):
            here = self.keys[slot]
            hit = here == keys[left]
            found[left[hit]] = self.rows[slot[hit]]
            on = ~hit & (here != 0)
            left, slot = left[on], (slot[on] + 1) & (SLOTS - 1)
        return found

    def _enter(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Puts new keys into free slots; where several want one slot, the last gets it and the others go on."""
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        while len(keys):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[free]
            self.rows[slot[free]] = rows[free]
            on = self.keys[slot] != keys
            keys, rows, slot = keys[on], rows[on], (slot[on] + 1) & (SLOTS - 1)

    def _same(self, rows: np.ndarray, fragments: list[bytes]) -> np.ndarray:
        """Whether the known fragments ``rows`` have the bytes of ``fragments``."""
        at, sizes = ragged(self.ends.values, rows)
        lengths = np.array([len(f) for f in fragments], np.int64)
        same = sizes == lengths
        kept = np.repeat(same, sizes)
        given = np.frombuffer(b"".join([f for f, s in zip(fragments, same.tolist()) if s]), np.uint8)
        differs = np.repeat(np.flatnonzero(same), sizes[same])[self.bytes.values[at[kept]] != given]
        same[differs] = False
        return same

    def _learn(self, fragments: list[bytes]) -> np.ndarray:
        """Encodes fragments and returns their new rows."""
        encoded = self.tokenizer.encode([f.decode() for f in fragments], is_pretokenized=True, add_special_tokens=False)
        sizes = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(fragments))
        rows = np.arange(self.known, self.known + len(fragments))
        self.ends.extend(self.ends.values[-1] + np.cumsum([len(f) for f in fragments], dtype=np.int64))
        self.bytes.extend(np.frombuffer(b"".join(fragments), np.uint8))
        self.ids.extend(np.array(encoded.ids, np.int32))
        self.offsets.extend(self.offsets.values[-1] + np.cumsum(sizes))
        return rows

    def of_spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the fragments ``data[starts[k]:ends[k]]`` in order, and how many each fragment has."""
        fragments, which = w.distinct(data, starts, ends)
        keys = np.maximum(np.array([xxhash.xxh3_64_intdigest(f) for f in fragments], np.uint64), 1)
        rows = self._look_up(keys)
        found = np.flatnonzero(rows >= 0)
        rows[found[~self._same(rows[found], [fragments[k] for k in found.tolist()])]] = -1
        new = np.flatnonzero(rows < 0)
        if len(new):
            if self.known and self.known + len(new) > REMEMBERED:
                self._forget()
                return self.of_spans(data, starts, ends)
            learnt = self._learn([fragments[k] for k in new.tolist()])
            if self.known <= REMEMBERED:  # else one batch alone is too large for the table
                self._enter(keys[new], learnt)
            rows[new] = learnt
        at, sizes = ragged(self.offsets.values, rows[which])
        ids = self.ids.values[at]
        if self.known > REMEMBERED:
            self._forget()
        return ids, sizes

    def of(self, fragments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a list of fragments, and how many each has."""
        ends = np.cumsum([len(f) for f in fragments], dtype=np.int64)
        sizes = np.array([len(f) for f in fragments], np.int64)
        return self.of_spans(np.frombuffer(b"".join(fragments), np.uint8), ends - sizes, ends)


_known: dict[str, FragmentIds] = {}


def fragment_ids(path: str) -> FragmentIds:
    """One per worker process and tokenizer file."""
    if path not in _known:
        _known[path] = FragmentIds(path)
    return _known[path]


def per_text(sizes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Offsets of texts in the ids, where text k owns the fragments from ``firsts[k]`` to ``firsts[k + 1]``."""
    return sums_before(sizes.astype(np.int64))[firsts]
