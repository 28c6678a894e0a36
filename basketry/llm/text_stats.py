"""Counts of a text that quality rules and the quality classifier use, for a batch of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from basketry.llm import words as w
from basketry.llm.common import text_bytes


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


UPPER, LOWER, DIGIT = (_table("".join(map(chr, range(ord(a), ord(b) + 1)))) for a, b in ("AZ", "az", "09"))
SYMBOL, END, MARK = _table("#*$%&|<>"), _table(".!?"), _table("!")

COUNTS = (
    "n_chars n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper n_letters n_digits n_marks "
    "n_ends n_distinct n_other".split()
)


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The columns of ``COUNTS``, one entry per text.

    ``n_dup_lines``: lines with a word that equal an earlier line. ``n_repeat_words``: words inside a window of three
    words that occurs at least twice. ``n_letters`` and ``n_upper`` are ASCII letters, ``n_other`` code points beyond
    ASCII, ``n_ends`` words that end a sentence.
    """
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    starts, ends, doc = w.spans(data, offsets)
    point = (data & 0xC0) != 0x80
    per_word = lambda flags: np.bincount(doc[flags], minlength=n).astype(np.int64)
    word_hash = w.hashes(data, starts, ends)
    first, window = w.window_hashes(word_hash, doc, 3)
    again, _ = w.repeats(doc[first], window)
    inside = np.zeros(len(starts) + 3, bool)
    for k in range(3):
        inside[first[again] + k] = True
    _, seen = w.repeats(doc, word_hash)
    line_start, line_end, line_doc = w.line_spans(data, offsets)
    solid = w.sums_before((~w.SPACE[data]).astype(np.int64))
    full = solid[line_end] > solid[line_start]
    _, copy = w.repeats(line_doc[full], w.hashes(data, line_start[full], line_end[full]))
    return {
        "n_chars": w.per_text(point, offsets),
        "n_words": per_word(np.ones(len(starts), bool)),
        "word_chars": w.per_text(point & ~w.SPACE[data], offsets),
        "n_symbols": w.per_text(SYMBOL[data], offsets),
        "n_lines": np.bincount(line_doc[full], minlength=n).astype(np.int64),
        "n_dup_lines": np.bincount(line_doc[full][copy], minlength=n).astype(np.int64),
        "n_repeat_words": per_word(inside[:len(starts)]),
        "n_upper": w.per_text(UPPER[data], offsets),
        "n_letters": w.per_text(UPPER[data] | LOWER[data], offsets),
        "n_digits": w.per_text(DIGIT[data], offsets),
        "n_marks": w.per_text(MARK[data], offsets),
        "n_ends": per_word(END[data[ends - 1]]) if len(ends) else np.zeros(n, np.int64),
        "n_distinct": per_word(~seen),
        "n_other": w.per_text(point & (data >= 0x80), offsets),
    }
