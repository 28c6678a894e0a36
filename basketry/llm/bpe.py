"""Byte-pair encoding by forced boundaries, and decoding.

A merge can only join bytes that stand next to each other inside some token. Where two neighbouring bytes of a text do
so in no token of the vocabulary, no token spans them: the text falls apart there, and the parts can be encoded
independently. The tokenizer also splits by a pattern before it merges; a cut must leave that split as it is, so cuts
are only made between characters, after one that is no white space, and not before an apostrophe (which may open a
contraction). Special tokens are parts of their own.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import words as w
from basketry.llm.common import each_piece, text_bytes, texts_of
from basketry.llm.tokens import fragment_ids, per_text, ragged


@functools.cache
def byte_of() -> dict[str, int]:
    """The alphabet of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.cache
def vocabulary(path: str) -> tuple[tuple[bytes, ...], tuple[bytes, ...]]:
    """The bytes of every id, and the special tokens as they stand in a text."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    size = 1 + max([*made["model"]["vocab"].values(), *(t["id"] for t in made["added_tokens"])])
    found = [b""] * size
    for token, k in made["model"]["vocab"].items():
        found[k] = bytes(byte_of()[c] for c in token)
    for token in made["added_tokens"]:
        found[token["id"]] = token["content"].encode()
    return tuple(found), tuple(t["content"].encode() for t in made["added_tokens"])


@functools.cache
def forced_pairs(path: str) -> np.ndarray:
    """For each pair of bytes (first * 256 + second) whether it occurs inside no token."""
    free = np.ones(1 << 16, bool)
    tokens, special = vocabulary(path)
    for token in tokens:
        if len(token) > 1 and token not in special:
            data = np.frombuffer(token, np.uint8).astype(np.int64)
            free[data[:-1] * 256 + data[1:]] = False
    return free


@functools.cache
def free_pairs(path: str) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of bytes whether a cut between them is certain, and whether it is if the byte before them is C3."""
    left, right = np.divmod(np.arange(1 << 16), 256)
    free = forced_pairs(path) & ~w.SPACE[left] & ((right & 0xC0) != 0x80) & (right != ord("'"))
    # The control characters 1C to 1F count as white space for some patterns.
    free &= (left < 0x1C) | (left > 0x1F)
    # Of characters beyond ASCII only those that begin with C3 (Latin letters) are surely no white space.
    return free & (left < 0x80), free & (left >= 0x80)


def cuts(data: np.ndarray, offsets: np.ndarray, path: str) -> np.ndarray:
    """Where the fragments of a batch of texts begin, and its end. Every text begins a fragment."""
    mark = np.zeros(len(data) + 1, bool)
    mark[offsets] = mark[len(data)] = True
    if len(data) < 2:
        return np.flatnonzero(mark)
    pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
    plain, latin = free_pairs(path)
    forced = plain[pairs]
    after = np.flatnonzero(data[:-2] == 0xC3) + 1
    forced[after] = latin[pairs[after]]
    whole = data.tobytes()
    special = re.compile(b"|".join(map(re.escape, sorted(vocabulary(path)[1], key=len, reverse=True))) or b"(?!)")
    marks = np.array([m.span() for m in special.finditer(whole)], np.int64).reshape(-1, 2)
    # a token lies in one text
    marks = marks[np.searchsorted(offsets, marks[:, 0], "right") == np.searchsorted(offsets, marks[:, 1] - 1, "right")]
    for first, last in marks.tolist():
        forced[first:last - 1] = False  # no cut inside
    mark[1:-1] |= forced
    mark[marks] = True
    return np.flatnonzero(mark)


def encode_column(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of texts, and the offsets of each text."""
    data, offsets = text_bytes(texts)
    at = cuts(data, offsets, path)
    ids, sizes = fragment_ids(path).of_spans(data, at[:-1], at[1:])
    return ids, per_text(sizes, np.searchsorted(at, offsets))


def encode(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text, as the tokenizer's file at ``path`` gives them.

    A null or empty text has no ids; null ids of documents and repeated rows pass through; an empty table gives an empty
    result; further columns are left out. The file must be on every executor at ``path``.
    """

    def make(piece):
        ids, offsets = encode_column(piece.column("text"), path)
        return {"doc_id": piece.column("doc_id"),
                "ids": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))}

    return each_piece(texts_of(documents, id_column, text_column), make, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``, the text of the ids, special tokens included.

    Bytes that are no UTF-8 become replacement characters; null or empty ids give an empty text; an older column of
    that name is replaced.
    """
    rest = [c for c in tokens.columns if c != "decoded"]

    def run(batches):
        table, _ = vocabulary(path)
        data = np.frombuffer(b"".join(table), np.uint8)
        starts = w.sums_before(np.array([len(t) for t in table], np.int64))
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                ids = part.column(ids_column)
                sizes = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()]) if ids.null_count else (
                    np.diff(ids.offsets.to_numpy()))
                at, lengths = ragged(starts, ids.flatten().to_numpy().astype(np.int64))
                whole = data[at].tobytes()
                ends = per_text(lengths, w.sums_before(sizes)).tolist()
                texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in rest), pa.array(texts, pa.string())], names=[*rest, "decoded"])

    schema = tokens.select(*[F.col(f"`{c}`") for c in rest]).schema.add("decoded", "string")
    return tokens.mapInArrow(run, schema)
