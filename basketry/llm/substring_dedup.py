"""Exact removal of repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

Tasks hash all windows of a chunk of documents. Inside a chunk only the occurrences in the smallest document of a
window can still be first anywhere, so the others are settled at once and a passage that a third of all documents
share costs a chunk one entry. Those left travel to a bucket of the hash space as ten bytes plus the gap to the
previous one; the bucket answers which occur in a smaller document. Answers return to their chunk, where windows merge
into maximal intervals of words.

Windows count as equal if two polynomials of different bases over their words' hashes agree, in 64 and in 16 bits: with n
windows about n * n / 2**81 pairs do so by chance (0.00004 among 10**10 windows).
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import blobs
from basketry.llm import words as w
from basketry.llm.common import by_key, groups_of, partitions, pieces, record_batch, stored, text_bytes

#: Words that a task hashes before it sends them; a longer document goes alone.
CHUNK_WORDS = 1_000_000
#: Bytes of text whose windows one bucket takes up.
BUCKET_BYTES = 8_000_000
#: Stands for a null id: larger than any other.
LAST = np.iinfo(np.int64).max

#: Base of the second polynomial.
CHECK_BASE = 0xA0761D6478BD642F

_SENT = "bucket int, chunk long, hashes binary, checks binary, at binary, ids binary, counts binary"


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _loose(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _chunks(batches, width: int):
    """Ids, text keys, first word of each document, and the windows, of about ``CHUNK_WORDS`` words each."""
    parts, n_words = [], 0
    for piece in pieces(batches):
        data, offsets = text_bytes(piece.column("text"))
        starts, ends, doc = w.spans(data, offsets)
        word_hash = w.hashes(data, starts, ends)
        at, hashes = w.window_hashes(word_hash, doc, width)
        checks = (w.mixed(w.stretch_hashes(word_hash, at, at + width, CHECK_BASE)) >> np.uint64(48)).astype(np.uint16)
        ids = piece.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        parts.append((ids, piece.column("text_key").to_numpy(), np.bincount(doc, minlength=len(ids)), at + n_words,
                      hashes, checks))
        n_words += len(starts)
        if n_words >= CHUNK_WORDS:
            yield parts
            parts, n_words = [], 0
    if parts:
        yield parts


def _late(hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each window also starts in a document with a smaller id among these."""
    order = np.lexsort((ids, checks, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    late = np.zeros(len(ids), bool)
    late[order[ids[order] > least]] = True
    return late


def repeated_words(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_key, cuts`` for documents (doc_id, text, text_key) that lose words.

    ``cuts`` holds the maximal intervals as pairs of four-byte word numbers, start and end.
    """
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(partitions(documents.sparkSession), -(-size // BUCKET_BYTES))
    kind = "u1" if n_buckets <= 200 else "<u2"

    def send(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, parts in enumerate(_chunks(batches, width)):
            ids, keys, sizes, at, hashes, checks = (np.concatenate(x) for x in zip(*parts))
            chunk = (task << 24) + number
            doc = np.searchsorted(np.cumsum(sizes), at, "right")
            copies = _late(hashes, checks, ids[doc])
            yield record_batch({
                "bucket": pa.array([-1 - task % n_buckets], pa.int32()), "chunk": pa.array([chunk]),
                "hashes": pa.array([_squeezed(keys)]), "checks": pa.array([None], pa.binary()), "at": pa.array([blobs.pack(at[copies], "<u2")]),
                "ids": pa.array([_squeezed(ids)]), "counts": pa.array([_squeezed(sizes.astype(np.int64))]),
            })
            at, hashes, checks, doc = at[~copies], hashes[~copies], checks[~copies], doc[~copies]
            bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            for k in np.flatnonzero(cuts[1:] > cuts[:-1]):
                part = order[cuts[k]:cuts[k + 1]]
                owners, counts = np.unique(doc[part], return_counts=True)
                yield record_batch({
                    "bucket": pa.array([k], pa.int32()), "chunk": pa.array([chunk]),
                    "hashes": pa.array([hashes[part].tobytes()]), "checks": pa.array([checks[part].tobytes()]),
                    "at": pa.array([blobs.pack(at[part], kind)]),
                    "ids": pa.array([_squeezed(np.diff(ids[owners], prepend=0))]),
                    "counts": pa.array([_squeezed(counts.astype(np.uint32))]),
                })

    def answer(batches):
        for bucket, rows in groups_of(batches, "bucket"):
            if bucket < 0:
                for row in rows:
                    yield record_batch({k: pa.array([v], pa.int64() if k == "chunk" else pa.binary())
                                        for k, v in row.items() if k != "bucket"})
                continue
            hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) for r in rows])
            ids = np.concatenate([
                np.repeat(np.cumsum(_loose(r["ids"], np.int64)), _loose(r["counts"], np.uint32)) for r in rows])
            late = _late(hashes, np.concatenate([np.frombuffer(r["checks"], np.uint16) for r in rows]), ids)
            ends = np.cumsum([len(r["hashes"]) // 8 for r in rows])
            for row, end in zip(rows, ends):
                flags = late[end - len(row["hashes"]) // 8:end]
                if flags.any():
                    yield record_batch({
                        "chunk": pa.array([row["chunk"]]), "hashes": pa.array([None], pa.binary()),
                        "checks": pa.array([None], pa.binary()),
                        "at": pa.array([blobs.pack(blobs.unpack(row["at"], kind)[flags], "<u2")]),
                        "ids": pa.array([None], pa.binary()), "counts": pa.array([None], pa.binary()),
                    })

    def merge(batches):
        for _, rows in groups_of(batches, "chunk"):
            head = next(r for r in rows if r["ids"] is not None)
            ids, keys, sizes = (_loose(head[k], np.int64) for k in ("ids", "hashes", "counts"))
            edges = np.zeros(int(sizes.sum()) + 1, np.int32)
            for row in rows:
                at = blobs.unpack(row["at"], "<u2")
                np.add.at(edges, at, 1)
                np.add.at(edges, at + width, -1)
            gone = np.cumsum(edges[:-1]) > 0
            first = np.cumsum(sizes) - sizes
            step = np.diff(gone.astype(np.int8), prepend=0, append=0)
            inner = first[(first > 0) & (first < len(gone))]  # an interval ends with its document
            split = inner[gone[inner] & gone[inner - 1]]
            starts = np.sort(np.concatenate([np.flatnonzero(step == 1), split]))
            ends = np.sort(np.concatenate([np.flatnonzero(step == -1), split]))
            owner = np.searchsorted(first + sizes, starts, "right")
            pairs = np.column_stack([starts - first[owner], ends - first[owner]]).astype("<u4")
            docs, where = np.unique(owner, return_index=True)
            if len(docs):
                yield record_batch({
                    "doc_id": pa.array(ids[docs], mask=ids[docs] == LAST), "text_key": keys[docs],
                    "cuts": pa.array([p.tobytes() for p in np.split(pairs, where[1:])], pa.binary()),
                })

    sent = documents.select("doc_id", "text", "text_key").mapInArrow(send, _SENT)
    answered = by_key(sent, "bucket", "chunk").mapInArrow(answer, _SENT.split(", ", 1)[1])
    return by_key(answered, "chunk").mapInArrow(merge, "doc_id long, text_key long, cuts binary")


def cut(text: bytes, cuts: bytes | None) -> tuple[int, int, bytes]:
    """Words, words removed and the words kept, joined by a space."""
    words = text.split()
    if not cuts:
        return len(words), 0, b" ".join(words)
    pairs = np.frombuffer(cuts, "<u4").reshape(-1, 2)
    edges = [0, *pairs.ravel().tolist(), len(words)]
    kept = list(itertools.chain.from_iterable(words[a:b] for a, b in zip(edges[::2], edges[1::2])))
    return len(words), len(words) - len(kept), b" ".join(kept)


def remove_repeats(
    documents: DataFrame, width: int = 50, id_column: str = "doc_id", text_column: str = "text",
    names: tuple[str, str, str] = ("n_words", "n_removed", "kept"),
) -> DataFrame:
    """``documents`` with ``names``, by default ``n_words``, ``n_removed`` (long) and ``kept``: each text without its
    repeated words.

    A word goes if it lies in a window of ``width`` words that also starts in a document with a smaller id; windows
    are judged on the input. A null text has no words; a null id counts as larger than any other; rows of one id are
    one document (neither loses words to the other); equal rows give equal rows; an empty table gives an empty result.
    Further columns stay as they are, but for older ones with these three names.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    own = documents.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), text.alias("text"),
                           F.xxhash64(text).alias("text_key"))
    cuts = stored(repeated_words(own, width), "repeats")
    cuts = cuts.groupBy("doc_id", "text_key").agg(F.first("cuts").alias("__cuts"))
    cuts = cuts.withColumnsRenamed({"doc_id": "__id", "text_key": "__key"})
    rest = [c for c in documents.columns if c not in names]
    rows = documents.select(*[F.col(f"`{c}`") for c in rest])
    same = F.col("__id").eqNullSafe(F.col(f"`{id_column}`").cast("long")) & (F.col("__key") == F.xxhash64(text))
    # The cuts grow with the documents, so they are merged at every size, never broadcast.
    rows = rows.join(cuts.hint("merge"), same, "left").drop("__id", "__key")

    def run(batches):
        for piece in pieces(batches, text_column):
            texts = piece.column(text_column).fill_null("").cast(pa.binary()).to_pylist()
            found = [cut(t, c) for t, c in zip(texts, piece.column("__cuts").to_pylist())]
            n, gone, kept = zip(*found)
            new = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in rest), *new], names=[*rest, *names])

    out = T.StructType([documents.schema[c] for c in rest])
    for name, kind in zip(names, ("long", "long", "string")):
        out = out.add(name, kind)
    return rows.mapInArrow(run, out)
