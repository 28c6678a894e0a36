"""Threshold-scaled sketches: every shingle hash below a fixed fraction of the hash range is kept.

The size of a sketch follows the size of its text, so the share of a short text inside a much longer one can be
estimated, and the sketch of a union is the union of the sketches. Half of the range is kept, so that few texts keep
nothing: one in 2**k of those with k shingles. Such a text keeps its smallest hash as a mark of its own, which tells it
from other short texts but is never found in a longer one; only a text without words has an empty sketch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import words as w
from basketry.llm.common import each_piece, partitions, pieces, record_batch, text_bytes, texts_of

#: One hash in so many is kept, by its upper 32 bits (two of 10,000 hashes in common by chance: 0.01 expected).
SCALE = 2
#: Words per shingle.
WIDTH = 5
#: Stands for a null id in the order of documents: smaller than any other.
NO_ID = np.iinfo(np.int64).min


def sketches(texts: pa.Array, scale: int = SCALE, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted kept hashes of each text; a text of fewer words has one shingle, its whole sequence of words."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    starts, ends, doc = w.spans(data, offsets)
    word_hash = w.hashes(data, starts, ends)
    at, hashes = w.window_hashes(word_hash, doc, width)
    sizes = np.bincount(doc, minlength=n)
    few = np.flatnonzero((sizes > 0) & (sizes < width))
    first = (np.cumsum(sizes) - sizes)[few]
    whole = w.chained(word_hash, first, sizes[few])
    owner, hashes = np.concatenate([doc[at], few]), (np.concatenate([hashes, whole]) >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new_text = np.diff(owner, prepend=-1) > 0
    new = new_text | (np.diff(hashes, prepend=np.uint32(0)) != 0)
    kept = new & ((hashes < (1 << 32) // scale) | new_text)
    owner, hashes = owner[kept], hashes[kept]
    return np.split(hashes, np.searchsorted(owner, np.arange(1, n)))


def to_text(sketch: np.ndarray) -> str:
    """Eight hex digits per hash, rising."""
    return sketch.astype(">u4").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    both = np.union1d(a, b)
    below = both[both < (1 << 32) // scale]
    return below if len(below) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the smaller text's shingles that the other has too (two empty sketches: 1, one: 0)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / min(len(a), len(b))


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document (null text: empty)."""
    def make(piece):
        return {"doc_id": piece.column("doc_id"), "fingerprint": [to_text(s) for s in sketches(piece.column("text"))]}

    return each_piece(texts_of(documents, id_column, text_column), make, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following`` as there is."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


class Ranges:
    """Ranges of the order by falling key, then falling turn; a key with several of the limits falls into as many ranges
    of its turn, so that no key is too large for a range."""

    def __init__(self, limits: list[float]) -> None:
        self.keys, shares = np.unique(np.array(limits, np.float64).astype(np.int64), return_counts=True)
        self.shares = shares[::-1]
        self.firsts = 1 + np.cumsum(self.shares) - self.shares

    def of(self, key: np.ndarray, turn: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(key), np.int64)
        after = len(self.keys) - np.searchsorted(self.keys, key, "left") - 1  # the lowest limit at or above the key
        at = np.maximum(after, 0)
        fallen = (np.uint64((1 << 63) - 1) - turn.astype(np.int64).view(np.uint64)) >> np.uint64(32)
        inside = (fallen * self.shares[at].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        inside = np.where(self.keys[::-1][at] == key, inside, self.shares[at] - 1)
        return np.where(after < 0, 0, self.firsts[at] + inside)


def _with_neighbours(rows: DataFrame) -> DataFrame:
    """``rows`` (key, turn, text, no_id) dealt into ranges of their order, each followed by the first row of the next.

    Ranges come from quantiles of the key alone; only their limits and first keys reach the driver, a few numbers per
    partition. The text is shuffled once.
    """
    spark = rows.sparkSession
    wanted = 2 * partitions(spark)
    limits = rows.approxQuantile("key", [k / wanted for k in range(1, wanted)], 0.25 / wanted)
    ranges = Ranges(limits)

    @F.pandas_udf("int")
    def range_of(key: pd.Series, turn: pd.Series) -> pd.Series:
        return pd.Series(ranges.of(key.to_numpy(), turn.to_numpy()))

    dealt = rows.withColumns({"part": range_of("key", "turn"), "ghost": F.lit(0)})
    heads = dealt.groupBy("part").agg(F.max(F.struct("key", "turn")).alias("head")).orderBy("part").collect()
    if not heads:
        return dealt
    follows = [(*row["head"], heads[k - 1]["part"]) for k, row in enumerate(heads)]
    first = F.broadcast(spark.createDataFrame(follows, "key long, turn long, part int"))  # one row per range
    ghosts = rows.join(first, ["key", "turn"]).groupBy("key", "turn", "part").agg(
        F.min("text").alias("text"), F.first("no_id").alias("no_id")).withColumn("ghost", F.lit(1))
    return dealt.unionByName(ghosts).repartition(partitions(spark), "part").sortWithinPartitions(
        "part", "ghost", F.col("key").desc(), F.col("turn").desc(), "text")


def compare_edits(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's sketch, its edited text's, and how alike they are, and it and the next document are.

    The next document is the one with the next smaller id, after the last the first (a single document follows
    itself); rows of one id follow each other by falling checksum of the text, then by text, null ids come last. A null
    text is empty. Repeated rows come out once each; an empty table gives an empty result; further columns are left out.
    Likeness is the containment of the smaller sketch in the other, 0 to 1.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = documents.select(
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64(text).alias("turn"), text.alias("text"),
        F.col(f"`{id_column}`").isNull().alias("no_id"))

    def run(batches):
        held = []
        for piece in pieces(batches):
            columns = [piece.column(c) for c in ("key", "no_id", "part", "ghost", "text")]
            lined = held + list(zip(*(c.to_pylist() for c in columns), sketches(columns[-1])))
            pairs = [(a, b) for a, b in zip(lined, lined[1:]) if not a[3] and a[2] == b[2]]
            held = lined[-1:]
            if not pairs:
                continue
            texts = [edited(a[4], b[4]) for a, b in pairs]
            marks = sketches(pa.array(texts, pa.large_string()))
            yield record_batch({
                "doc_id": pa.array([None if a[1] else a[0] for a, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(a[4]) for a, _ in pairs], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in texts],
                "fingerprint": [to_text(a[5]) for a, _ in pairs],
                "edited_fingerprint": [to_text(m) for m in marks],
                "near_edited": [containment(a[5], m) for (a, _), m in zip(pairs, marks)],
                "near_next": [containment(a[5], b[5]) for a, b in pairs],
            })

    return _with_neighbours(rows).select("key", "no_id", "part", "ghost", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
