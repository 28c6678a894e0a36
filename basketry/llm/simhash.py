"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in at most 2r bits have a common variant at most r bits from each. Every distinct
fingerprint therefore emits its whole ball (2,081 variants for r = 2), variants meet in a shuffle, and two fingerprints
that share one are linked, as the triangle inequality shows; the distance is verified all the same.

The balls are far larger than the text they come from, so they do not travel as rows. Blocks of fingerprints send the
places of their variants on a line of 2**bits slots, sorted, as two-byte gaps. The reducer answers which places are
taken twice; only those few variants then travel in full, with their fingerprint. Nothing is dropped: a place that only
happens to be shared costs one needless row.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import blobs
from basketry.llm.common import by_key, each_piece, groups_of, partitions, record_batch, stored, texts_of
from basketry.llm.components import components
from basketry.llm.words import mixed

SEED = 42
#: Distinct fingerprints whose balls a task holds at a time.
BLOCK = 2048
#: Entries of the line that a reducer holds at a time.
BUCKET = 4_000_000
#: Slots of the line per variant: one variant in so many meets another by chance.
ROOM = 64


def fingerprint(text: bytes, width: int) -> int:
    """A bit is set if more than half of the shingles' hashes have it; repeats count."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    k = min(width, len(words))
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[k - 1:])])
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):  # a bit takes a byte here: never all of a long text at once
        counts += np.unpackbits(hashes[first:first + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(documents: DataFrame, width: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a long)."""

    def make(piece):
        texts = piece.column("text").cast(pa.binary()).to_pylist()
        fps = np.array([fingerprint(t, width) for t in texts], np.uint64)
        return {"doc_id": piece.column("doc_id"), "fp": fps.view(np.int64)}

    return each_piece(texts_of(documents, id_column, text_column), make, "doc_id long, fp long")


def ball(radius: int) -> np.ndarray:
    """All masks of at most ``radius`` set bits."""
    return np.array(
        [sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(64), r)],
        np.uint64,
    )


def links(nodes: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints (column ``fp``) that connect all within ``distance`` bits.

    Each shared variant links its fingerprints to one hub, the smallest of them. With an odd distance only a fingerprint
    that is one bit nearer to the variant than the radius can be the hub: it is within ``distance`` of all others that
    have the variant, and of two fingerprints within an odd distance one is that near to some common variant.
    """
    count = nodes.count()
    radius = (distance + 1) // 2
    masks = ball(radius)
    entries = max(1, count * len(masks))
    bits = min(62, (ROOM * entries - 1).bit_length())
    shift = np.uint64(64 - bits)
    n_buckets = max(partitions(nodes.sparkSession), -(-entries // BUCKET))
    n_blocks = -(-count // BLOCK) or 1
    edges = [((k << bits) // n_buckets) for k in range(n_buckets + 1)]
    kind = "<u2" if (1 << bits) // (BLOCK * len(masks)) < 1 << 14 else "<u4"
    blocked = nodes.select(F.pmod(F.xxhash64("fp"), F.lit(n_blocks)).cast("int").alias("block"), "fp")

    def places(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        variants = (fps[:, None] ^ masks).ravel()
        return variants, (mixed(variants) >> shift).astype(np.int64)

    def send(batches):
        for block, rows in groups_of(batches, "block"):
            _, at = places(np.array([r["fp"] for r in rows], np.int64).view(np.uint64))
            at.sort()
            cuts = np.searchsorted(at, edges)
            for k in range(n_buckets):
                if cuts[k] < cuts[k + 1]:
                    packed = blobs.pack(at[cuts[k]:cuts[k + 1]] - edges[k], kind)
                    yield record_batch({
                        "bucket": pa.array([k], pa.int32()), "block": pa.array([block], pa.int32()),
                        "at": pa.array([packed], pa.binary()),
                    })

    def answer(batches):
        for bucket, rows in groups_of(batches, "bucket"):
            parts = [blobs.unpack(r["at"], kind) for r in rows]
            line = np.concatenate(parts)
            line.sort()
            twice = np.unique(line[1:][line[1:] == line[:-1]])
            del line
            if not len(twice):
                continue
            for row, part in zip(rows, parts):
                slot = np.minimum(np.searchsorted(twice, part), len(twice) - 1)
                hit = np.unique(part[twice[slot] == part])
                if len(hit):
                    yield record_batch({
                        "block": pa.array([row["block"]], pa.int32()), "fp": pa.array([None], pa.int64()),
                        "bucket": pa.array([bucket], pa.int32()),
                        "at": pa.array([blobs.pack(hit, "<u4")], pa.binary()),
                    })

    def resend(batches):
        for _, rows in groups_of(batches, "block"):
            fps = np.array([r["fp"] for r in rows if r["at"] is None], np.int64).view(np.uint64)
            hits = [blobs.unpack(r["at"], "<u4") + edges[r["bucket"]] for r in rows if r["at"] is not None]
            if not hits:
                continue
            wanted = np.concatenate(hits)
            wanted.sort()
            variants, at = places(fps)
            slot = np.minimum(np.searchsorted(wanted, at), len(wanted) - 1)
            chosen = np.flatnonzero(wanted[slot] == at)
            bucket = (at[chosen].astype(object) * n_buckets >> bits).astype(np.int64) if bits > 40 else (
                at[chosen] * n_buckets >> bits)
            order = np.argsort(bucket, kind="stable")
            chosen, bucket = chosen[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(n_buckets + 1))
            owner = fps[chosen // len(masks)]
            for k in np.flatnonzero(cuts[1:] > cuts[:-1]):
                part = slice(cuts[k], cuts[k + 1])
                yield record_batch({
                    "bucket": pa.array([k], pa.int32()),
                    "variants": pa.array([variants[chosen[part]].tobytes()], pa.binary()),
                    "fps": pa.array([owner[part].tobytes()], pa.binary()),
                })

    def meet(batches):
        for _, rows in groups_of(batches, "bucket"):
            variants = np.concatenate([np.frombuffer(r["variants"], np.uint64) for r in rows])
            fps = np.concatenate([np.frombuffer(r["fps"], np.int64) for r in rows])
            far = np.bitwise_count(variants ^ fps.view(np.uint64)) > distance - radius
            order = np.lexsort((fps, far, variants))
            variants, fps, far = variants[order], fps[order], far[order]
            first = np.concatenate([[True], variants[1:] != variants[:-1]])
            hub = np.flatnonzero(first)[np.cumsum(first) - 1]
            fps, least = fps[~far[hub]], fps[hub][~far[hub]]
            pairs = np.unique(np.column_stack([fps, least])[fps != least], axis=0)
            near = np.bitwise_count((pairs[:, 0] ^ pairs[:, 1]).view(np.uint64)) <= distance
            if near.any():
                yield record_batch({"a": pairs[near, 0], "b": pairs[near, 1]})

    sent = by_key(blocked, "block").mapInArrow(send, "bucket int, block int, at binary")
    answers = by_key(sent, "bucket", "block").mapInArrow(answer, "block int, fp long, bucket int, at binary")
    asked = blocked.select("block", "fp", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("at"))
    full = by_key(asked.unionByName(answers), "block").mapInArrow(resend, "bucket int, variants binary, fps binary")
    return by_key(full, "bucket").mapInArrow(meet, "a long, b long").distinct()


def near_duplicates(
    documents: DataFrame, width: int = 4, distance: int = 4, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``, one row per document.

    Documents are linked if their fingerprints differ in at most ``distance`` bits; ``component_id`` is the smallest
    ``doc_id`` that links lead to. A null text is empty; texts without a word have fingerprint zero and are linked like
    any other; a null id takes part but names no group (null only if the whole group has none); repeated rows come
    out once each; an empty table gives an empty result; further columns are left out.
    """
    prints = stored(fingerprints(documents, width, id_column, text_column), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    groups = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    placed = groups.join(nodes, "fp")
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = placed.join(named, "root").select("fp", "component_id", F.lit(True).alias("linked"))
    every = nodes.join(linked, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"))
    # Written, so that the next join deals out both sides itself and can split a fingerprint that many documents have.
    every = stored(every, "fingerprint-groups")
    return prints.join(every, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
