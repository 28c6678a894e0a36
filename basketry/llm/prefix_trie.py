"""The prefix trie of conversations, as balanced parentheses per shard.

A conversation is its path: one digest per turn. Equal paths are counted first, so copies weigh one row. The distinct
paths are dealt into ranges; in a range, sorted, they list the nodes of its part of the trie in preorder, which is
written as balanced parentheses: where a parenthesis closes gives the size of its subtree, the rank of pairs its leaves,
and running sums in preorder its members and savings.

Only nodes on the first and the last path of a range, its spine, can lie in other ranges too. A range hands on what
hangs off its spines, and the spines of all ranges, two paths each, merge by the same construction. What hangs off a
spine node learns the name of its parent from the merged spines.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import partitions, record_batch, rows_of, stored
from basketry.llm.parens import Parens

DIGEST = 16
#: Bytes of ids that are joined before they are handed on.
CHUNK_BYTES = 1 << 20
NONE = np.iinfo(np.int64).max
SPINES = ("first", "last")


def _digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, DIGEST)


def rebuilt(conversations: DataFrame, family: int = 5, spread: int = 9) -> DataFrame:
    """``conv_id``, ``path`` (a digest per turn) and ``sizes`` (bytes of each text) of the rebuilt conversations.

    Conversation c begins with the first h turns of conversation c - c % ``family``, h = crc32(c) % ``spread``, and goes
    on with its own turns after its first h.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("digest"),
            F.octet_length(text).cast("long").alias("size")).alias("turn"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = stored(own.select("conv_id", F.col("turns.digest").alias("own"), F.col("turns.size").alias("own_sizes")), "conversations")
    heads = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, spread - 1).alias("head"), F.slice("own_sizes", 1, spread - 1).alias("head_sizes"))
    h = F.col("h")
    parts = own.withColumns({
        "base": F.col("conv_id") - F.col("conv_id") % family,
        "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")})
    parts = parts.join(heads, "base", "left")

    def joined(head: str, rest: str) -> Column:
        begin = F.coalesce(F.slice(F.col(head), F.lit(1), h), F.slice(F.col(rest), 1, 0))
        return F.concat(begin, F.slice(F.col(rest), h + 1, F.greatest(F.size(rest), F.lit(0))))

    return parts.select("conv_id", joined("head", "own").alias("path"), joined("head_sizes", "own_sizes").alias("sizes"))


def end_digests(ends: DataFrame) -> DataFrame:
    """``key`` and ``sha``: the SHA-256 of the decimal ids of each key (key, conv_id), rising, joined by commas.

    Ids are sorted in ranges that may cut a key apart, joined to pieces of text there, and the pieces of a key hashed in
    their order; so a key that has very many ids is read as a stream of pieces.
    """
    n = partitions(ends.sparkSession)

    def pieces(batches):
        key, ids, first, size = None, [], 0, 0

        def made():
            return record_batch({"key": pa.array([key], pa.binary()), "first": pa.array([first]), "piece": pa.array([",".join(ids)])})

        for batch in batches:
            for k, number in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (k != key or size >= CHUNK_BYTES):
                    yield made()
                    ids, size = [], 0
                if not ids:
                    key, first = k, number
                ids.append(str(number))
                size += len(ids[-1]) + 1
        if ids:
            yield made()

    def hashes(batches):
        key, state, done = None, None, []
        for row in rows_of(batches):
            if state is None or row["key"] != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = row["key"], hashlib.sha256()
            else:
                state.update(b",")
            state.update(row["piece"].encode())
            if len(done) >= 10_000:
                yield pairs(done)
                done = []
        if state is not None:
            yield pairs([*done, (key, state.hexdigest())])

    def pairs(done):
        keys, values = zip(*done)
        return record_batch({"key": pa.array(keys, pa.binary()), "sha": pa.array(values)})

    sorted_ids = ends.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = sorted_ids.mapInArrow(pieces, "key binary, first long, piece string")
    return joined.repartition(n, "key").sortWithinPartitions("key", "first").mapInArrow(hashes, "key binary, sha string")


class Trie:
    """The trie of sorted paths, nodes in preorder; node 0 is the root.

    ``digests`` holds the paths end to end, ``lengths`` how long they are. ``path_nodes`` gives the nodes of the first or
    last path from the root on.
    """

    def __init__(self, digests: np.ndarray, lengths: np.ndarray) -> None:
        starts = np.cumsum(lengths) - lengths
        path = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(digests)) - starts[path]
        above = np.maximum(path - 1, 0)
        comparable = (path > 0) & (place < lengths[above])
        same = np.zeros(len(digests), bool)
        at = np.flatnonzero(comparable)
        same[at] = (digests[at] == digests[starts[above[at]] + place[at]]).all(axis=1)
        # How far a path goes along with the one before: up to its first turn that differs.
        shared = lengths.copy()
        np.minimum.at(shared, path[~same], place[~same])
        shared[0] = 0
        fresh = place >= shared[path]
        self.elements = np.flatnonzero(fresh)  # where the turn of each node but the root stands
        self.depth = np.concatenate([[0], place[fresh] + 1])
        new = lengths - shared
        self.ends = np.zeros(len(lengths), np.int64)  # the node where each path ends
        self.parent = np.full(len(self.depth), -1, np.int64)
        stack, count = [0], 1
        first = []
        for k, (common, more) in enumerate(zip(shared.tolist(), new.tolist())):
            del stack[common + 1:]
            if more:
                first.append((count, stack[-1]))
                stack.extend(range(count, count + more))
                count += more
            self.ends[k] = stack[-1]
            if not k:
                self.first_path = list(stack)
        self.last_path = stack
        self.parent[1:] = np.arange(len(self.depth) - 1)
        if first:
            begins, parents = np.array(first, np.int64).T
            self.parent[begins] = parents
        closes = np.concatenate([[0], lengths[:-1] - shared[1:]])
        runs = np.column_stack([closes, new]).ravel()
        bits = np.repeat(np.tile([False, True], len(lengths)), runs)
        self.tree = Parens(np.concatenate([[True], bits, np.zeros(int(lengths[-1]) + 1, bool)]))
        self.sizes = self.tree.sizes()

    def below(self, values: np.ndarray) -> np.ndarray:
        """The sum of ``values`` over the subtree of each node."""
        sums = np.concatenate([[0], np.cumsum(values)])
        at = np.arange(len(values))
        return sums[at + self.sizes] - sums[at]

    def least(self, values: np.ndarray) -> np.ndarray:
        """The minimum of ``values`` over the subtree of each node, from the deepest up."""
        out = values.copy()
        order = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        for nodes in np.split(order, cuts):
            if self.depth[nodes[0]]:
                np.minimum.at(out, self.parent[nodes], out[nodes])
        return out

    def children(self) -> np.ndarray:
        return np.bincount(self.parent[1:], minlength=len(self.depth))


def _numbers(paths: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All digests end to end, a row each, and the length of each path."""
    lengths = np.array([len(p) for p in paths], np.int64)
    return np.frombuffer(b"".join(d for p in paths for d in p), np.uint64).reshape(-1, DIGEST // 8), lengths


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_COUNTS = ("convs", "children", "leaves", "saved", "least")
_SPINE = "path array<binary>, sizes array<long>, " + ", ".join(f"{c} array<long>" for c in _COUNTS) + ", shas array<string>"
_SHARD = f"{_NODE}, shard int, spine string, {_SPINE}"
_NAMES = [x.split()[0] for x in _NODE.split(", ")]


def _shard(batches, empty_sha: str):
    """The nodes of one range of paths (path, sizes, n, least, sha), finished but for the parents on a spine, whose
    depth stands in ``parent_conv_id``, and one or two spines."""
    from pyspark import TaskContext

    columns = [[], [], [], [], []]
    for batch in batches:
        for held, name in zip(columns, ("path", "sizes", "n", "least", "sha")):
            held.extend(batch.column(name).to_pylist())
    paths, sizes, n, least, shas = columns
    if not paths:
        return
    shard = TaskContext.get().partitionId()
    trie = Trie(*_numbers(paths))
    count = len(trie.depth)
    size = np.zeros(count, np.int64)
    size[1:] = np.fromiter((x for s in sizes for x in s), np.int64)[trie.elements]
    here, low, sha = np.zeros(count, np.int64), np.full(count, NONE, np.int64), np.full(count, None, object)
    here[trie.ends], low[trie.ends], sha[trie.ends] = n, least, shas
    convs, leaves, children = trie.below(here), trie.tree.leaves(trie.sizes), trie.children()
    own = (convs - 1) * size
    saved, low = trie.below(own), trie.least(low)
    which = np.full(count, -1, np.int8)
    which[trie.last_path] = 1
    which[trie.first_path] = 0
    spine = which >= 0
    inner = np.flatnonzero(~spine)
    held = spine[trie.parent[inner]]
    parents = np.where(held, trie.depth[inner] - 1, low[trie.parent[inner]])
    for first in range(0, len(inner), 10_000):
        part, on = inner[first:first + 10_000], held[first:first + 10_000]
        made = {
            "conv_id": low[part], "depth": trie.depth[part], "parent_conv_id": parents[first:first + 10_000],
            "n_convs": convs[part], "n_children": children[part], "n_leaves": leaves[part], "saved_tokens": saved[part],
            "ends_sha256": pa.array([x or empty_sha for x in sha[part]], pa.string()),
            "shard": pa.array([shard] * len(part), pa.int32()),
            "spine": pa.array([SPINES[which[p]] if o else None for p, o in zip(trie.parent[part], on)], pa.string()),
        }
        yield _filled(made, len(part))
    # What hangs off the spines: everything, less what the spine nodes below pass up.
    at = np.flatnonzero(spine)[1:]
    hang = [convs.copy(), children.copy(), leaves - (children == 0), saved - own, low]
    for k, passed in enumerate((convs, np.ones(count, np.int64), leaves, saved)):
        np.subtract.at(hang[k], trie.parent[at], passed[at])
    for kind, nodes in ((0, trie.first_path), (1, trie.last_path)):
        nodes = np.array(nodes)
        if kind and (which[nodes] == 0).all():
            return  # the last path is a part of the first one: there is only one path
        mine = which[nodes] == kind
        arrays = {c: [np.where(mine, h[nodes], NONE if c == "least" else 0).tolist()] for c, h in zip(_COUNTS, hang)}
        path, own_sizes = (paths[0], sizes[0]) if not kind else (paths[-1], sizes[-1])
        yield _filled({
            "shard": pa.array([shard], pa.int32()), "spine": [SPINES[kind]], "path": pa.array([path], pa.list_(pa.binary())),
            "sizes": pa.array([own_sizes], pa.list_(pa.int64())), **{c: pa.array(v, pa.list_(pa.int64())) for c, v in arrays.items()},
            "shas": pa.array([sha[nodes].tolist()], pa.list_(pa.string())),
        }, 1)


def _filled(made: dict, n: int) -> pa.RecordBatch:
    """A batch of ``_SHARD`` rows; columns that are missing are null."""
    kinds = {"path": pa.list_(pa.binary()), "shas": pa.list_(pa.string()), "ends_sha256": pa.string()}
    out = {}
    for column in _SHARD.split(", "):
        name, kind = column.split()
        default = pa.list_(pa.int64()) if kind.startswith("array") else pa.int64()
        out[name] = made[name] if name in made else pa.nulls(n, kinds.get(name, default))
    return record_batch(out)


def _merged(batches, empty_sha: str):
    """The spines of all shards as one trie: every node once, and per spine the names of its nodes."""
    rows = [row for row in rows_of(batches)]
    if not rows:
        return
    trie = Trie(*_numbers([r["path"] for r in rows]))
    count = len(trie.depth)
    size = np.zeros(count, np.int64)
    size[1:] = np.fromiter((x for r in rows for x in r["sizes"]), np.int64)[trie.elements]
    totals = {c: np.zeros(count, np.int64) for c in _COUNTS}
    totals["least"][:] = NONE
    sha, along = np.full(count, None, object), []
    for row, end in zip(rows, trie.ends.tolist()):
        nodes = []
        while end >= 0:
            nodes.append(end)
            end = int(trie.parent[end])
        nodes = np.array(nodes[::-1])
        along.append(nodes)
        for c in _COUNTS[:-1]:
            totals[c][nodes] += np.array(row[c])
        totals["least"][nodes] = np.minimum(totals["least"][nodes], np.array(row["least"]))
        for node, value in zip(nodes.tolist(), row["shas"]):
            sha[node] = sha[node] or value
    convs = trie.below(totals["convs"])
    children = totals["children"] + trie.children()
    leaves = trie.below(totals["leaves"] + (children == 0))
    saved = trie.below(totals["saved"] + (convs - 1) * size)
    names = trie.least(totals["least"])
    parents = pa.array(names[np.maximum(trie.parent, 0)], mask=trie.parent < 0)
    yield _filled({
        "conv_id": names, "depth": trie.depth, "parent_conv_id": parents, "n_convs": convs, "n_children": children,
        "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": pa.array([x or empty_sha for x in sha], pa.string()),
        "shard": pa.nulls(count, pa.int32()), "spine": pa.nulls(count, pa.string()),
    }, count)
    for row, nodes in zip(rows, along):
        yield _filled({
            "shard": pa.array([row["shard"]], pa.int32()), "spine": [row["spine"]],
            "least": pa.array([names[nodes].tolist()], pa.list_(pa.int64())),
        }, 1)


def nodes(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (``rebuilt``), long and named by their smallest member:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` and ``ends_sha256``.

    Turns go by ``turn``, null first, equal ones by a digest of role and text; a null role or text is empty. Rows
    without a conversation id belong to no conversation and are left out; repeated rows are turns of their own; an
    empty table has no nodes, not even a root; other columns are left out. The digests of one conversation are one row.
    """
    spark = conversations.sparkSession
    empty_sha = hashlib.sha256(b"").hexdigest()
    whole = F.array_join(F.transform("path", lambda d: F.hex(d)), "")
    convs = stored(rebuilt(conversations).withColumn("key", _digest(whole)), "rebuilt")
    paths = convs.groupBy("key", "path", "sizes").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    # As many keys as there are different conversations: merged at every size, never broadcast.
    ended = paths.join(end_digests(convs.select("key", "conv_id")).hint("merge"), "key")
    ended = stored(ended.select("path", "sizes", "n", "least", "sha"), "paths")
    ranges = ended.repartitionByRange(partitions(spark), "path").sortWithinPartitions("path")
    shards = stored(ranges.mapInArrow(lambda batches: _shard(batches, empty_sha), _SHARD), "shards")
    inner = shards.where("path IS NULL")
    # Two paths a shard, whatever the number of conversations.
    spines = shards.where("path IS NOT NULL").repartition(1).sortWithinPartitions("path")
    merged = stored(spines.mapInArrow(lambda batches: _merged(batches, empty_sha), _SHARD), "spines")
    known = merged.where("spine IS NOT NULL").select("shard", "spine", F.posexplode("least").alias("place", "name"))
    hanging = inner.where("spine IS NOT NULL").withColumn("place", F.col("parent_conv_id").cast("int")).drop("parent_conv_id")
    hanging = hanging.join(known.withColumnRenamed("name", "parent_conv_id"), ["shard", "spine", "place"])
    out = [F.col(c) for c in _NAMES]
    return (inner.where("spine IS NULL").select(*out).unionByName(hanging.select(*out))
            .unionByName(merged.where("spine IS NULL").select(*out)))
