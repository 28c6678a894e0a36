"""Boosted trees of all folds of a large table, grown side by side.

The trees are those of Spark ML's ``GBTClassifier``: the same borders of the bins, the same rows and features drawn for
the same seed, the same logistic loss and the same gain. What differs is how they grow. Spark ML grows one model at a time,
each level of each tree a job of its own with an object per row. Here one job serves a level of every fold; rows are
blocks of bins in columns, which numpy adds up, two features at a time, and of two siblings only the smaller is added up.
So sums differ in their last digits, as Spark ML's own do from run to run over several tasks, and splits of the same
gain may be chosen otherwise.

No rows but those that borders are taken from (some 10,000 a fold, as in Spark ML) reach the driver, and of every level the
sums per node, feature and bin.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import shared_folder

#: Bins of a feature; as in Spark ML a few more where the rows drawn for the borders are more than expected.
BINS = 32
#: Rows that the borders of the bins are taken from.
BORDER_ROWS = 10_000
#: Up to this share ``RDD.sample`` draws the gaps between rows.
FEW = 0.4
#: Rows of one block, which is what a task holds in memory at a time, and draws of one lane.
BLOCK_ROWS, LANE = 1 << 15, 128
#: Trees after which the lineage of the scores is cut, and parts whose sums the driver adds up itself.
CUT_EVERY, PARTS = 25, 32
#: Rounding: of a whole table's weight, and of a parent's squared targets.
EPSILON, PURE = 2.0 ** -52, 1e-12


@dataclass(frozen=True)
class Boosting:
    trees: int
    depth: int
    rate: float
    row_sample: float
    column_sample: float
    min_child: int
    positive_weight: float
    seed: int


# --- random numbers of Spark and of Java ------------------------------------------------------------------------

MASK = (1 << 64) - 1


def _murmur(data: bytes, seed: int) -> int:
    """MurmurHash3 (32 bits) of whole words."""
    h, low = seed, 0xFFFFFFFF
    for at in range(0, len(data), 4):
        k = int.from_bytes(data[at : at + 4], "little") * 0xCC9E2D51 & low
        k = (k << 15 | k >> 17) & low
        h ^= k * 0x1B873593 & low
        h = ((h << 13 | h >> 19) & low) * 5 + 0xE6546B64 & low
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & low
    return h ^ h >> 16


def xorshift_state(seed: int) -> int:
    """The state that Spark's ``XORShiftRandom`` begins with."""
    data = (seed & MASK).to_bytes(8, "big")
    low = _murmur(data, 0x3C074A61)
    return _murmur(data, low) << 32 | low


def _step(state):
    """One step of the generator, of a number or of an array."""
    if isinstance(state, int):
        state ^= state << 21 & MASK
        state ^= state >> 35
        return state ^ (state << 4 & MASK)
    state = state ^ (state << np.uint64(21))
    state ^= state >> np.uint64(35)
    return state ^ (state << np.uint64(4))


def _applied(columns: np.ndarray, states: np.ndarray) -> np.ndarray:
    """A linear map over bits, given by the images of the 64 bits, of every state."""
    found = np.zeros_like(states)
    for bit in range(64):
        found ^= (-(states >> np.uint64(bit) & np.uint64(1)).astype(np.int64)).view(np.uint64) & columns[bit]
    return found


@cache
def _leaps() -> list[np.ndarray]:
    """The maps of 1, 2, 4 ... steps."""
    found = [_step(np.uint64(1) << np.arange(64, dtype=np.uint64))]
    for _ in range(44):
        found.append(_applied(found[-1], found[-1]))
    return found


def _leapt(states: np.ndarray, steps: int) -> np.ndarray:
    for bit, columns in enumerate(_leaps()):
        if steps >> bit & 1:
            states = _applied(columns, states)
    return states


def uniforms(seed: int, first: int, n: int) -> np.ndarray:
    """Numbers ``first`` to ``first + n - 1`` that ``XORShiftRandom(seed).nextDouble()`` gives, in lanes that step together."""
    states = _leapt(np.array([xorshift_state(seed)], np.uint64), 2 * first)
    while len(states) * LANE < n:
        states = np.concatenate([states, _leapt(states, 2 * LANE * len(states))])
    found = np.empty((len(states), LANE))
    for k in range(min(LANE, n)):
        states = _step(states)
        high = states & np.uint64((1 << 26) - 1)
        states = _step(states)
        found[:, k] = ((high << np.uint64(27)) + (states & np.uint64((1 << 27) - 1))) * 2.0 ** -53
    return found.ravel()[:n]


class JavaRandom:
    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & (1 << 48) - 1

    def _next(self) -> int:
        self.state = self.state * 0x5DEECE66D + 0xB & (1 << 48) - 1
        found = self.state >> 16
        return found - (1 << 32) if found >> 31 else found

    def next_long(self) -> int:
        found = (self._next() << 32) + self._next() & MASK
        return found - (1 << 64) if found >> 63 else found


def reservoir(n: int, k: int, seed: int) -> list[int]:
    """``k`` of the numbers below ``n``, as ``SamplingUtils.reservoirSampleAndCount`` draws them."""
    found = list(range(k))
    for item, u in enumerate(uniforms(seed, 0, n - k).tolist(), k):
        place = int(u * (item + 1))
        if place < k:
            found[place] = item
    return found


# --- borders of the bins --------------------------------------------------------------------------------------


def borders(values: np.ndarray, weights: np.ndarray, total: float, splits: int) -> np.ndarray:
    """Thresholds of one feature from sampled values, ``total`` their expected weight."""
    there = values != 0
    different, place = np.unique(values[there], return_inverse=True)
    counts = np.bincount(place, weights=weights[there], minlength=len(different))
    if not len(different):
        return np.empty(0)
    if total - counts.sum() > EPSILON * there.sum() * 100:
        at = np.searchsorted(different, 0.0)
        different, counts = np.insert(different, at, 0.0), np.insert(counts, at, total - counts.sum())
    middles = (different[:-1] + different[1:]) / 2.0
    if len(middles) <= splits:
        return middles
    stride = total / (splits + 1)
    found, seen, target = [], counts[0], stride
    for k in range(1, len(different)):
        before, seen = seen, seen + counts[k]
        if abs(before - target) < abs(seen - target):
            found.append(middles[k - 1])
            target += stride
    return np.array(found)


def _drawn(batches, fractions: list[float], seed: int) -> Iterator:
    """The rows that ``RDD.sample`` draws from the rows that every fold learns from, with the fold as ``asked``."""
    import pyarrow as pa

    random = JavaRandom(seed)
    for _ in range(TaskContext.get().partitionId() + 1):
        own = random.next_long()
    folds = range(len(fractions))
    done, used, places = [0 for _ in folds], [0 for _ in folds], [np.full(1, -1) for _ in folds]
    for batch in batches:
        of_row = batch.column(batch.num_columns - 1).to_numpy()
        for fold, fraction in enumerate(fractions):
            learned = np.flatnonzero(of_row != fold)
            first, end = done[fold], done[fold] + len(learned)
            done[fold] = end
            if fraction >= 1:
                chosen = learned
            elif fraction > FEW:
                chosen = learned[uniforms(own, first, len(learned)) <= fraction]
            else:
                while places[fold][-1] < end:
                    u = np.maximum(uniforms(own, used[fold], 4096), 5e-11)
                    gaps = (np.log(u) / np.log1p(-fraction)).astype(np.int64) + 1
                    places[fold] = np.concatenate([places[fold], places[fold][-1] + gaps.cumsum()])
                    used[fold] += 4096
                at = places[fold]
                chosen = learned[at[(at >= first) & (at < end)] - first]
                places[fold] = at[at >= end]
            some = batch.take(pa.array(chosen))
            yield pa.RecordBatch.from_arrays([*some.columns[:-1], pa.array(np.full(len(chosen), fold, np.int32))],
                                             names=[*batch.schema.names[:-1], "asked"])


def _all_borders(rows: DataFrame, sizes: list[tuple[int, int]], how: Boosting) -> list[list[np.ndarray]]:
    """Per fold the borders of every feature; ``sizes`` are its negative and positive rows to learn from."""
    fractions = [min(1.0, max(BINS * BINS, BORDER_ROWS) / sum(n)) for n in sizes]
    seed = _step(xorshift_state(how.seed)) & 0xFFFFFFFF
    names = rows.columns[:-1]
    kinds = ", ".join(f"`{c}` double" for c in names) + ", asked int"
    drawn = rows.mapInArrow(lambda batches: _drawn(batches, fractions, seed - (1 << 32) if seed >> 31 else seed), kinds).toArrow()
    columns, asked, found = [c.to_numpy() for c in drawn.columns[:-1]], drawn.column("asked").to_numpy(), []
    for fold, (negative, positive) in enumerate(sizes):
        *values, label = [c[asked == fold] for c in columns]
        weights = np.where(label == 1, how.positive_weight, 1.0)
        total = fractions[fold] * (negative + positive * how.positive_weight)
        found.append([borders(v, weights, total, min(BINS, negative + positive) - 1) for v in values])
    return found


# --- blocks of rows -------------------------------------------------------------------------------------------


def _blocks(batches, thresholds: list[list[np.ndarray]], width: int) -> Iterator:
    """Rows (features, label, fold) as a block of bins for every fold, with the place of its first row to learn from."""
    import pyarrow as pa

    part, firsts, held_back = TaskContext.get().partitionId(), [0] * len(thresholds), []

    def made() -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held_back)]
        held_back.clear()
        positive, place, rows = (columns[-2] == 1).astype(np.uint8), columns[-1], []
        for fold, cuts in enumerate(thresholds):
            bins = [np.searchsorted(t, c).astype(np.uint16) for t, c in zip(cuts, columns)]
            bins = np.stack([a * width + b for a, b in zip(bins[::2], [*bins[1::2], np.uint16(0)])])
            held = (place == fold).astype(np.uint8)
            rows.append((fold, part, firsts[fold], bins.tobytes(), positive.tobytes(), held.tobytes()))
            firsts[fold] += len(held) - int(held.sum())
        return pa.RecordBatch.from_arrays([
            pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3))
        ], names=["fold", "part", "first", "bins", "positive", "held"])

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            held_back.append([c.to_numpy(zero_copy_only=False) for c in batch.slice(at, BLOCK_ROWS).columns])
            if 2 * sum(len(c[-1]) for c in held_back) > BLOCK_ROWS:
                yield made()
    if held_back:
        yield made()


def _unpacked(row) -> tuple:
    """fold, part, first, bins of two features, positive, held, scores so far, rows drawn for the tree that grows."""
    positive = np.frombuffer(row["positive"], np.uint8)
    bins = np.frombuffer(row["bins"], np.uint16).reshape(-1, len(positive))
    held = np.frombuffer(row["held"], np.uint8)
    return row["fold"], row["part"], row["first"], bins, positive, held, np.zeros(len(held)), np.empty(0, np.uint8)


@dataclass
class Tree:
    """Nodes by number, the children of n being 2n and 2n + 1; a feature below 0 marks a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    width: int

    @staticmethod
    def of(depth: int, width: int) -> Tree:
        n = 2 << depth
        return Tree(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n), width)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The last node that every row (column of ``bins``) reaches."""
        n, flat = bins.shape[1], bins.ravel()
        at, rows = np.ones(n, np.int64), np.arange(n)
        for _ in range(len(self.feature).bit_length() - 2):
            feature = self.feature[at]
            if (feature < 0).all():
                break
            both = flat[(np.maximum(feature, 0) >> 1) * n + rows]
            first = both // np.uint16(self.width)
            own = np.where(feature & 1, both - first * np.uint16(self.width), first)
            at = np.where(feature < 0, at, 2 * at + (own > self.cut[at]))
        return at


class _Draws:
    """Numbers of one seed for neighbouring blocks, drawn once for all folds."""

    SIZE = 1 << 14

    def __init__(self):
        self.windows: dict[tuple[int, int], np.ndarray] = {}

    def of(self, seed: int, first: int, n: int) -> np.ndarray:
        found, places = [], range(first // self.SIZE, (first + n + self.SIZE - 1) // self.SIZE)
        for place in places:
            if (seed, place) not in self.windows:
                if len(self.windows) > 8:
                    del self.windows[next(iter(self.windows))]
                self.windows[seed, place] = uniforms(seed, place * self.SIZE, self.SIZE)
            found.append(self.windows[seed, place])
        start = first - places.start * self.SIZE
        return np.concatenate(found)[start : start + n] if found else np.empty(0)


def _grown(blocks: Iterator[tuple], trees: dict[int, Tree] | None, number: int, how: Boosting) -> Iterator[tuple]:
    """Scores with the last tree added, and the rows drawn for tree ``number``."""
    draws = _Draws()
    for fold, part, first, bins, positive, held, scores, _drawn in blocks:
        if trees is not None:
            tree = trees[fold]
            scores = scores + tree.value[tree.nodes(bins)] * (how.rate if number > 1 else 1.0)
        drawn = 1 - held
        if how.row_sample < 1 and number < how.trees:
            learned = np.flatnonzero(drawn)
            drawn[learned] = draws.of(how.seed + number + part + 1, first, len(learned)) < how.row_sample
        yield fold, part, first, bins, positive, held, scores, drawn


def _sums(blocks: Iterator[tuple], trees: dict[int, Tree], wanted: dict[int, list[int]], number: int, how: Boosting):
    """Per fold: negative and positive rows and weighted targets per wanted node, feature and bin, and per wanted node the
    squares of the targets."""
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for fold, _part, _first, bins, positive, _held, scores, drawn in blocks:
        nodes, tree = wanted.get(fold), trees[fold]
        if not nodes:
            continue
        rows = np.flatnonzero(drawn)
        bins = bins[:, rows]
        slots = np.full(len(tree.feature), -1, np.int64)
        slots[nodes] = np.arange(len(nodes))
        slot = slots[tree.nodes(bins)]
        going = np.flatnonzero(slot >= 0)
        if len(going) < len(slot):
            rows, bins, slot = rows[going], bins[:, going], slot[going]
        one = positive[rows]
        target = 2.0 * one - 1.0
        if number:
            target = 4.0 * target / (1.0 + np.exp(2.0 * target * scores[rows]))
        weighted = np.where(one == 1, how.positive_weight, 1.0) * target
        squares = np.bincount(slot, weights=weighted * target, minlength=len(nodes))
        width, cells = tree.width, tree.width ** 2
        size = len(nodes) * cells
        at, signed = slot * cells, (slot + one.astype(np.int64) * len(nodes)) * cells
        sums = np.empty((3, 2 * len(bins), len(nodes), width))
        for k, column in enumerate(bins):
            counted = np.bincount(signed + column, minlength=2 * size).reshape(2, len(nodes), width, width)
            added = np.bincount(at + column, weights=weighted, minlength=size).reshape(len(nodes), width, width)
            for axis in (0, 1):  # the first feature of the two is the slower one
                sums[:2, 2 * k + axis] = counted.sum(axis=3 - axis)
                sums[2, 2 * k + axis] = added.sum(axis=2 - axis)
        before = found.get(fold)
        found[fold] = (sums, squares) if before is None else (before[0] + sums, before[1] + squares)
    yield from found.items()


def _both(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1]


# --- splits ---------------------------------------------------------------------------------------------------


class _Growing:
    """One fold's tree while it grows, level by level, with the nodes in the order that Spark ML takes them."""

    def __init__(self, how: Boosting, splits: list[int], width: int, seed: int):
        self.how, self.splits, self.tree = how, np.array(splits), Tree.of(how.depth, width)
        self.random, self.waiting = JavaRandom(seed), [1]
        self.drawn = math.ceil(how.column_sample * len(splits))
        self.sums: dict[int, tuple[np.ndarray, float]] = {}
        self.rows: dict[int, float] = {1: 0.0}

    def wanted(self) -> list[int]:
        """Waiting nodes that have to be added up: of two siblings the smaller, the other is what is left of their parent."""
        there = set(self.waiting)
        return [n for n in self.waiting if n ^ 1 not in there or (self.rows[n], n) < (self.rows[n ^ 1], n ^ 1)]

    def add_level(self, nodes: list[int], sums: np.ndarray, squares: np.ndarray) -> None:
        """Splits the waiting nodes by the sums of ``nodes``, or makes them leaves; their children wait next."""
        how, n_features = self.how, len(self.splits)
        known = {n: (sums[:, :n_features, k], squares[k]) for k, n in enumerate(nodes)}
        for n in self.waiting:
            if n not in known:
                whole, part = self.sums[n >> 1], known[n ^ 1]
                known[n] = whole[0] - part[0], whole[1] - part[1]
        waiting, self.waiting, self.rows = self.waiting, [], {}
        for node in waiting:
            cells, square = known[node]
            raw, weight = cells[0] + cells[1], cells[0] + cells[1] * how.positive_weight
            left = np.stack([raw, weight, cells[2]]).cumsum(axis=2)
            right = left[:, :, -1:] - left
            count, total, target = left[:, 0, -1].tolist()
            if node == 1:
                self.tree.value[1] = target / total
            # A pure node is no longer waiting in Spark ML, and draws no features.
            elif square - target * target / total <= PURE * self.sums[node >> 1][1]:
                continue
            order = range(n_features)
            if self.drawn < n_features:
                order = reservoir(n_features, self.drawn, self.random.next_long())
            order = [f for f in order if self.splits[f]]
            if not order:
                continue
            (low, low_weight, low_sum), (high, high_weight, high_sum) = left[:, order], right[:, order]
            valid = (low >= how.min_child) & (high >= how.min_child) & (np.arange(raw.shape[1]) < self.splits[order][:, None])
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = low_sum * low_sum / low_weight + high_sum * high_sum / high_weight - target * target / total
            gain = np.where(valid, gain, -np.inf)
            place, cut = divmod(int(gain.argmax()), gain.shape[1])
            if not gain[place, cut] > PURE * square:
                continue
            self.sums[node] = known[node]
            self.tree.feature[node], self.tree.cut[node] = order[place], cut
            self.tree.value[2 * node] = low_sum[place, cut] / low_weight[place, cut]
            self.tree.value[2 * node + 1] = high_sum[place, cut] / high_weight[place, cut]
            if node < 1 << (how.depth - 1):
                self.waiting += [2 * node, 2 * node + 1]
                self.rows |= {2 * node: low[place, cut], 2 * node + 1: high[place, cut]}
        self.waiting.reverse()


# --- all folds ------------------------------------------------------------------------------------------------


def _delete(spark: SparkSession, path: str | None) -> None:
    if path:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _all_sums(blocks: RDD, *given) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    parts = blocks.mapPartitions(lambda some: _sums(some, *given))
    if parts.getNumPartitions() > PARTS:
        parts = parts.reduceByKey(_both, PARTS)
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for fold, sums in parts.collect():
        found[fold] = _both(found[fold], sums) if fold in found else sums
    return found


def held_out_scores(df: DataFrame, features: Sequence[str], label: str, folds: int, how: Boosting) -> DataFrame:
    """``fold, label, score, n``: rows of every fold by label and by the score of the model learnt from the other folds.

    ``df`` has the columns ``features`` and ``label`` as doubles and ``fold``, in the partitions that trees shall grow in.
    """
    spark = df.sparkSession
    rows = df.select(*[F.col(f"`{c}`") for c in features], F.col(f"`{label}`").alias("_label"), "fold").persist()
    try:
        kind = F.col("_label")
        if not rows.filter(kind.isNull() | ~kind.isin(0.0, 1.0)).isEmpty():
            raise ValueError(f"{label} must be 0 or 1")
        counted = {(r["fold"], r["_label"]): r["n"] for r in rows.groupBy("fold", "_label").agg(F.count("*").alias("n")).collect()}
        sizes = []
        for fold in range(folds):
            sizes.append(tuple(sum(n for (f, k), n in counted.items() if f != fold and k == x) for x in (0.0, 1.0)))
            if not sum(sizes[fold]) or not any(f == fold for f, _ in counted):
                raise ValueError(f"fold {fold} has no rows to learn from or to judge by")
        thresholds = _all_borders(rows, sizes, how)
        kinds = "fold int, part int, first long, bins binary, positive binary, held binary"
        splits = [[len(t) for t in cuts] for cuts in thresholds]
        width = 1 + max(map(max, splits))
        blocks = rows.mapInArrow(lambda batches: _blocks(batches, thresholds, width), kinds).rdd.map(_unpacked)
        return _boosted(spark, blocks, splits, width, how)
    finally:
        rows.unpersist()


def _boosted(spark: SparkSession, blocks: RDD, splits: list[list[int]], width: int, how: Boosting) -> DataFrame:
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    # Blocks are passed on one by one, so a task never holds more than a few of them.
    trees, cut = None, None
    now = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    for number in range(how.trees + 1):
        before = now
        # The last round only adds the last tree.
        now = before.mapPartitions(lambda some, t=trees, k=number: _grown(some, t, k, how)).persist(StorageLevel.MEMORY_AND_DISK)
        last = number == how.trees
        if number % CUT_EVERY == CUT_EVERY - 1 or last:
            now.checkpoint()
        if last:
            now.count()
        else:
            growing = {fold: _Growing(how, some, width, how.seed + number) for fold, some in enumerate(splits)}
            while any(g.waiting for g in growing.values()):
                wanted = {fold: g.wanted() for fold, g in growing.items()}
                sums = _all_sums(now, {fold: g.tree for fold, g in growing.items()}, wanted, number, how)
                for fold, g in growing.items():
                    if g.waiting:
                        g.add_level(wanted[fold], *sums[fold])
            trees = {fold: g.tree for fold, g in growing.items()}
        before.unpersist()
        if now.isCheckpointed():
            _delete(spark, cut)
            cut = now.getCheckpointFile()
    now.unpersist()  # read from where its lineage was cut
    counted = now.mapPartitions(_held_out)
    return spark.createDataFrame(counted, "fold int, label double, score double, n double")


def _held_out(blocks: Iterator[tuple]) -> Iterator[tuple]:
    for fold, _part, _first, _bins, positive, held, scores, _drawn in blocks:
        for kind in (0, 1):
            values, n = np.unique(scores[(held == 1) & (positive == kind)], return_counts=True)
            yield from ((fold, float(kind), v, float(k)) for v, k in zip(values.tolist(), n.tolist()))
