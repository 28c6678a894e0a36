"""Ranked lexical search for a set of items, by bag deduplication.

A document counts only through the terms that some item has: its bag, how often it holds each of them. Documents with
equal bags and equal length weight score alike for every item; such a class is scored once, whatever its size, and
gives its members in ascending order of their id. Classes meet the items in blocks, as matrix products, and each task
keeps ten documents per item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import words as w
from basketry.llm.common import each_piece, record_batch, stored, text_bytes, texts_of
from basketry.llm.text_stats import DIGIT, LOWER, UPPER
from basketry.operators.ordering import with_running_totals

#: Bytes of ASCII that are in no term; all bytes beyond ASCII are.
BETWEEN = ~(DIGIT | LOWER | UPPER) & (np.arange(256) < 0x80)
#: Bytes of item texts that are searched for at a time: their terms travel to every task.
ROUND_BYTES = 500_000
#: Items, and classes, that meet in one matrix product.
ITEMS, CLASSES = 128, 1024
#: Doubles hold whole numbers exactly up to here; a score of more terms than fit is added up in integers.
EXACT = 1 << 53
#: No weight times share is larger: weights stay below 1000 * ln(2**64), shares below 10**6.
MOST = 45_000 * 10**6


def terms_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct terms of a column of texts, and of every occurrence which term it is and in which text."""
    data, offsets = text_bytes(texts)
    data = data + (UPPER[data].astype(np.uint8) << 5)
    starts, ends, doc = w.spans(data, offsets, BETWEEN)
    names, which = w.distinct(data, starts, ends)
    return names, which, doc


def bags(documents: DataFrame, terms: list[bytes], id_column: str, text_column: str) -> DataFrame:
    """``doc_id``, ``n`` (all terms, with repeats) and ``bag``: pairs of a number in ``terms`` and how often the document
    has it, as unsigned 32-bit numbers, rising."""
    number = {term: k for k, term in enumerate(terms)}

    def make(piece):
        names, which, doc = terms_of(piece.column("text"))
        known = np.array([number.get(name, -1) for name in names], np.int64)
        term = known[which]
        size = len(terms) or 1
        pairs, counts = np.unique(doc[term >= 0] * size + term[term >= 0], return_counts=True)
        flat = np.column_stack([pairs % size, counts]).astype("<u4")
        cuts = np.searchsorted(pairs // size, np.arange(1, piece.num_rows))
        return {
            "doc_id": piece.column("doc_id"), "n": np.bincount(doc, minlength=piece.num_rows).astype(np.int64),
            "bag": pa.array([part.tobytes() for part in np.split(flat, cuts)], pa.binary()),
        }

    return each_piece(texts_of(documents, id_column, text_column), make, "doc_id long, n long, bag binary")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of all pairs of a column of bags."""
    raw = column.to_pylist()
    flat = np.frombuffer(b"".join(raw), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(raw)), [len(b) // 8 for b in raw]), flat[:, 0], flat[:, 1]


def _holders(table: DataFrame, n_terms: int) -> np.ndarray:
    """In how many bags each term is."""

    def count(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column("bag"))[1], minlength=n_terms)
        found = np.flatnonzero(total)
        yield record_batch({"term": found.astype(np.int32), "n": total[found]})

    out = np.zeros(n_terms, np.int64)
    rows = table.select("bag").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for row in rows.toLocalIterator():
        out[row["term"]] = row["n"]
    return out


def _classes(table: DataFrame, n_documents: int, n_words: int, k: int) -> DataFrame:
    """One row per distinct bag and length weight: ``m``, ``bag`` and its first ``k`` ``members`` (none, id) by id, null
    last. The hash brings equal bags together; the bags themselves decide whether they are equal."""
    m = F.expr(f"10 + (90L * n * {n_documents}L) div {n_words}L")
    rows = table.where(F.octet_length("bag") > 0).select(
        F.xxhash64("bag", m).alias("hash"), m.alias("m"), "bag",
        F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id")).alias("member"))
    place = F.row_number().over(Window.partitionBy("hash", "m", "bag").orderBy("member"))
    first = rows.withColumn("place", place).where(F.col("place") <= k)
    return first.groupBy("hash", "m", "bag").agg(F.sort_array(F.collect_list("member")).alias("members"))


class Best:
    """The ``k`` best documents of each item so far: by score, then id, null last."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.rows = [np.zeros((0, 3), np.int64) for _ in range(n_items)]  # minus score, none, id
        self.least = np.ones(n_items, np.int64)  # scores below can't enter

    def offer(self, item: int, scores: np.ndarray, members: list[list[tuple[bool, int]]]) -> None:
        """Classes with their scores for ``item``; only the first ``k`` by score and first member can matter."""
        at = np.flatnonzero(scores >= self.least[item])
        if len(at) > self.k:
            bar = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
            at = at[scores[at] >= bar]
        order = sorted(at.tolist(), key=lambda c: (-scores[c], members[c][0]))[:self.k]
        new = [(-int(scores[c]), none, name) for c in order for none, name in members[c]]
        every = np.concatenate([self.rows[item], np.array(new, np.int64).reshape(-1, 3)])
        self.rows[item] = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))][:self.k]
        if len(self.rows[item]) == self.k:
            self.least[item] = max(1, -self.rows[item][-1, 0])


def _scored(classes: DataFrame, items: list[tuple[int | None, np.ndarray]], weights: np.ndarray, k: int) -> DataFrame:
    """``item_id, none, doc_id, score``: the best ``k`` documents of every item in each task."""
    def met() -> Iterator[tuple[int, np.ndarray, np.ndarray, type]]:
        """Blocks of items: the number of the first, all their terms, and which item has which."""
        for first in range(0, len(items), ITEMS):
            part = items[first:first + ITEMS]
            terms = np.unique(np.concatenate([t for _, t in part]))
            has = np.zeros((len(terms), len(part)), np.uint8)
            for column, (_, own) in enumerate(part):
                has[np.searchsorted(terms, own), column] = 1
            yield first, terms, has, np.float64 if max(len(own) for _, own in part) * MOST < EXACT else np.int64

    def run(batches):
        best, blocks = Best(len(items), k), list(met())
        for batch in batches:
            for start in range(0, batch.num_rows, CLASSES):
                part = batch.slice(start, CLASSES)
                row, term, tf = _unpacked(part.column("bag"))
                m = part.column("m").to_numpy()
                share = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                members = [[(x["none"], x["id"]) for x in own] for own in part.column("members").to_pylist()]
                for first, terms, has, kind in blocks:
                    at = np.searchsorted(terms, term)
                    inside = np.flatnonzero(terms[np.minimum(at, len(terms) - 1)] == term)
                    table = np.zeros((part.num_rows, len(terms)), kind)
                    table[row[inside], at[inside]] = share[inside]
                    scores = (table @ has.astype(kind)).astype(np.int64)
                    for column in np.flatnonzero(scores.max(axis=0) >= best.least[first:first + scores.shape[1]]).tolist():
                        best.offer(first + column, scores[:, column], members)
        for (name, _), rows in zip(items, best.rows):
            if len(rows):
                yield record_batch({
                    "item_id": pa.array([name] * len(rows), pa.int64()), "none": rows[:, 1].astype(bool),
                    "doc_id": rows[:, 2], "score": -rows[:, 0]})

    return classes.select("m", "bag", "members").mapInArrow(run, "item_id long, none boolean, doc_id long, score long")


def _rounds(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with their distinct terms, in rounds of about ``ROUND_BYTES`` of text."""
    rows = items.select(F.col(f"`{id_column}`").cast("long").alias("item_id"),
                        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"size": F.octet_length("text") + 1, "row": F.monotonically_increasing_id()})
    lined = with_running_totals(rows, [F.col("item_id"), F.col("row")], {"end": "size"})
    # An item goes to the round where its last row ends, so that all its rows are in one.
    last = lined.groupBy("item_id").agg(F.max("end").alias("last"))
    dealt = lined.select("item_id", "text").join(last.withColumnRenamed("item_id", "name"), F.col("item_id").eqNullSafe(F.col("name")))
    dealt = stored(dealt.select("item_id", "text", F.floor(F.col("last") / ROUND_BYTES).alias("round")), "search-items")
    for number in [r["round"] for r in dealt.select("round").distinct().orderBy("round").collect()]:
        found: dict[int | None, set[bytes]] = {}
        for row in dealt.where(F.col("round") == number).select("item_id", "text").toLocalIterator():
            found.setdefault(row["item_id"], set()).update(terms_of(pa.array([row["text"]], pa.large_string()))[0])
        yield [(name, sorted(terms)) for name, terms in found.items() if terms]


def search(
    documents: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """The ``k`` documents of ``documents`` that score highest for each item: ``item_id, rank, doc_id, score``.

    Terms are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. A term's weight is
    floor(1000 * ln((2N + 2) / (2df + 1))); a document's length weight m is 10 + 90 * n * N div L; its score sums over
    the item's distinct terms weight * (10**9 * tf div (1000 * tf + 8 * m)). Only scores above zero count; equal scores
    go by ascending id, null last. Null and empty texts have no terms; rows of one item id (null is one) are one item;
    repeated documents are listed once each; empty tables give no rows; other columns are left out.

    Items are taken in rounds of a bounded size of text; each round reads the documents once.
    """
    spark = documents.sparkSession
    found = None
    for part in _rounds(items, item_id_column, item_text_column):
        terms = sorted(set().union(*(own for _, own in part)))
        number = {term: place for place, term in enumerate(terms)}
        table = stored(bags(documents, terms, id_column, text_column), "bags")
        total = table.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("words")).first()
        if not total["documents"]:
            break
        holders = _holders(table, len(terms)).tolist()
        weights = np.array([math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * df + 1))) for df in holders], np.int64)
        numbered = [(name, np.array([number[t] for t in own], np.int64)) for name, own in part]
        classes = _classes(table, total["documents"], total["words"], k)
        rows = stored(_scored(classes, numbered, weights, k), "search-best")
        found = rows if found is None else found.union(rows)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), "none", "doc_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(
        "item_id", "rank", F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "score")
