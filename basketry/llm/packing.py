"""Packing documents into training sequences of a fixed length, as a cutting-stock problem.

Documents are cut at every full sequence; what is left of each, shorter than a sequence, is the stock problem's item.
A linear program over the histogram of these lengths finds patterns that fill a sequence, and rounding says how often
each is used. Documents are ranked among those of their length, and the rank decides pattern, sequence and place.
Rounded numbers leave some documents over and some room at the end of sequences; the documents left over are laid on
one line and cut exactly into that room, the rest of the line into full sequences, and its end into sequences whose
lengths are powers of two. So nothing is padded, and only the documents left over are cut.

Only numbers per length bin reach the driver. Ranks and running totals come from counts per group of rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import by_key, each_piece, partitions, record_batch, stored, text_bytes, texts_of
from basketry.llm.cutting_stock import rounded, solve
from basketry.llm.text_stats import DIGIT, LOWER, UPPER
from basketry.llm.tokens import fragment_ids, per_text
from basketry.llm.words import SPACE, spans, sums_before
from basketry.operators.ordering import with_running_totals

#: Tokens by which lengths are rounded up for the linear program.
STEP = 8
#: Rows per group in which ranks are counted, at least.
GROUP_ROWS = 1024
#: Tokens of the line of left-over documents that one step of the final cut takes up.
LINE = 1 << 14
#: ASCII bytes that are neither letters nor digits nor white space.
PUNCTUATION = ~(UPPER | LOWER | DIGIT | SPACE) & (np.arange(256) > 0x20) & (np.arange(256) < 0x7F)
#: Second bytes of the letters of Latin-1 after 0xC3: all but the signs of multiplication and division.
LATIN = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0) & (np.arange(256) != 0x97) & (np.arange(256) != 0xB7)


def fragments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and text numbers of the parts that are encoded one by one: words, cut after a letter where
    ASCII punctuation follows, and with small ASCII letters. So that nothing changes for the tokenizer, a capital that
    a byte beyond ASCII follows (which may combine with it) stays, only ASCII letters and those of Latin-1 count as
    letters before a cut, and words with ``<|`` (which may be special tokens) stay as they are."""
    starts, ends, doc = spans(data, offsets)
    special = np.zeros(len(data), bool)
    special[:-1] = (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    specials = sums_before(special.astype(np.int64))
    usual = np.ones(len(data) + 1, bool)
    for k in np.flatnonzero(specials[ends] != specials[starts]):
        usual[starts[k]:ends[k]] = False
    follows = np.zeros(len(data), np.uint8)
    follows[:-1] = data[1:]
    upper = usual[:-1] & UPPER[data] & (follows < 0x80)
    data = data + (upper.astype(np.uint8) << 5)
    letter = LOWER[data]
    letter[1:] |= (data[:-1] == 0xC3) & LATIN[data[1:]]
    cut = np.flatnonzero(usual[:-1] & letter & PUNCTUATION[follows]) + 1
    if len(cut):
        at = np.searchsorted(starts, cut, "right")
        cut, at = cut[cut < ends[at - 1]], at[cut < ends[at - 1]]
        starts, doc = np.insert(starts, at, cut), np.insert(doc, at, doc[at - 1])
        ends = np.insert(ends, at - 1, cut)
    return data, starts, ends, doc


def tokenize(documents: DataFrame, path: str, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``row, doc_id, n, ids``: the ids of every text and ``end_id``. ``row`` tells rows apart, whatever their ids.

    For tokenizers that ignore case, drop white space, never look across it, and split letters from punctuation.
    """

    def make(piece):
        data, offsets = text_bytes(piece.column("text"))
        data, starts, ends, doc = fragments(data, offsets)
        ids, sizes = fragment_ids(path).of_spans(data, starts, ends)
        at = per_text(sizes, np.searchsorted(doc, np.arange(len(offsets))))
        ids = np.insert(ids, at[1:], end_id)
        at = at + np.arange(len(at))
        return {"row": piece.column("row"), "doc_id": piece.column("doc_id"), "n": np.diff(at),
                "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))}

    rows = texts_of(documents, id_column, text_column).select(F.monotonically_increasing_id().alias("row"), "*")
    return each_piece(rows, make, "row long, doc_id long, n long, ids array<int>")


class Plan:
    """Which rank of which length bin goes to which sequence; a few numbers per bin and pattern."""

    def __init__(self, bins: dict[int, int], tokens: int, room: int, step: int) -> None:
        names = np.array(sorted(bins), np.int64)
        demand = np.array([bins[b] for b in names], np.int64)
        patterns, amounts = solve(names, demand, room // step)
        counts = rounded(patterns, amounts, demand, tokens // room)
        firsts = np.cumsum(counts) - counts
        self.n_sequences = int(counts.sum())
        self.of_bin: dict[int, tuple[np.ndarray, ...]] = {}
        for k, name in enumerate(names):
            used = np.flatnonzero((patterns[:, k] > 0) & (counts > 0))
            each = patterns[used, k]
            ends = np.cumsum(each * counts[used])
            self.of_bin[int(name)] = (ends - each * counts[used], ends, each, firsts[used], patterns[used, :k].sum(axis=1))

    def place(self, name: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence (-1: left over) and place in it, for ranks from 0 in a bin."""
        begins, ends, each, first, slot = self.of_bin[name]
        sequence, place = np.full(len(rank), -1, np.int64), np.zeros(len(rank), np.int64)
        if len(ends):
            at = np.searchsorted(ends, rank, "right")
            inside = at < len(ends)
            at, offset = at[inside], rank[inside] - begins[at[inside]]
            sequence[inside] = first[at] + offset // each[at]
            place[inside] = slot[at] + offset % each[at]
        return sequence, place


def _ranked(items: DataFrame) -> DataFrame:
    """``items`` (row, bin, ...) with ``rank`` from 0 inside the bin, counted group by group."""
    spark = items.sparkSession
    n_groups = min(items.count() // GROUP_ROWS + 1, max(16 * partitions(spark), 1024))
    grouped = items.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(n_groups)))
    local = Window.partitionBy("bin", "group").orderBy("row")
    numbered = stored(grouped.withColumn("local", F.row_number().over(local) - 1), "packing-items")
    sizes = numbered.groupBy("bin", "group").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bin").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("bin", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    return numbered.join(ahead, ["bin", "group"]).withColumn("rank", F.col("ahead") + F.col("local")).drop(
        "ahead", "local", "group")


def _cut_line(left: DataFrame, gaps: DataFrame) -> DataFrame:
    """Cuts documents laid end to end (row, start, begin, end) into gaps laid end to end (sequence_id, offset, begin,
    end); both cover the same line. Stretches of the line are cut independently."""

    def stretches(df: DataFrame, kind: int, key: str, extra: str) -> DataFrame:
        numbers = F.sequence(F.floor(F.col("begin") / LINE), F.floor((F.col("end") - 1) / LINE))
        return df.select(F.explode(numbers).alias("stretch"), F.lit(kind).alias("kind"), F.col(key).alias("key"),
                         F.col(extra).cast("long").alias("extra"), "begin", "end")

    def cut(batches):
        held: list[pd.DataFrame] = []

        def done():
            rows = pd.concat(held)
            lo = int(rows["stretch"].iloc[0]) * LINE
            docs, room = (rows[rows["kind"] == k].sort_values("begin") for k in (0, 1))
            starts = np.unique(np.clip(rows["begin"].to_numpy(), lo, None))
            stops = np.append(starts[1:], min(lo + LINE, int(docs["end"].max())))
            d = np.searchsorted(docs["begin"].to_numpy(), starts, "right") - 1
            g = np.searchsorted(room["begin"].to_numpy(), starts, "right") - 1
            docs, room = docs.iloc[d], room.iloc[g]
            return record_batch({
                "row": docs["key"].to_numpy(), "start": docs["extra"].to_numpy() + starts - docs["begin"].to_numpy(),
                "length": stops - starts, "sequence_id": room["key"].to_numpy(),
                "offset": room["extra"].to_numpy() + starts - room["begin"].to_numpy(),
            })

        for batch in batches:
            for _, part in batch.to_pandas().groupby("stretch", sort=False):
                if held and held[0]["stretch"].iloc[0] != part["stretch"].iloc[0]:
                    yield done()
                    held = []
                held.append(part)
        if held:
            yield done()

    both = stretches(left, 0, "row", "start").union(stretches(gaps, 1, "sequence_id", "offset"))
    return by_key(both, "stretch").mapInArrow(cut, "row long, start long, length long, sequence_id long, offset long")


def pieces_of(lengths: DataFrame, room: int = 2048, step: int = STEP) -> DataFrame:
    """``row, start, length, sequence_id, offset`` for rows of ``lengths`` (row, n): where each part of a row goes.

    Sequences are filled without gaps to ``room``, but for at most one of each smaller power of two.
    """
    spark = lengths.sparkSession
    rest = F.col("n") % room
    items = lengths.where(rest > 0).select(
        "row", (F.col("n") - rest).alias("start"), rest.alias("size"),
        F.ceil(rest / step).cast("int").alias("bin"))
    ranked = _ranked(items)
    bins = items.groupBy("bin").agg(F.count("*").alias("n"), F.sum("size").alias("tokens")).collect()
    full = lengths.where(F.col("n") >= room).select(
        "row", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / room) - 1)).alias("k"))
    tokens = sum(r["tokens"] for r in bins)
    first_free = 0
    parts = []
    if bins:
        plan = Plan({r["bin"]: r["n"] for r in bins}, tokens, room, step)

        @F.pandas_udf("sequence_id long, place long")
        def place(name: pd.Series, rank: pd.Series) -> pd.DataFrame:
            out = pd.DataFrame({"sequence_id": -1, "place": 0}, index=name.index, dtype="int64")
            for value, ranks in rank.groupby(name):
                out.loc[ranks.index, "sequence_id"], out.loc[ranks.index, "place"] = plan.place(value, ranks.to_numpy())
            return out

        placed = stored(ranked.withColumn("p", place("bin", "rank")).select("row", "start", "size", "p.*"), "packing-places")
        inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        whole = placed.where("sequence_id >= 0").select(
            "row", "start", F.col("size").alias("length"), "sequence_id",
            F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("offset"))
        line = with_running_totals(placed.where("sequence_id < 0"), [F.col("row")], {"end": "size"}).select(
            "row", "start", (F.col("end") - F.col("size")).alias("begin"), "end")
        used = placed.where("sequence_id >= 0").groupBy("sequence_id").agg(F.sum("size").alias("offset"))
        used = used.withColumn("gap", F.lit(room) - F.col("offset")).where("gap > 0")
        gaps = with_running_totals(used, [F.col("sequence_id")], {"end": "gap"}).select(
            "sequence_id", "offset", (F.col("end") - F.col("gap")).alias("begin"), "end")
        # What the line holds beyond the gaps, in full sequences and powers of two.
        filled = plan.n_sequences * room
        beyond = tokens - filled
        gap_end = filled - (placed.where("sequence_id >= 0").agg(F.sum("size")).first()[0] or 0)
        n_full, short = divmod(beyond, room)
        new = spark.range(n_full).select(
            (F.col("id") + plan.n_sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
            (F.col("id") * room + gap_end).alias("begin"), ((F.col("id") + 1) * room + gap_end).alias("end"))
        ends, at, number = [], gap_end + n_full * room, plan.n_sequences + n_full
        for power in range(short.bit_length() - 1, -1, -1):
            if short >> power & 1:
                ends.append((number, 0, at, at + (1 << power)))
                at, number = at + (1 << power), number + 1
        first_free = number
        gaps = gaps.union(new)
        if ends:
            gaps = gaps.union(spark.createDataFrame(ends, "sequence_id long, offset long, begin long, end long"))
        parts = [whole, _cut_line(line, gaps)]
    blocks = full.select(
        "row", (F.col("k") * room).alias("start"), F.lit(room).cast("long").alias("length"),
        (F.monotonically_increasing_id() + first_free).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for part in parts:
        blocks = blocks.unionByName(part)
    return blocks


def pack(
    documents: DataFrame, path: str, room: int = 2048, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Packed pieces: ``doc_id, start, length, ids`` (array of int), ``doc_tokens, sequence_id, offset``.

    Each id of each document lies in exactly one piece; the pieces of a sequence follow each other without a gap from
    offset 0 and fill it, up to ``room`` or a smaller power of two. A null or empty text is its end id alone; rows of
    equal or null id are packed one by one; an empty table gives no pieces; further columns are left out. The tokenizer
    file must be on every executor at ``path``; it must drop white space (see ``tokenize``).
    """
    tokens = stored(tokenize(documents, path, end_id, id_column, text_column), "packing-ids")
    parts = pieces_of(tokens.select("row", "n"), room)
    return tokens.join(parts, "row").select(
        "doc_id", "start", "length", F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids"),
        F.col("n").alias("doc_tokens"), "sequence_id", "offset")


def with_checksum(packed: DataFrame) -> DataFrame:
    """``packed`` with ``ids_crc32``, of the ids as little-endian unsigned 32-bit numbers, in place of the ids."""
    rest = [c for c in packed.columns if c != "ids"]

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            data = ids.flatten().to_numpy().astype("<u4")
            ends = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            sums = [zlib.crc32(data[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(sums, pa.int64())], names=[*rest, "ids_crc32"])

    return packed.mapInArrow(run, packed.select(*rest).schema.add("ids_crc32", "long"))
