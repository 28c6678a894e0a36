"""Ticket documents, embeddings and exact cosine search."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from basketry.functions import unit
from basketry.session import settle

DIMENSIONS = 384
QUERY_BYTES = 32 << 20
SCORE_CELLS = 4_000_000
#: Queries that a cell of a grid holds, whatever blocks they are scored in: every further cell costs all vectors once more.
CELL_BYTES = 32 << 20
#: Directions on which copies are looked for, and the width of their steps in farthest distances of a copy.
DIRECTIONS, STEP = 8, 20


def tickets_to_documents(tickets: DataFrame) -> DataFrame:
    """Issue text with its metadata as a struct."""
    return tickets.select(
        F.col("issue_text").alias("text"),
        F.struct("ticket_id", "customer_id", "status", "created_at").alias("metadata"),
    )


def embed(
    df: DataFrame, text: str = "text", dim: int = DIMENSIONS, model: Callable[[pd.Series], pd.Series] | None = None
) -> DataFrame:
    """``df`` with a unit-length ``embedding``.

    The default hashes the words of the whole text into ``dim`` buckets. A real sentence model plugs in as
    ``model``, a function from a batch of texts to a batch of vectors.
    """
    if model is not None:
        run = F.pandas_udf(model, "array<float>")
        raw = df.withColumn("_raw", run(F.coalesce(F.col(text), F.lit(""))))
        return raw.withColumn("embedding", unit(F.col("_raw"))).drop("_raw")
    stages = [
        Tokenizer(inputCol="_text", outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim),
        Normalizer(inputCol="_counts", outputCol="_unit"),
    ]
    filled = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    hashed = Pipeline(stages=stages).fit(filled).transform(filled)
    return hashed.withColumn("embedding", vector_to_array("_unit", "float32")).drop(
        "_text", "_words", "_counts", "_unit"
    )


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _grid_top(k: int, digits: int, cells: int, query_bytes: int, vector_rows: int | None):
    """A function from the cells of the grid, each its queries and then its vectors, to the best ``k`` per query.

    ``query_bytes`` of queries and ``vector_rows`` vectors are scored at a time.
    """

    def hopeful(asked: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, vector and similarity of those that can be among the best ``k``; ids settle ties later."""
        sims = np.round(asked @ matrix.T, digits) + 0.0
        near = np.ones_like(sims, dtype=bool)
        if len(matrix) > k:
            # Only vectors at least as near as a query's k-th nearest here can matter.
            edge = len(matrix) - k
            near = sims >= np.partition(sims, edge, axis=1)[:, edge : edge + 1]
        query, place = np.nonzero(near)
        return query, place, sims[query, place]

    def best(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        names = ["query", "vec_id", "similarity"]
        every = pd.DataFrame({n: np.concatenate(parts) for n, parts in zip(names, zip(*found))})
        ranked = every.sort_values(["query", "similarity", "vec_id"], ascending=[True, False, True])
        kept = ranked.groupby("query", sort=False).head(k)
        return tuple(kept[n].to_numpy() for n in names)

    def best_of(queries: pd.DataFrame, vectors: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
        asked = _unit_rows(np.stack(queries["vector"].to_numpy()).astype("float64"))
        rows = max(1, query_bytes // (8 * max(1, asked.shape[1])))
        step = max(1, cells // len(asked))
        step = step if vector_rows is None else min(step, vector_rows)
        found, waiting = [], 0
        for batch in vectors:
            for start in range(0, len(batch), step):
                part = batch.iloc[start : start + step]
                matrix = _unit_rows(np.stack(part["vector"].to_numpy()).astype("float64"))
                ids = part["id"].to_numpy()
                for first in range(0, len(asked), rows):
                    query, place, sims = hopeful(asked[first : first + rows], matrix)
                    found.append((query + first, ids[place], sims))
                    waiting += len(query)
                if waiting > cells // 8:
                    found, waiting = [best(found)], 0
        if not found:
            return None
        query, near, sims = best(found)
        return pd.DataFrame({"query_id": queries["id"].to_numpy()[query], "vec_id": near, "similarity": sims})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = (
            (cell, part) for batch in batches for cell, part in batch.groupby(["block", "share"], sort=False)
        )
        for _, group in itertools.groupby(parts, key=lambda p: p[0]):
            asked, first = [], None
            frames = (part for _, part in group)
            for part in frames:
                is_query = part["kind"] == 0
                asked.append(part[is_query])
                if not is_query.all():
                    first = part[~is_query]
                    break
            queries = pd.concat(asked)
            if first is not None and len(queries):
                found = best_of(queries, itertools.chain([first], frames))
                if found is not None:
                    yield found

    return run


def common_id(id_type: DataType, vec_type: DataType) -> str:
    """One id column for queries and vectors: whole numbers as they are, other ids as text."""
    whole = all(t.typeName() in ("long", "integer", "short", "byte") for t in (id_type, vec_type))
    return "long" if whole else "string"


def best_in_cells(
    grid: DataFrame, k: int, digits: int, score_cells: int, id_type: DataType, vec_type: DataType,
    query_bytes: int = QUERY_BYTES, vector_rows: int | None = None,
) -> DataFrame:
    """The best ``k`` per query of a ``grid`` (block, share, kind, id, vector) whose cells lie whole in a partition, in
    order, queries (kind 0) first. ``query_bytes`` of queries and ``vector_rows`` vectors are scored at a time."""
    common = common_id(id_type, vec_type)
    run = _grid_top(k, digits, score_cells, query_bytes, vector_rows)
    found = grid.mapInPandas(run, f"query_id {common}, vec_id {common}, similarity double")
    found = found.withColumns({"query_id": F.col("query_id").cast(id_type), "vec_id": F.col("vec_id").cast(vec_type)})
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _places(digits: int, around: bool) -> Callable[[pd.Series], pd.Series]:
    """A function from vectors to the numbers of the places where they lie on a few fixed directions, in wide steps:
    their own one or, with ``around``, all where a copy may lie. A zero vector has none.

    Unit vectors whose similarity rounds to one are no farther apart than ``far``, and so on each direction.
    """
    far = 10.0 ** (-digits / 2) * (1 + 1e-6) + 1e-9

    def numbers(steps: np.ndarray) -> np.ndarray:
        mixed = np.zeros(len(steps), dtype="uint64")
        for c in range(steps.shape[1]):
            mixed = (mixed ^ steps[:, c].astype("int64").view("uint64")) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return mixed.view("int64")

    def keys(batch: pd.Series) -> pd.Series:
        found = np.empty(len(batch), dtype=object)
        sizes = batch.map(len).to_numpy()
        for size in np.unique(sizes):
            rows = np.nonzero(sizes == size)[0]
            points = _unit_rows(np.stack(batch.iloc[rows].to_numpy()).astype("float64").reshape(len(rows), size))
            signs = np.random.default_rng(int(size)).choice([-1.0, 1.0], (size, DIRECTIONS)) / np.sqrt(max(1, size))
            at, some = points @ signs, points.any(axis=1)
            width = far * STEP
            low, high = (np.floor((at + d) / width) for d in ((-far, far) if around else (0.0, 0.0)))
            for row, a, b, any_ in zip(rows, low, high, some):
                every = np.array(list(itertools.product(*[(x,) if x == y else (x, y) for x, y in zip(a, b)])))
                found[row] = np.unique(numbers(every)) if any_ else np.zeros(0, dtype="int64")
        return pd.Series(found, dtype=object)

    return keys


def _cosines(digits: int) -> Callable[[pd.Series, pd.Series], pd.Series]:
    def cosines(left: pd.Series, right: pd.Series) -> pd.Series:
        same, found = (left.map(len) == right.map(len)).to_numpy(), np.zeros(len(left))
        for size in left[same].map(len).unique():
            rows = np.nonzero(same & (left.map(len) == size).to_numpy())[0]
            a, b = (_unit_rows(np.stack(x.iloc[rows].to_numpy()).astype("float64")) for x in (left, right))
            found[rows] = np.round((a * b).sum(axis=1), digits) + 0.0
        return pd.Series(found)

    return cosines


def copies_topk(queries: DataFrame, vectors: DataFrame, k: int, digits: int = 6) -> DataFrame:
    """The ``k`` nearest vectors of those queries that have at least ``k`` copies: vectors whose similarity rounds to one,
    the most there is, so nothing else can be nearer and the smallest ids win. Other queries have no row.

    A copy lies near its query on any direction. So both get the numbers of their places on a few directions, a query
    those of the neighbouring places as well, and meet by number; the similarity then decides. Of equal vectors the
    ``k`` smallest ids meet the queries, so text that is stored very often makes no hot key.
    """
    many = "array<long>"
    named = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        "vec_id", F.col("embedding").alias("_other"),
        F.explode(F.pandas_udf(_places(digits, False), many)("embedding")).alias("_at"))
    order = Window.partitionBy("_at", F.xxhash64("_other")).orderBy("vec_id")
    few = named.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= k).drop("_row")
    dealt = queries.filter("query_id IS NOT NULL AND embedding IS NOT NULL").select(
        "query_id", "embedding", F.explode(F.pandas_udf(_places(digits, True), many)("embedding")).alias("_at"))
    met = dealt.join(few, "_at").withColumn("similarity", F.pandas_udf(_cosines(digits), "double")("embedding", "_other"))
    same = met.filter(F.col("similarity") >= 1.0).select("query_id", "vec_id", "similarity")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("vec_id"))
    ranked = settle(same.withColumn("place", place).filter(F.col("place") <= k))
    return ranked.join(ranked.filter(F.col("place") == k).select("query_id"), "query_id", "left_semi")


def similarity_topk(
    queries: DataFrame, vectors: DataFrame, k: int = 3, digits: int = 6, query_bytes: int = QUERY_BYTES,
    score_cells: int = SCORE_CELLS, cell_bytes: int = CELL_BYTES, copies_first: bool = False,
) -> DataFrame:
    """The ``k`` nearest vectors by cosine for every query; ties by id, a zero vector has similarity 0.

    ``queries`` has (query_id, embedding), ``vectors`` has (vec_id, embedding); rows without an id or a vector match
    nothing. Queries fall into cells of about ``cell_bytes``, vectors into shares, and both meet in a cell
    of a grid: a task scores the vectors of its share, as they stream by, against blocks of about ``query_bytes`` as
    matrix products and keeps ``k`` per query. Every query goes to each share and every vector to each cell of queries,
    so small blocks cost no further copy of a vector; k rows per query and share
    come back, and nothing passes through the driver but two counts. A task holds about ``score_cells`` scores.

    With ``copies_first`` queries that have at least ``k`` copies (``copies_topk``) are answered by these, and only the
    others go to the grid; worth it where most queries are stored vectors themselves.
    """
    spark = queries.sparkSession
    id_type, vec_type = queries.schema["query_id"].dataType, vectors.schema["vec_id"].dataType
    asked = queries.filter("query_id IS NOT NULL AND embedding IS NOT NULL")
    if copies_first:
        asked = settle(asked.select("query_id", "embedding"))
        found = settle(copies_topk(asked, vectors, k, digits))
        rest = settle(asked.join(found.select("query_id").distinct(), "query_id", "left_anti"))
        if rest.isEmpty():
            return found
        return found.unionByName(similarity_topk(rest, vectors, k, digits, query_bytes, score_cells, cell_bytes))
    shape = asked.agg(F.count("*"), F.max(F.size("embedding"))).first()
    blocks = max(1, -(-8 * shape[0] * (shape[1] or 1) // max(query_bytes, cell_bytes)))
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(c: str, n: int) -> F.Column:
        return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")

    def every(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    vector = F.col("embedding").cast("array<double>").alias("vector")
    common = common_id(id_type, vec_type)
    left = asked.select(number("query_id", blocks).alias("block"), every(shares).alias("share"), F.lit(0).alias("kind"),
                        F.col("query_id").cast(common).alias("id"), vector)
    right = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select(
        every(blocks).alias("block"), number("vec_id", shares).alias("share"), F.lit(1).alias("kind"),
        F.col("vec_id").cast(common).alias("id"), vector)
    grid = left.union(right).repartition(shares, "block", "share").sortWithinPartitions("block", "share", "kind")
    return best_in_cells(grid, k, digits, score_cells, id_type, vec_type, query_bytes)


def search_tickets(query_texts: DataFrame, documents: DataFrame, k: int = 3, dim: int = DIMENSIONS) -> DataFrame:
    """Nearest ticket documents for each query text, with ticket id, status and text."""
    asked = embed(query_texts, "text", dim).select("query_id", "embedding")
    stored = documents.withColumn("vec_id", F.col("metadata.ticket_id"))
    hits = similarity_topk(asked, stored.select("vec_id", "embedding"), k, copies_first=True)
    shown = stored.select("vec_id", F.col("metadata.status").alias("status"), "text")
    return hits.join(shown, "vec_id").withColumnRenamed("vec_id", "ticket_id")


def replace_collection(documents: DataFrame, path: str) -> None:
    """Write all embedded documents as the new content of the collection."""
    documents.write.mode("overwrite").parquet(path)
