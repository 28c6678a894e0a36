"""Inverted-file index over vectors: an approximate search that reads few lists; ``vectors`` holds the exact one.

Centres and the number of lists to ask are learnt from a bounded sample; every vector is listed, and those of the lists
asked are ranked by their exact similarity.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.vectors import (
    CELL_BYTES, DIMENSIONS, QUERY_BYTES, SCORE_CELLS, _unit_rows, best_in_cells, common_id, similarity_topk,
)
from basketry.session import settle

#: Most vectors of the sample, and most bytes of it; the smallest id hashes are taken.
SAMPLE, SAMPLE_BYTES = 20_000, 64 << 20
#: Vectors of the sample that ask all others to learn how many lists hold their neighbours.
TRIALS = 256
#: Vectors of a list that one task scores at a time.
LIST_ROWS = 100_000
#: Vectors of a list that one task takes; longer lists are split, and each part gets all queries of the list.
CELL_ROWS = 100_000
ROUNDS = 12


def _sample(vectors: DataFrame) -> tuple[np.ndarray, int]:
    """Unit vectors of the sample and the number of all vectors."""
    shape = vectors.agg(F.count("*"), F.max(F.size("embedding"))).first()
    rows = min(SAMPLE, SAMPLE_BYTES // (8 * (shape[1] or DIMENSIONS)))
    place = F.xxhash64("vec_id")
    share = min(1.0, 2 * rows / max(1, shape[0]))
    few = vectors.filter(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30)))
    taken = few.orderBy(place, "vec_id").limit(rows).select("embedding").toPandas()["embedding"]
    return _unit_rows(np.stack(taken.to_numpy()).astype("float64")) if len(taken) else np.zeros((0, 1)), shape[0]


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, but for the points' own lengths, which don't change an order of centres."""
    return (centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T


def _centres(points: np.ndarray, lists: int) -> np.ndarray:
    """Centres by Lloyd's rounds from evenly spaced sample points; a centre without points stays where it is."""
    centres = points[np.linspace(0, len(points) - 1, lists).astype(int)]
    for _ in range(ROUNDS):
        nearest = np.concatenate([
            _distances(part, centres).argmin(axis=1) for part in np.array_split(points, -(-len(points) * lists // SCORE_CELLS))])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=lists)[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def _probes(points: np.ndarray, centres: np.ndarray, recall: float, k: int) -> int:
    """The fewest nearest lists that hold a share of ``recall`` of the ``k`` neighbours of the trial points."""
    asked = points[:TRIALS]
    own = np.concatenate([_distances(part, centres).argmin(axis=1) for part in np.array_split(points, max(1, len(points) // 1000))])
    order = np.argsort(_distances(asked, centres), axis=1, kind="stable").argsort(axis=1)
    near = np.argsort(-(asked @ points.T), axis=1, kind="stable")[:, :k]
    needed = np.sort(np.take_along_axis(order, own[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) + 1


def _nearest(centres: np.ndarray, probes: int) -> Column:
    """The ``probes`` nearest lists of ``embedding``."""

    def nearest(batch: pd.Series) -> pd.Series:
        found, step = [], max(1, SCORE_CELLS // len(centres))
        for start in range(0, len(batch), step):
            points = _unit_rows(np.stack(batch.iloc[start : start + step].to_numpy()).astype("float64"))
            found += list(np.argsort(_distances(points, centres), axis=1, kind="stable")[:, :probes].astype("int32"))
        return pd.Series(found, dtype=object)

    return F.pandas_udf(nearest, "array<int>")("embedding")


def build_index(vectors: DataFrame, path: str, lists: int | None = None, recall: float = 0.95, k: int = 10) -> None:
    """Writes the index of ``vectors`` (vec_id, embedding) below ``path``; rows without an id or a vector are left out.

    There are about as many lists as the root of the number of vectors, at most one per eight vectors of the sample. The
    lists to ask are the fewest that give ``recall`` for ``k`` neighbours within the sample, where neighbours are farther
    away than in the whole. Rows are stored in order of their lists; a list with very many rows spans several files.
    """
    spark = vectors.sparkSession
    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").select("vec_id", "embedding")
    points, n = _sample(rows)
    lists = max(1, min(lists or math.isqrt(n), len(points) // 8))
    centres = _centres(points, lists) if len(points) else points
    probes = _probes(points, centres, recall, k) if len(points) else 0
    learnt = [(i, probes, [float(x) for x in c]) for i, c in enumerate(centres)]
    spark.createDataFrame(learnt, "list int, probes int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/centres")
    listed = rows.withColumn("list", _nearest(centres, 1)[0] if len(points) else F.lit(0))
    listed.repartitionByRange("list", F.xxhash64("vec_id")).sortWithinPartitions("list").write.mode("overwrite").parquet(
        f"{path}/lists")


def read_centres(spark: SparkSession, path: str) -> tuple[np.ndarray, int]:
    """The centres, which the sample bounds, and the lists to ask."""
    rows = spark.read.parquet(f"{path}/centres").orderBy("list").collect()
    return np.array([r.centre for r in rows]), rows[0].probes if rows else 0


def search_index(
    queries: DataFrame, path: str, k: int = 10, probes: int | None = None, digits: int = 6, list_rows: int = LIST_ROWS,
    query_bytes: int = QUERY_BYTES, score_cells: int = SCORE_CELLS, cell_rows: int = CELL_ROWS, cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """The nearest vectors of the ``probes`` nearest lists for every query (query_id, embedding): ``query_id, vec_id,
    similarity, place`` as ``similarity_topk`` returns them, which answers the queries whose lists hold fewer than ``k``.

    A list meets the queries that ask it in cells of at most about ``cell_rows`` vectors and ``cell_bytes`` of queries,
    so neither a hot list nor one that all queries ask falls to one task. A task scores ``list_rows`` vectors against
    ``query_bytes`` of queries at a time; smaller ones send no row to more cells. Equal similarities go by id among the vectors
    of the lists asked.
    """
    spark = queries.sparkSession
    stored = spark.read.parquet(f"{path}/lists")
    centres, learnt = read_centres(spark, path)
    asked = queries.filter("query_id IS NOT NULL AND embedding IS NOT NULL").select("query_id", "embedding")
    if not len(centres):
        return similarity_topk(asked, stored, k, digits)
    id_type, vec_type = asked.schema["query_id"].dataType, stored.schema["vec_id"].dataType
    common = common_id(id_type, vec_type)
    dealt = settle(asked.withColumn("list", F.explode(_nearest(centres, probes or learnt))))
    # One row per list, of which the sample allows few thousands.
    sizes = stored.groupBy("list").agg(F.ceil(F.count("*") / max(list_rows, cell_rows)).cast("int").alias("shares"))
    loads = dealt.groupBy("list").agg(
        F.ceil(F.count("*") * (8 * centres.shape[1]) / max(query_bytes, cell_bytes)).cast("int").alias("blocks"))
    cells = F.broadcast(sizes.join(loads, "list"))

    def number(c: str, n: str) -> Column:
        return F.pmod(F.xxhash64(c), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def cell(rows: DataFrame, kind: int, c: str) -> DataFrame:
        block = F.col("list").cast("long") * (1 << 32) + F.col("block")
        return rows.select(block.alias("block"), "share", F.lit(kind).alias("kind"), F.col(c).cast(common).alias("id"),
                           F.col("embedding").cast("array<double>").alias("vector"))

    left = dealt.join(cells, "list").withColumn("block", number("query_id", "blocks")).withColumn("share", every("shares"))
    right = stored.join(cells, "list").withColumn("share", number("vec_id", "shares")).withColumn("block", every("blocks"))
    grid = cell(left, 0, "query_id").union(cell(right, 1, "vec_id"))
    grid = grid.repartition("block", "share").sortWithinPartitions("block", "share", "kind")
    found = settle(best_in_cells(grid, k, digits, score_cells, id_type, vec_type, query_bytes, list_rows))
    enough = found.filter(F.col("place") == min(k, stored.count())).select("query_id")
    short = settle(asked.join(enough, "query_id", "left_anti"))
    if short.isEmpty():
        return found
    exact = similarity_topk(short, stored, k, digits, query_bytes, score_cells, cell_bytes)
    return found.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(exact)


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, exact neighbours, and the share of them that was ``found``. Of neighbours as far as the last
    exact one any will do."""
    reach = exact.groupBy("query_id").agg(F.min("similarity").alias("reach"), F.count("*").alias("wanted"))
    near = found.join(reach, "query_id").filter(F.col("similarity") >= F.col("reach"))
    hits = reach.join(near.groupBy("query_id").agg(F.count("*").alias("hits")), "query_id", "left")
    return hits.agg(F.count("*").alias("queries"), F.sum("wanted").alias("neighbours"),
                    (F.sum(F.coalesce("hits", F.lit(0))) / F.sum("wanted")).alias("recall"))
