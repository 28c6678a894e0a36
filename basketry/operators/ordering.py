"""Positions and running totals over a global order, without a one-task window.

Rows are range-partitioned by group and order, sorted inside their partition, numbered there and materialised.
A small table of partition totals (one row per partition and group) then gives every partition its offset.
Materialising makes the numbering one fixed result even when an executor is lost half way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import settle

# monotonically_increasing_id keeps the partition above bit 33 and the row inside the partition below it.
ROW_BITS = 33


def _placed(df: DataFrame, by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    keys = [F.col(c) for c in by] + list(order_by)
    numbered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return settle(numbered).withColumn("_part", F.shiftright("_pos", ROW_BITS))


def _before(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def _join_offsets(rows: DataFrame, offsets: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, "_part"]
    renamed = offsets.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                             *[c for c in offsets.columns if c not in keys])
    match = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    return rows.join(renamed, match, "inner").drop(*[f"_o_{k}" for k in keys])


def with_row_number(
    df: DataFrame, order_by: Sequence[Column], by: Sequence[str] = (), name: str = "row_number",
    total: str | None = None,
) -> DataFrame:
    """``df`` with the 1-based position of each row in its group, and the size of the group as ``total``.

    ``order_by`` must be a total order (end it with a unique column).
    """
    placed = _placed(df, by, order_by)
    totals = placed.groupBy(*by, "_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    offsets = totals.withColumn("_ahead", F.coalesce(F.sum("_n").over(_before(by)), F.lit(0)))
    if total:
        offsets = offsets.withColumn(total, F.sum("_n").over(Window.partitionBy(*by)))
    joined = _join_offsets(placed, offsets.drop("_n"), by)
    number = F.col("_ahead") + F.col("_pos") - F.col("_first") + 1
    return joined.withColumn(name, number).drop("_pos", "_part", "_ahead", "_first")


def with_running_totals(
    df: DataFrame, order_by: Sequence[Column], sums: dict[str, str], by: Sequence[str] = (),
    totals_as: dict[str, str] | None = None,
) -> DataFrame:
    """``df`` with inclusive running sums: ``sums`` maps a new column to the column it adds up.

    ``totals_as`` maps further new columns to the column whose group total they carry.
    """
    totals_as = totals_as or {}
    placed = _placed(df, by, order_by)
    summed = set(sums.values()) | set(totals_as.values())
    totals = placed.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_sum_{c}") for c in summed])
    offsets = totals.withColumns(
        {
            **{f"_ahead_{n}": F.coalesce(F.sum(f"_sum_{c}").over(_before(by)), F.lit(0)) for n, c in sums.items()},
            **{n: F.sum(f"_sum_{c}").over(Window.partitionBy(*by)) for n, c in totals_as.items()},
        }
    ).drop(*[f"_sum_{c}" for c in summed])
    joined = _join_offsets(placed, offsets, by)
    inside = Window.partitionBy(*by, "_part").orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return joined.withColumns(
        {n: F.col(f"_ahead_{n}") + F.sum(c).over(inside) for n, c in sums.items()}
    ).drop("_pos", "_part", *[f"_ahead_{n}" for n in sums])
