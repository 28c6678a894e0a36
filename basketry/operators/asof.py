"""As-of join: to every row the newest row of another table that is not younger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, columns: Sequence[str], grain: str = "day",
) -> DataFrame:
    """``left`` with ``columns`` of the newest row of ``right`` of the same ``key`` whose time is at or before its own.

    Both tables are laid one below the other and read in order of time, inside parts of one key and one ``grain`` of the
    calendar; what a part begins with comes from a table of one row per part. So a key that owns many rows is many
    parts, and no pair of rows is built that is not in the result. Of several rows of one time the largest by
    ``columns`` counts. Rows of ``left`` without a key or time, or too early, get nulls; such rows of ``right`` match none.
    """
    part = F.date_trunc(grain, "_t").alias("_part")
    given = lambda time: F.col(key).isNotNull() & F.col(time).isNotNull()
    asked = left.filter(given(left_time)).select(
        F.col(key).alias("_k"), F.col(left_time).alias("_t"), F.lit(1).alias("_turn"), F.struct(*left.columns).alias("_row"))
    known = right.filter(given(right_time)).select(
        F.col(key).alias("_k"), F.col(right_time).alias("_t"), F.lit(0).alias("_turn"), F.struct(*columns).alias("_value"))
    both = asked.unionByName(known, allowMissingColumns=True).withColumn("_part", part)

    newest = F.max(F.when(F.col("_turn") == 0, F.struct("_t", "_value"))).alias("_newest")
    parts = both.groupBy("_k", "_part").agg(newest)
    before = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("_k", "_part", F.last("_newest", True).over(before)["_value"].alias("_carried"))

    # Rows of the right table come first among equals, the largest last.
    order = Window.partitionBy("_k", "_part").orderBy("_t", "_turn", "_value").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("_seen", F.last("_value", True).over(order)).filter(F.col("_turn") == 1)
    found = seen.join(carried, ["_k", "_part"], "left").withColumn("_found", F.coalesce("_seen", "_carried"))
    out = found.select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in columns])
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns]
    return out.unionByName(left.filter(~given(left_time)).select("*", *nothing))
