"""Deduplication for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.keyed import first_of_known_keys
from basketry.session import settle


#: Up to so many repeated keys (eight bytes each) are sent to every task.
REPEATED_KEYS = 2_000_000


def dedup_batch(
    df: DataFrame, key: str = "event_id", order_by: Sequence[str] = ("event_timestamp",), most: int = REPEATED_KEYS,
) -> DataFrame:
    """First row per key, undated rows last. Rows without a key are no copies of each other: all of them stay.

    Keys that occur more than once are found by their hash, from the key column alone; only rows that have one of these
    hashes are compared, all others pass as they are, without a shuffle or a sort. Copies collapse before the shuffle,
    so a hot key stays cheap. Beyond ``most`` repeated hashes all rows are compared.
    """
    hashed = F.when(F.col(key).isNotNull(), F.xxhash64(key)).alias("_hash")
    counted = df.filter(F.col(key).isNotNull()).select(hashed).groupBy("_hash").agg(F.count("*").alias("n"))
    repeated = settle(counted.filter(F.col("n") > 1).select("_hash"))
    if repeated.count() > most:
        return first_of_known_keys(df, [key], list(order_by))
    rows = df.withColumn("_hash", hashed)
    met = F.broadcast(repeated)
    alone = rows.join(met, "_hash", "left_anti").drop("_hash")
    several = rows.join(met, "_hash", "left_semi").drop("_hash")
    return alone.unionByName(first_of_known_keys(several, [key], list(order_by)))


def dedup_stream(
    df: DataFrame, key: str | Column = "event_id", time: str | None = "event_timestamp", delay: str = "1 hour",
    spread: Column | None = None,
) -> DataFrame:
    """One row per key while a copy may still come; state is dropped ``delay`` after the key was seen.

    Rows whose key is null are no copies of each other: all of them stay. ``time`` is the column whose watermark tells
    how far the stream is; rows older than the watermark are late and left out. With ``time=None`` the moment at which
    the engine takes a row up counts instead: then no row is ever late, in whatever order old data arrives.

    Copies of one key meet in one task. Where a key may be very hot, ``spread`` (any column expression with few
    values, such as a remainder of the offset) removes copies per value first, so the last step sees few of them.
    """
    named = F.col(key) if isinstance(key, str) else key
    marked = df.withColumn("_key", F.coalesce(named.cast("string"), F.concat(F.lit("no key "), F.expr("uuid()"))))
    if time is None:
        marked, time = marked.withColumn("_taken", F.current_timestamp()), "_taken"
    marked = marked.withWatermark(time, delay)
    if spread is not None:
        marked = marked.withColumn("_spread", spread).dropDuplicatesWithinWatermark(["_key", "_spread"]).drop("_spread")
    return marked.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_taken")


def duplicate_rows(df: DataFrame, key: str = "event_id") -> DataFrame:
    """All rows whose (non-null) key occurs more than once.

    Keys are counted first and the repeated ones stored; they meet the rows in a semi join, which adaptive execution
    turns into a broadcast where they are few bytes and splits where one key is hot.
    """
    repeated = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1)
    return df.join(settle(repeated.select(key)), key, "left_semi")


def duplicate_row_count(df: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: total rows and rows sharing a non-null key. Needs no join."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    shared = F.when((F.col("n") > 1) & F.col(key).isNotNull(), F.col("n")).otherwise(0)
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(shared), F.lit(0)).alias("failed_records"),
    )
