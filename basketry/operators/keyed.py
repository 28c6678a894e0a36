"""Keyed writes as joins: first row per key, upsert, insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_given(keys: Sequence[str]) -> Column:
    given = F.lit(True)
    for k in keys:
        given = given & F.col(k).isNotNull()
    return given


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key, the smallest by ``order_by`` (nulls last) and then by the whole row.

    A minimum over structs, so copies of a hot key collapse before the shuffle. Null keys form one group.
    """
    rest = [c for c in df.columns if c not in keys]
    places = [x for c in order_by for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c).alias(f"_by_{c}"))]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*places, *rest)).alias("_first"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def first_of_known_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """``first_per_key`` for rows with a whole key; rows that lack a part of it are no copies of each other and stay."""
    given = _all_given(keys)
    return first_per_key(df.filter(given), keys, order_by).unionByName(df.filter(~given))


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """New target: rows with new keys are added, rows with known keys take ``update_cols`` from the update.

    The target must be unique by key. Of several updates for one key the first by ``order_by``, then by the whole row,
    counts. Rows with a null key part are never equal to each other, as in SQL: they stay, or are added, and take no
    part in the join. ``update_cols`` defaults to all non-key columns. Columns absent from ``updates`` keep their value
    or are null.
    """
    given = set(updates.columns)
    refreshed = set(update_cols) if update_cols is not None else given - set(keys)
    unknown = (refreshed | given) - set(target.columns)
    if unknown:
        raise ValueError(f"columns not in the target: {sorted(unknown)}")
    whole = _all_given(keys)
    first = first_per_key(updates.filter(whole), keys, order_by)
    old = target.filter(whole).withColumn("_known", F.lit(True)).alias("old")
    new = first.withColumn("_given", F.lit(True)).alias("new")
    match = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    is_known = F.col("_known").isNotNull()
    is_given = F.col("new._given").isNotNull()

    def merged(c: str) -> F.Column:
        kind = target.schema[c].dataType
        if c in keys:
            return F.coalesce(f"old.{c}", f"new.{c}").cast(kind).alias(c)
        if c not in given:
            return F.col(f"old.{c}").alias(c)
        take_new = is_given & (~is_known | F.lit(c in refreshed))
        return F.when(take_new, F.col(f"new.{c}").cast(kind)).otherwise(F.col(f"old.{c}")).alias(c)

    def shaped(c: str) -> F.Column:
        return (F.col(c) if c in given else F.lit(None)).cast(target.schema[c].dataType).alias(c)

    joined = old.join(new, match, "full").select(*[merged(c) for c in target.columns])
    added = updates.filter(~whole).select(*[shaped(c) for c in target.columns])
    return joined.unionByName(target.filter(~whole)).unionByName(added)


def insert_ignore(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Target plus the rows whose key it lacks; within the batch the first row of a key wins.

    Rows without a whole key are equal to none, as in SQL, and are all added.
    """
    fresh = first_of_known_keys(rows, keys, order_by).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))
