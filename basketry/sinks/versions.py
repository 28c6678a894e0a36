"""Stored tables that are rewritten as a whole: each write is a new version folder, readers take the newest finished one.

A version counts once Spark's ``_SUCCESS`` file is in it, so readers see the old table until the new one is whole. One
writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from basketry.operators.keyed import insert_ignore, upsert


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str, finished: bool = True) -> list[int]:
    system, place = _folder(spark, path)
    if not system.exists(place):
        return []
    names = [(f.getPath(), f.getPath().getName()) for f in system.listStatus(place)]
    found = [(p, int(n[2:])) for p, n in names if n.startswith("v=") and n[2:].isdigit()]
    done = lambda p: system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
    return sorted(v for p, v in found if not finished or done(p))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version of the table at ``path``."""
    versions = _versions(spark, path)
    if not versions:
        raise ValueError(f"no finished version in {path}")
    return spark.read.parquet(f"{path}/v={versions[-1]}")


def write_version(df: DataFrame, path: str, keep: int = 2) -> None:
    """``df`` as the next version; all but the newest ``keep`` finished versions go, and leftovers of failed writes."""
    spark = df.sparkSession
    known = _versions(spark, path, finished=False)
    df.write.parquet(f"{path}/v={(known[-1] if known else 0) + 1}")
    system, place = _folder(spark, path)
    stay = _versions(spark, path)[-keep:]
    for version in _versions(spark, path, finished=False):
        if version < stay[-1] and version not in stay:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(place, f"v={version}"), True)


def upsert_stored(
    updates: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str] | None = None, order_by: Sequence[str] = (),
) -> None:
    """``upsert`` into the table at ``path``; the first write makes the table."""
    spark = updates.sparkSession
    target = read_current(spark, path) if _versions(spark, path) else updates.limit(0)
    write_version(upsert(target, updates, keys, update_cols, order_by), path)


def insert_ignore_stored(rows: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str] = ()) -> None:
    """``insert_ignore`` into the table at ``path``; the first write makes the table."""
    spark = rows.sparkSession
    target = read_current(spark, path) if _versions(spark, path) else rows.limit(0)
    write_version(insert_ignore(target, rows, keys, order_by), path)
