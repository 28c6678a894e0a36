"""Tables stored in buckets of their key: an upsert reads and writes only the buckets that its rows fall into.

The name of the partition column says how many buckets the table has, so that it can't be read or written with another
number. A bucket is one folder; untouched folders keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.keyed import upsert
from basketry.session import settle

PREFIX = "bucket_of_"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _column_of(table: DataFrame) -> str:
    return next(c for c in table.columns if c.startswith(PREFIX))


def _dealt(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``rows`` with their bucket; rows that lack a part of the key match none and are spread by all their columns."""
    given = F.lit(True)
    for k in keys:
        given = given & F.col(k).isNotNull()
    spread = F.when(given, F.xxhash64(*keys)).otherwise(F.xxhash64(*rows.columns))
    return rows.withColumn(column, F.pmod(spread, F.lit(int(column.removeprefix(PREFIX)))).cast("int"))


def _touched(table: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The part of ``table`` in the buckets of ``rows``; only their numbers, one per bucket, reach the driver."""
    numbers = [r[0] for r in rows.select(column).distinct().collect()]
    return table.filter(F.col(column).isin(numbers))


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.drop(_column_of(table))


def lookup(rows: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """The stored rows whose key is in ``rows``; only their buckets are read. A table not yet written has none."""
    spark = rows.sparkSession
    if not _exists(spark, path):
        return rows.limit(0)
    table = spark.read.parquet(path)
    column = _column_of(table)
    asked = rows.select(*[F.col(k).cast(table.schema[k].dataType).alias(k) for k in keys]).distinct()
    asked = _dealt(asked, keys, column)
    return _touched(table, asked, column).join(asked, [*keys, column], "left_semi").drop(column)


def upsert_buckets(
    updates: DataFrame, path: str, keys: Sequence[str], buckets: int = 64, update_cols: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
) -> None:
    """``keyed.upsert`` into the table at ``path``; the first write makes it, in ``buckets`` buckets.

    Keys take the stored types before they are dealt. The merged buckets are stored before the old ones are replaced, a
    bucket at a time; readers at work meanwhile must read again. One writer at a time.
    """
    spark = updates.sparkSession
    if _exists(spark, path):
        table = spark.read.parquet(path)
        column = _column_of(table)
        typed = updates.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in updates.columns])
        rows = settle(_dealt(typed, keys, column))
        target = _touched(table, rows, column)
    else:
        column = f"{PREFIX}{buckets}"
        rows = settle(_dealt(updates, keys, column))
        target = rows.limit(0)
    refreshed = update_cols if update_cols is not None else [c for c in updates.columns if c not in keys]
    merged = settle(upsert(target, rows, [*keys, column], refreshed, order_by))
    (
        merged.repartition(column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
