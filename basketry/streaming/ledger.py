"""A stored ledger of the keys a stream has taken up, for copies that come after its state has forgotten them.

The ledger holds a folder ``batch=N`` per micro-batch, in buckets of the key's hash, with Parquet Bloom filters on the
key. A micro-batch reads the buckets that its keys fall into; a few keys go to the scan as literals, which skips files
and row groups by their Bloom filters. Keys are text and compared whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import setting
from basketry.streaming.compaction import compact, live_batches

#: Fixed: a ledger can't be read with another number.
BUCKETS = 64
#: Up to so many keys are looked up one by one.
FEW = 256


#: How the files of a ledger are written, for its compaction as well.
OPTIONS = {"parquet.bloom.filter.enabled#key": "true", "parquet.bloom.filter.adaptive.enabled#key": "true"}


def _dealt(keys: DataFrame) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))


def known_keys(asked: DataFrame, path: str, before: int, few: int = FEW) -> DataFrame:
    """The distinct, non-null keys of ``asked`` (column ``key``) that batches before number ``before`` have taken up.

    Batches from ``before`` on are not read, so a micro-batch that is run again doesn't find its own keys.
    """
    spark = asked.sparkSession
    keys = asked.filter("key IS NOT NULL").select("key").distinct()
    batches = [b for b in live_batches(spark, path) if int(b.removeprefix("batch=").partition("-")[0]) < before]
    if not batches:
        return keys.limit(0)
    stored = spark.read.schema("key string, bucket int").option("basePath", path).parquet(*[f"{path}/{b}" for b in batches])
    dealt = _dealt(keys).persist()
    try:
        # At most ``BUCKETS`` numbers and ``few`` keys reach the driver.
        numbers = [r[0] for r in dealt.select("bucket").distinct().collect()]
        listed = [r[0] for r in dealt.select("key").limit(few + 1).collect()]
    finally:
        dealt.unpersist()
    there = stored.filter(F.col("bucket").isin(numbers))
    if len(listed) <= few:
        return there.filter(F.col("key").isin(listed)).select("key").distinct()
    return keys.join(there.select("key"), "key", "left_semi")


def add_keys(taken: DataFrame, path: str, batch_id: int) -> None:
    """The non-null keys of a micro-batch (column ``key``) as its folder, which a repeated batch replaces."""
    rows = _dealt(taken.filter("key IS NOT NULL").select("key").distinct())
    with setting(rows.sparkSession, "spark.sql.adaptive.enabled", "true"):
        (
            rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "key")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .options(**OPTIONS)
            .partitionBy("bucket")
            .parquet(f"{path}/batch={batch_id}")
        )


def compact_ledger(spark: SparkSession, path: str, keep: int = 10, at_least: int = 10) -> int:
    """Small batch folders into large ones, as ``compaction.compact``, in the order and with the filters of a ledger."""
    return compact(spark, path, ["bucket"], keep, at_least, order=["bucket", "key"], options=OPTIONS)
