"""The monthly revenue mart kept up to date by deliveries: new, late and corrected orders touch only their months.

Orders lie stored by month, the mart beside them by month, and a bucketed table says in which month each order is. A
delivery looks up where its orders were before, and only the months they leave or enter are read, counted anew and
replaced; distinct customers are exact because a touched month is counted from its orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.keyed import first_per_key
from basketry.plans import marts
from basketry.session import settle
from basketry.sinks.buckets import lookup, upsert_buckets

MONTH = "month_start"


def _replace_months(rows: DataFrame, path: str, months: list) -> None:
    """``rows`` in place of the stored ``months``; a month that has no row left goes."""
    spark = rows.sparkSession
    rows.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    left = {r[0] for r in rows.select(MONTH).distinct().collect()}
    for month in months:
        if month not in left:
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH}={month}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _stored_months(spark: SparkSession, path: str, like: DataFrame, months: list) -> DataFrame:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(path).filter(F.col(MONTH).isin(months))


def deliver_orders(orders: DataFrame, folder: str, buckets: int = 64) -> list:
    """Takes staged ``orders`` in: each replaces the stored order of its id, if there is one. The touched months.

    Of several rows of one id the first by ``order_timestamp`` counts. A delivery that broke off may be repeated: where
    its orders were before is written last.
    """
    spark = orders.sparkSession
    dated = orders.withColumn(MONTH, F.trunc("order_date", "month"))
    new = settle(first_per_key(dated, ["order_id"], ["order_timestamp"]))
    known = lookup(new.select("order_id", MONTH), f"{folder}/months", ["order_id"])
    touched = new.select(MONTH).union(known.select(MONTH)).distinct()
    months = sorted(r[0] for r in touched.collect())  # bounded by the calendar
    kept = _stored_months(spark, f"{folder}/orders", new, months).join(new.select("order_id"), "order_id", "left_anti")
    rows = settle(kept.unionByName(new))
    _replace_months(rows, f"{folder}/orders", months)
    _replace_months(settle(marts.monthly_revenue(rows)), f"{folder}/monthly", months)
    upsert_buckets(new.select("order_id", MONTH), f"{folder}/months", ["order_id"], buckets)
    return months


def monthly_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart as the deliveries so far have left it."""
    return spark.read.parquet(f"{folder}/monthly")
