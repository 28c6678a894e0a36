"""Retention from bitmaps: stored once per month, united with later deliveries, counted without meeting customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.plans.marts import retention_rates


def activity_bitmaps(stg_orders: DataFrame, number: Column) -> DataFrame:
    """The buyers of every month as bitmaps of 4 KB: ``purchase_month, bucket, buyers``.

    ``number`` is a whole number of its own for every customer id, as dense as may be; an id without one is an error.
    Orders without a customer or a date are in no month. Orders shrink to one row per customer and month before they
    meet by bucket, so a hot customer is a few rows.
    """
    named = F.coalesce(number.cast("long"), F.raise_error(F.concat(F.lit("no number for customer "), "customer_id")).cast("long"))
    bits = stg_orders.filter("customer_id IS NOT NULL AND order_date IS NOT NULL").select(
        F.trunc("order_date", "month").alias("purchase_month"), F.bitmap_bucket_number(named).alias("bucket"),
        F.bitmap_bit_position(named).alias("position")).distinct()
    return bits.repartition("bucket").groupBy("purchase_month", "bucket").agg(
        F.bitmap_construct_agg("position").alias("buyers"))


def united(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several deliveries as one per month and bucket; the same order twice counts once."""
    return bitmaps.groupBy("purchase_month", "bucket").agg(F.bitmap_or_agg("buyers").alias("buyers"))


def customer_retention(bitmaps: DataFrame) -> DataFrame:
    """``marts.customer_retention`` from ``united`` bitmaps.

    The buyers of a month who had bought by the end of month c, less those who had by the month before, are its buyers
    of cohort c. So per bucket every month's bitmap meets the running union of each earlier month, which is as many
    bitmaps as the result has months times cohorts, and only their counts leave the bucket.
    """
    so_far = Window.partitionBy("bucket").orderBy("purchase_month").rowsBetween(Window.unboundedPreceding, 0)
    known = bitmaps.select(
        "bucket", F.col("purchase_month").alias("cohort_month"), F.bitmap_or_agg("buyers").over(so_far).alias("known"))
    met = known.join(bitmaps, "bucket").filter("cohort_month <= purchase_month")
    both = met.select("bucket", "cohort_month", "purchase_month", F.explode(F.array("known", "buyers")).alias("bits"))
    shared = both.groupBy("bucket", "cohort_month", "purchase_month").agg(
        F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    cohorts = Window.partitionBy("bucket", "purchase_month").orderBy("cohort_month")
    new = shared.withColumn("n", F.col("n") - F.lag("n", 1, 0).over(cohorts))
    counted = new.groupBy("cohort_month", "purchase_month").agg(F.sum("n").alias("retained_customers"))
    return retention_rates(counted.filter("retained_customers > 0"))
