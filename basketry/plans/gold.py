"""Gold aggregates over silver events. Null keys are left out and an empty sum is 0."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import count_when, elapsed_days, money, sum_when


def _bought() -> F.Column:
    return F.col("event_type") == "PURCHASE"


def _calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"event_year": F.year("event_timestamp"), "event_month": F.month("event_timestamp")})


def _zero(amount: F.Column) -> F.Column:
    return F.coalesce(amount, F.lit(0).cast("decimal(25,2)"))


def revenue_by_region(events: DataFrame) -> DataFrame:
    amount = money(F.col("total_amount"))
    return (
        _calendar(events.filter(_bought() & F.col("region").isNotNull() & F.col("event_timestamp").isNotNull()))
        .groupBy("region", "event_year", "event_month")
        .agg(
            _zero(F.sum(amount)).alias("total_revenue"),
            F.count("event_id").alias("order_count"),
            F.avg(amount).alias("avg_order_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


def revenue_by_category(events: DataFrame) -> DataFrame:
    """Purchases by category. A purchase with a category list counts under each category listed."""
    listed = F.when(F.size("categories") > 0, F.col("categories")).otherwise(F.array("category"))
    return (
        _calendar(events.filter(_bought() & F.col("event_timestamp").isNotNull()))
        .select("event_id", "total_amount", "event_year", "event_month", F.explode(listed).alias("category"))
        .filter(F.col("category").isNotNull())
        .groupBy("category", "event_year", "event_month")
        .agg(
            _zero(F.sum(money(F.col("total_amount")))).alias("total_revenue"),
            F.count("event_id").alias("order_count"),
        )
    )


def customer_360(events: DataFrame) -> DataFrame:
    """One row per customer over all event types, in one aggregate."""
    amount, seen = money(F.col("total_amount")), F.struct("event_timestamp", "event_id")
    return (
        events.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("event_id").alias("total_events"),
            count_when(_bought()).alias("total_purchases"),
            _zero(F.sum(amount)).alias("total_spend"),
            F.avg(amount).alias("avg_spend"),
            F.max("event_timestamp").alias("last_event_date"),
            F.min("event_timestamp").alias("first_event_date"),
            F.mode("device", True).alias("preferred_device"),
            F.min_by("region", F.when(F.col("region").isNotNull(), seen)).alias("region"),
        )
        .withColumn("days_active", elapsed_days(F.col("last_event_date"), F.col("first_event_date")))
    )


def product_performance(events: DataFrame) -> DataFrame:
    """Views, carts, purchases and revenue of every viewed product, in one conditional aggregate."""
    kind = F.col("event_type")
    listed = F.when(F.size("product_ids") > 0, F.col("product_ids")).otherwise(F.array("product_id"))
    rows = events.select(
        "event_id", "event_type", "price", "total_amount", F.explode(listed).alias("product_id")
    ).filter(F.col("product_id").isNotNull() & kind.isin("PRODUCT_VIEW", "ADD_TO_CART", "PURCHASE"))
    named = lambda name: (kind == name) & F.col("event_id").isNotNull()
    zero = F.lit(0).cast("decimal(19,6)")
    return (
        rows.groupBy("product_id")
        .agg(
            count_when(named("PRODUCT_VIEW")).alias("view_count"),
            F.coalesce(
                F.avg(F.when(kind == "PRODUCT_VIEW", F.col("price").cast("decimal(15,2)"))), zero
            ).alias("avg_price"),
            count_when(named("ADD_TO_CART")).alias("cart_count"),
            count_when(named("PURCHASE")).alias("purchase_count"),
            _zero(sum_when(kind == "PURCHASE", money(F.col("total_amount")))).alias("total_revenue"),
        )
        .filter(F.col("view_count") > 0)
        .withColumns(
            {
                "cart_rate": F.col("cart_count") / F.col("view_count"),
                "conversion_rate": F.col("purchase_count") / F.col("view_count"),
            }
        )
    )
