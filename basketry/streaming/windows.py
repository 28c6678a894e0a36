"""Event-time window metrics. Every function takes a batch or a streaming DataFrame and means the same on both.

Exact distinct counts are chained aggregations: first one row per (window, keys, user) with partial sums, then one
row per (window, keys). State grows with distinct users per open window, not with events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.functions import count_when
from basketry.session import state_partitions

TIME = "event_timestamp"


def _is(event_type: str) -> F.Column:
    return F.col("event_type") == event_type


def _watermarked(df: DataFrame, delay: str) -> DataFrame:
    return df.withWatermark(TIME, delay) if df.isStreaming else df


def _bounds(df: DataFrame, both: bool = False) -> DataFrame:
    ends = {"window_start": F.col("w.start")}
    if both:
        ends["window_end"] = F.col("w.end")
    return df.withColumns(ends).drop("w")


def revenue_per_hour(
    events: DataFrame, watermark: str = "1 hour", window: str = "1 hour", slide: str | None = None
) -> DataFrame:
    amount = F.col("total_amount").cast("decimal(15,2)")
    bought = events.filter(_is("PURCHASE") & F.col("total_amount").isNotNull())
    summed = (
        _watermarked(bought, watermark)
        .groupBy(F.window(TIME, window, slide).alias("w"), "region")
        .agg(
            F.sum(amount).alias("total_revenue"),
            F.count("event_id").alias("order_count"),
            F.avg(amount).alias("avg_order_value"),
            F.max(amount).alias("max_order_value"),
            F.min(amount).alias("min_order_value"),
        )
    )
    return _bounds(summed, both=True)


def revenue_per_region(
    events: DataFrame, watermark: str = "10 minutes", window: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    amount = F.col("total_amount").cast("decimal(15,2)")
    per_user = (
        _watermarked(events.filter(_is("PURCHASE")), watermark)
        .groupBy(F.window(TIME, window, slide).alias("w"), "region", "country", "customer_id")
        .agg(F.sum(amount).alias("revenue"), F.count("order_id").alias("orders"))
    )
    summed = per_user.groupBy("w", "region", "country").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        F.count("customer_id").alias("unique_customers"),
    )
    return _bounds(summed)


def most_viewed_products(
    events: DataFrame, watermark: str = "1 hour", window: str = "1 hour", slide: str | None = "15 minutes"
) -> DataFrame:
    price = F.col("price").cast("decimal(15,2)")
    viewed = events.filter(_is("PRODUCT_VIEW") & F.col("product_id").isNotNull())
    keys = ["product_id", "product_name", "category"]
    per_user = (
        _watermarked(viewed, watermark)
        .groupBy(F.window(TIME, window, slide).alias("w"), *keys, "customer_id")
        .agg(F.count("event_id").alias("views"), F.sum(price).alias("prices"), F.count(price).alias("priced"))
    )
    summed = per_user.groupBy("w", *keys).agg(
        F.sum("views").alias("view_count"),
        F.try_divide(F.sum("prices"), F.sum("priced")).alias("avg_price"),
        F.count("customer_id").alias("unique_viewers"),
    )
    return _bounds(summed)


def conversion_rate(
    events: DataFrame, watermark: str = "1 hour", window: str = "1 hour", slide: str | None = None
) -> DataFrame:
    counted = (
        _watermarked(events, watermark)
        .groupBy(F.window(TIME, window, slide).alias("w"), "region")
        .agg(
            count_when(_is("PRODUCT_VIEW")).alias("views"),
            count_when(_is("ADD_TO_CART")).alias("cart_adds"),
            count_when(_is("PURCHASE")).alias("purchases"),
        )
    )
    rate = lambda part, base: F.coalesce(F.try_divide(part, base), F.lit(0.0))
    return _bounds(
        counted.withColumns(
            {
                "view_to_cart_rate": rate("cart_adds", "views"),
                "cart_to_purchase_rate": rate("purchases", "cart_adds"),
                "overall_conversion_rate": rate("purchases", "views"),
            }
        )
    )


def active_users(
    events: DataFrame, watermark: str = "10 minutes", window: str = "5 minutes", slide: str | None = None
) -> DataFrame:
    """Distinct users and sessions per window.

    Each event enters once as its user and once as its session, so both counts are exact whatever users share a
    session, and one chain of aggregations serves both.
    """
    as_user = F.struct(F.lit("user").alias("role"), F.col("customer_id").alias("id"))
    as_session = F.struct(F.lit("session").alias("role"), F.col("session_id").alias("id"))
    tagged = _watermarked(events, watermark).select(
        TIME, "device", "region", "event_id", F.inline(F.array(as_user, as_session))
    )
    per_id = tagged.groupBy(F.window(TIME, window, slide).alias("w"), "device", "region", "role", "id").agg(
        F.count("event_id").alias("events")
    )
    is_user = F.col("role") == "user"
    summed = per_id.groupBy("w", "device", "region").agg(
        F.count(F.when(is_user, F.col("id"))).alias("active_users"),
        F.sum(F.when(is_user, F.col("events")).otherwise(0)).alias("total_events"),
        F.count(F.when(~is_user, F.col("id"))).alias("active_sessions"),
    )
    return _bounds(summed)


METRICS = {
    "revenue_per_hour": revenue_per_hour,
    "revenue_per_region": revenue_per_region,
    "top_products": most_viewed_products,
    "conversion_rate": conversion_rate,
    "active_users": active_users,
}


def run_aggregations(
    silver: DataFrame, output: str, checkpoints: str, *, available_now: bool = False,
    metrics: dict = METRICS, partitions: int | None = None,
) -> list[StreamingQuery]:
    """One query per metric over a streaming silver table, appending finished windows to Parquet."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    with state_partitions(silver.sparkSession, partitions):
        return [
            metric(silver)
            .writeStream.queryName(name)
            .format("parquet")
            .option("path", f"{output}/{name}")
            .option("checkpointLocation", f"{checkpoints}/{name}")
            .outputMode("append")
            .trigger(**trigger)
            .start()
            for name, metric in metrics.items()
        ]
