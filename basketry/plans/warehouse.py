"""Dimensions, facts and the typed shapes of the analytics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import Moment, as_moment, count_when, money
from basketry.operators.keyed import first_per_key
from basketry.vocabulary import DEFAULT_TOPIC, PAYMENT_CATEGORIES, REGION_TIERS, TOPIC_OF_EVENT


def topic_of(event_type: F.Column) -> F.Column:
    topics = F.create_map(*[F.lit(x) for pair in TOPIC_OF_EVENT.items() for x in pair])
    return F.coalesce(F.try_element_at(topics, event_type), F.lit(DEFAULT_TOPIC))


def dim_time(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    return with_day_attributes(
        spark.range(1).select(
            F.explode(
                F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
            ).alias("full_date")
        )
    )


def with_day_attributes(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1
    return days.select(
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def region_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGION_TIERS, "region string, country string, region_tier string")


def payment_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PAYMENT_CATEGORIES, "payment_method string, method_category string, is_digital boolean"
    )


def enrich_with_reference(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a reference table, broadcast after a check of its size.

    A larger lookup joins by shuffle, where adaptive execution splits hot keys.
    """
    return df.join(lookup, key, "left")


def dim_customer(customer_360: DataFrame, as_of: Moment) -> DataFrame:
    """Rows for the customer dimension; ``customer_segment`` has no source and stays null."""
    now = as_moment(as_of)
    nothing = F.lit(None).cast("string")
    filled = lambda c, p: F.coalesce(F.col(c), F.lit(0)).cast(f"decimal({p},2)")
    return customer_360.select(
        "customer_id",
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        F.lit("India").alias("country"),
        nothing.alias("city"),
        F.coalesce("preferred_device", F.lit("Unknown")).alias("preferred_device"),
        nothing.alias("customer_segment"),
        "total_events",
        F.coalesce("total_purchases", F.lit(0)).alias("total_purchases"),
        filled("total_spend", 15).alias("total_spend"),
        filled("avg_spend", 12).alias("avg_spend"),
        F.coalesce("days_active", F.lit(0)).cast("int").alias("days_active"),
        F.col("first_event_date").alias("first_seen_date"),
        F.col("last_event_date").alias("last_seen_date"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def dim_product(events: DataFrame) -> DataFrame:
    """Latest known attributes per product."""
    seen = F.struct("event_timestamp", "event_id")
    latest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), seen)).alias(c)
    return (
        events.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(latest("product_name"), latest("category"), latest("price"), F.max("event_timestamp").alias("updated_at"))
        .withColumn("base_price", money(F.col("price"), 12))
        .drop("price")
    )


def fact_orders(events: DataFrame, loaded_at: Moment | None = None) -> DataFrame:
    """Purchases with order and customer id, defaults filled, one row per order, in the shape of the stored table.

    ``loaded_at`` is the time of the load, now if not given.
    """
    now = F.current_timestamp() if loaded_at is None else as_moment(loaded_at)
    zero = lambda c, p: F.coalesce(F.col(c), F.lit(0)).cast(f"decimal({p},2)").alias(c)
    rows = events.filter(
        (F.col("event_type") == "PURCHASE") & F.col("order_id").isNotNull() & F.col("customer_id").isNotNull()
    ).select(
        "order_id",
        "customer_id",
        "event_id",
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        zero("total_amount", 15),
        zero("discount_amount", 12),
        (zero("tax_amount", 12) if "tax_amount" in events.columns else F.lit(0).cast("decimal(12,2)").alias("tax_amount")),
        F.coalesce("payment_method", F.lit("unknown")).alias("payment_method"),
        F.coalesce(F.nullif(F.col("items_count"), F.lit(0)), F.lit(1)).alias("items_count"),
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        F.coalesce("device", F.lit("Unknown")).alias("device"),
        (F.col("delivery_type") if "delivery_type" in events.columns else F.lit(None).cast("string").alias("delivery_type")),
        now.alias("created_at"),
    )
    return schemas.shaped(
        first_per_key(rows, ["order_id"], ["event_timestamp", "event_id"])
        .withColumn("net_amount", F.col("total_amount") - F.col("discount_amount")),
        schemas.FACT_ORDERS,
    )


def fact_transactions(events: DataFrame) -> DataFrame:
    """Money movements of the four event types that have one."""
    kind = F.col("event_type")
    amount = (
        F.when(kind == "PURCHASE", F.col("total_amount"))
        .when(kind == "REFUND", F.col("refund_amount"))
        .when(kind == "SUBSCRIPTION", F.col("amount"))
        .otherwise(F.col("attempted_amount"))
    )
    return events.filter(kind.isin("PURCHASE", "REFUND", "SUBSCRIPTION", "PAYMENT_FAILURE")).select(
        F.col("event_id").alias("transaction_id"),
        "order_id",
        "customer_id",
        F.lower(kind).alias("transaction_type"),
        money(amount).alias("amount"),
        "payment_method",
        F.when(kind == "PAYMENT_FAILURE", "failed").otherwise("success").alias("status"),
        "failure_reason",
        "event_timestamp",
        F.to_date("event_timestamp").alias("event_date"),
        "region",
    )


def session_aggregates() -> list[F.Column]:
    kind = F.col("event_type")
    seen = F.struct("event_timestamp", "event_id")
    return [
        F.min("event_timestamp").alias("session_start"),
        F.max("event_timestamp").alias("session_end"),
        F.count("*").alias("event_count"),
        count_when(kind.isin("PRODUCT_VIEW", "SEARCH")).alias("page_views"),
        count_when(kind == "PRODUCT_VIEW").alias("product_views"),
        count_when(kind == "ADD_TO_CART").alias("cart_adds"),
        count_when(kind == "PURCHASE").alias("purchases"),
        F.min_by("device", seen).alias("device"),
        F.min_by("region", seen).alias("region"),
    ]


def finish_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.withColumns(
        {
            "session_duration_s": (F.unix_seconds("session_end") - F.unix_seconds("session_start")).cast("int"),
            "converted": F.col("purchases") > 0,
        }
    )


def fact_sessions(events: DataFrame) -> DataFrame:
    """Sessions by the session id the events carry."""
    return finish_sessions(
        events.filter(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.min("customer_id").alias("customer_id"), *session_aggregates())
    )


def gap_sessions(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Sessions by inactivity: a new one starts after more than ``gap_seconds`` without an event.

    Time is cut into slots as long as the gap. Events of one customer in one slot are always one session, so they
    collapse in a plain aggregate; only slots, whose number is bounded by the calendar, meet in the window.
    """
    slot = F.floor(F.unix_seconds("event_timestamp") / gap_seconds).alias("slot")
    parts = (
        events.filter(F.col("customer_id").isNotNull() & F.col("event_timestamp").isNotNull())
        .groupBy("customer_id", slot)
        .agg(*session_aggregates(), F.min(F.struct("event_timestamp", "event_id")).alias("opening"))
    )
    order = Window.partitionBy("customer_id").orderBy("slot")
    micros = F.unix_micros("session_start") - F.unix_micros(F.lag("session_end").over(order))
    numbered = parts.withColumn(
        "opens", F.when(micros <= gap_seconds * 1_000_000, 0).otherwise(1)
    ).withColumn("session_no", F.sum("opens").over(order))
    merged = numbered.groupBy("customer_id", "session_no").agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        *[F.sum(c).alias(c) for c in ("event_count", "page_views", "product_views", "cart_adds", "purchases")],
        F.min_by("device", "opening").alias("device"),
        F.min_by("region", "opening").alias("region"),
    )
    return finish_sessions(merged).withColumn(
        "session_id", F.concat_ws("-", "customer_id", F.col("session_no").cast("string"))
    )


def raw_events_landing(events: DataFrame) -> DataFrame:
    """Envelope columns plus the whole event as JSON text."""
    return events.select(
        "event_id",
        "customer_id",
        "event_type",
        F.to_json(F.struct(*events.columns)).alias("payload"),
        topic_of(F.col("event_type")).alias("kafka_topic"),
        "event_timestamp",
        F.col("event_timestamp").alias("ingested_at"),
    )


def customer_ltv_table(ltv: DataFrame) -> DataFrame:
    return ltv.select(
        "customer_id",
        money(F.col("spend_last_12m")).alias("total_spend_12m"),
        F.col("orders_last_12m").cast("int").alias("total_orders_12m"),
        F.col("avg_order_value").cast("decimal(12,2)").alias("avg_order_value"),
        "ltv_segment",
        F.col("ltv_score").cast("decimal(8,4)").alias("ltv_score"),
        money(F.col("predicted_ltv_12m")).alias("predicted_ltv_12m"),
    )


def product_performance_table(performance: DataFrame, products: DataFrame) -> DataFrame:
    named = products.select("product_id", "product_name", "category")
    return performance.join(named, "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        "view_count",
        "cart_count",
        "purchase_count",
        money(F.col("total_revenue")).alias("total_revenue"),
        F.col("avg_price").cast("decimal(12,2)").alias("avg_price"),
        F.col("cart_rate").cast("decimal(10,4)").alias("cart_rate"),
        F.col("conversion_rate").cast("decimal(10,4)").alias("conversion_rate"),
    )


def retention_table(retention: DataFrame) -> DataFrame:
    """Retention as a fraction between 0 and 1."""
    share = F.col("retained_customers") / F.col("cohort_size")
    return retention.select(
        "cohort_month",
        F.col("purchase_month").alias("period_month"),
        F.col("cohort_size").cast("int").alias("cohort_size"),
        F.col("retained_customers").cast("int").alias("retained_customers"),
        share.cast("decimal(6,4)").alias("retention_rate"),
    )
