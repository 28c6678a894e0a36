"""Staging views over the landing and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import Moment, as_moment
from basketry.vocabulary import ACTIVITY_BANDS, ACTIVITY_LAST


def _words(c) -> F.Column:
    return F.initcap(F.trim(c))


def _typed_events(raw_events: DataFrame, field, as_of: Moment, start: Moment, *more: F.Column) -> DataFrame:
    moment = F.col("event_timestamp").cast("timestamp")
    return raw_events.filter(
        F.col("customer_id").isNotNull()
        & F.col("event_type").isNotNull()
        & F.col("event_timestamp").between(as_moment(start), as_moment(as_of))
    ).select(
        "event_id",
        "customer_id",
        F.upper(F.trim("event_type")).alias("event_type"),
        field("session_id").alias("session_id"),
        "kafka_topic",
        _words(field("device")).alias("device"),
        _words(field("region")).alias("region"),
        moment.alias("event_timestamp"),
        F.to_date(moment).alias("event_date"),
        F.year(moment).alias("event_year"),
        F.month(moment).alias("event_month"),
        F.hour(moment).alias("event_hour"),
        (F.dayofweek(moment) - 1).alias("day_of_week"),
        "ingested_at",
        *more,
    )


def stg_events(raw_events: DataFrame, as_of: Moment, start: Moment) -> DataFrame:
    """Typed events from the landing table, between ``start`` and ``as_of``."""
    return _typed_events(raw_events, lambda name: F.get_json_object("payload", f"$.{name}"), as_of, start)


def with_variant(raw_events: DataFrame) -> DataFrame:
    """The landing table with its payload parsed once, as a VARIANT that keeps every field, known or not.

    ``payload_broken`` marks text that is no JSON; its variant is null, and the text stays.
    """
    parsed = F.try_parse_json("payload")
    return raw_events.withColumns({"fields": parsed, "payload_broken": F.col("payload").isNotNull() & parsed.isNull()})


def stg_events_variant(raw_events: DataFrame, as_of: Moment, start: Moment) -> DataFrame:
    """``stg_events`` from the parsed payload, with ``fields`` (all of it) and ``payload_broken``.

    A field of another type is read as text where that is possible, and is null in a broken payload.
    """
    rows = raw_events if "fields" in raw_events.columns else with_variant(raw_events)
    field = lambda name: F.try_variant_get("fields", f"$.{name}", "string")
    return _typed_events(rows, field, as_of, start, F.col("fields"), F.col("payload_broken"))


def stg_orders(fact_orders: DataFrame) -> DataFrame:
    """Valid orders with date parts and the net amount."""
    moment = F.col("event_timestamp")
    return fact_orders.filter(
        F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (F.col("total_amount") > 0)
    ).select(
        "order_id",
        "customer_id",
        moment.alias("order_timestamp"),
        F.to_date(moment).alias("order_date"),
        F.year(moment).alias("order_year"),
        F.month(moment).alias("order_month"),
        "total_amount",
        "discount_amount",
        "tax_amount",
        net_amount().alias("net_amount"),
        "payment_method",
        "items_count",
        _words(F.col("region")).alias("region"),
        _words(F.col("device")).alias("device"),
    )


def net_amount() -> F.Column:
    return (F.col("total_amount") - F.coalesce(F.col("discount_amount"), F.lit(0))).cast("decimal(15,2)")


def stg_customers(dim_customer: DataFrame, as_of: Moment) -> DataFrame:
    """Customer dimension with the activity status at ``as_of``."""
    status = F
    for days, name in ACTIVITY_BANDS:
        oldest = as_moment(as_of) - F.expr(f"interval {int(days)} days")
        status = status.when(F.col("last_seen_date") >= oldest, name)
    return dim_customer.select(
        "customer_id", "region", "country", "preferred_device", "customer_segment", "total_events",
        "total_purchases", "total_spend", "avg_spend", "days_active", "first_seen_date", "last_seen_date",
        status.otherwise(ACTIVITY_LAST).alias("activity_status"),
        "updated_at",
    )
