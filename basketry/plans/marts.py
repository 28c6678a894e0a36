"""Intermediate models and marts.

Every aggregate has a map-side part, so a customer, region or product that owns a third of the rows costs one row
per task in the shuffle. Windows run only on already aggregated rows whose number per partition is bounded by the
calendar (months), never by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import Moment, as_day, band_up_to, count_when, ratio, sum_when, tier_from
from basketry.vocabulary import ACTIVITY_BANDS, ACTIVITY_LAST, VALUE_LOWEST, VALUE_TIERS


def int_customer_events(raw_events: DataFrame, as_of: Moment) -> DataFrame:
    """Per-customer behaviour: totals, counts by type, 30-day counts and derived rates."""
    today = as_day(as_of)
    recent = F.col("event_date") >= F.date_sub(today, 30)
    kind = F.col("event_type")
    named = {
        "login_count": "LOGIN",
        "product_view_count": "PRODUCT_VIEW",
        "search_count": "SEARCH",
        "cart_add_count": "ADD_TO_CART",
        "purchase_count": "PURCHASE",
        "refund_count": "REFUND",
        "payment_fail_count": "PAYMENT_FAILURE",
        "wishlist_count": "WISHLIST_ADD",
        "review_count": "REVIEW_SUBMIT",
    }
    daily = (
        raw_events.filter(F.col("customer_id").isNotNull())
        .select("customer_id", "event_type", F.to_date("event_timestamp").alias("event_date"))
        .groupBy("customer_id", "event_date")
        .agg(F.count("*").alias("events"), *[count_when(kind == t).alias(n) for n, t in named.items()])
    )
    counts = daily.groupBy("customer_id").agg(
        F.sum("events").alias("total_events"),
        F.count("event_date").alias("active_days"),
        F.min("event_date").alias("first_event_date"),
        F.max("event_date").alias("last_event_date"),
        *[F.sum(n).alias(n) for n in named],
        F.sum(F.when(recent, F.col("events")).otherwise(0)).alias("events_last_30d"),
        F.sum(F.when(recent, F.col("login_count")).otherwise(0)).alias("logins_last_30d"),
        F.sum(F.when(recent, F.col("purchase_count")).otherwise(0)).alias("purchases_last_30d"),
    )
    bought, carts, views = F.col("purchase_count"), F.col("cart_add_count"), F.col("product_view_count")
    weighted = (
        F.col("login_count") + views * 2 + F.col("search_count") + carts * 5 + bought * 10
        + F.col("review_count") * 8
    )
    return counts.withColumns(
        {
            "days_since_last_event": F.datediff(today, F.col("last_event_date")),
            "cart_abandonment_rate": ratio(carts - bought, carts, 4),
            "browse_to_buy_ratio": F.when(views > 0, ratio(bought, views, 4)).otherwise(F.lit(0)),
            "daily_engagement_score": ratio(weighted, F.col("active_days"), 2),
        }
    )


def int_customer_orders(fact_orders: DataFrame, as_of: Moment) -> DataFrame:
    """Per customer and region: volume, recency, recent activity, preferences, segment and tier."""
    today = as_day(as_of)
    day = F.col("order_date")
    year_back = day >= F.add_months(today, -12)
    month_back = day >= F.date_sub(today, 30)
    summary = (
        fact_orders.filter(F.col("total_amount") > 0)
        .withColumn("order_date", F.to_date("event_timestamp"))
        .groupBy("customer_id", "region")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_amount").alias("total_spend"),
            F.avg("total_amount").alias("avg_order_value"),
            F.max("total_amount").alias("max_order_value"),
            F.min("total_amount").alias("min_order_value"),
            F.sum("items_count").alias("total_items"),
            F.avg("items_count").alias("avg_items_per_order"),
            F.min(day).alias("first_order_date"),
            F.max(day).alias("last_order_date"),
            count_when(year_back & F.col("order_id").isNotNull()).alias("orders_last_12m"),
            sum_when(year_back, F.col("total_amount")).alias("spend_last_12m"),
            count_when(month_back & F.col("order_id").isNotNull()).alias("orders_last_30d"),
            sum_when(month_back, F.col("total_amount")).alias("spend_last_30d"),
            F.avg("discount_amount").alias("avg_discount"),
            F.sum("discount_amount").alias("total_discount"),
            F.mode("payment_method", True).alias("preferred_payment"),
            F.mode("device", True).alias("preferred_device"),
        )
    )
    lifespan = F.datediff("last_order_date", "first_order_date")
    months = F.greatest(F.floor(lifespan / 30), F.lit(1))
    return summary.withColumns(
        {
            "days_since_last_order": F.datediff(today, F.col("last_order_date")),
            "customer_lifespan_days": lifespan,
            "monthly_order_frequency": ratio(F.col("total_orders"), months, 2),
        }
    ).withColumns(
        {
            "recency_segment": band_up_to(F.col("days_since_last_order"), ACTIVITY_BANDS, ACTIVITY_LAST),
            "value_tier": tier_from(F.col("spend_last_12m"), VALUE_TIERS, VALUE_LOWEST),
        }
    )


def customer_lifetime_value(stg_orders: DataFrame, stg_customers: DataFrame, as_of: Moment) -> DataFrame:
    """Spend history, 12-month prediction, tier and 0-100 score per customer."""
    today = as_day(as_of)
    recent = F.col("order_date") >= F.add_months(today, -12)
    history = stg_orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_spend"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        count_when(recent).alias("orders_last_12m"),
        F.coalesce(sum_when(recent, F.col("total_amount")), F.lit(0).cast("decimal(25,2)")).alias("spend_last_12m"),
    )
    spend, orders = F.col("total_spend"), F.col("total_orders")
    lifespan = F.datediff("last_order_date", "first_order_date")
    idle = F.datediff(today, F.col("last_order_date"))
    score = (
        F.log10(F.greatest(spend, F.lit(1)).cast("double")) * 5
        + orders * 2
        + F.greatest(F.lit(0), F.lit(30) - idle) * 0.5
    )
    scored = history.withColumns(
        {
            "avg_order_value": ratio(spend, orders, 2),
            "customer_lifespan_days": lifespan,
            "predicted_ltv_12m": F.when(lifespan > 0, ratio(spend, lifespan, 2, 365)).otherwise(
                ratio(spend, orders, 2)
            ),
            "ltv_segment": tier_from(F.col("spend_last_12m"), VALUE_TIERS, VALUE_LOWEST),
            "ltv_score": F.least(F.lit(100.0), F.round(score, 1)),
        }
    )
    profile = stg_customers.select("customer_id", "region", "preferred_device", "activity_status")
    return scored.join(profile, "customer_id", "left")


def customer_retention(stg_orders: DataFrame) -> DataFrame:
    """Cohorts by first purchase month: customers, share retained and lost for every later month.

    Orders shrink to one row per customer and month before the cohort is attached, so the window per customer
    sees at most one row per calendar month.
    """
    active = stg_orders.select(
        "customer_id", F.trunc("order_date", "month").alias("purchase_month")
    ).distinct()
    cohorts = active.withColumn("cohort_month", F.min("purchase_month").over(Window.partitionBy("customer_id")))
    return retention_rates(
        cohorts.groupBy("cohort_month", "purchase_month").agg(F.count("*").alias("retained_customers")))


def retention_rates(counted: DataFrame) -> DataFrame:
    """Sizes, periods and shares from ``cohort_month, purchase_month, retained_customers``; small by then."""
    first = F.when(F.col("purchase_month") == F.col("cohort_month"), F.col("retained_customers"))
    sized = counted.withColumn("cohort_size", F.max(first).over(Window.partitionBy("cohort_month")))
    kept, size = F.col("retained_customers"), F.col("cohort_size")
    return sized.select(
        "cohort_month",
        "purchase_month",
        F.months_between("purchase_month", "cohort_month").cast("int").alias("period_number"),
        "cohort_size",
        "retained_customers",
        ratio(kept, size, 2, 100).alias("retention_rate_pct"),
        (size - kept).alias("churned_customers"),
        ratio(size - kept, size, 2, 100).alias("churn_rate_pct"),
    )


def monthly_revenue(stg_orders: DataFrame) -> DataFrame:
    """Orders, revenue, discounts, buyers and items by month, region, device and payment method."""
    keys = ["order_year", "order_month", "month_start", "region", "device", "payment_method"]
    return (
        stg_orders.withColumn("month_start", F.trunc("order_date", "month"))
        .groupBy(*keys)
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("total_amount").alias("gross_revenue"),
            F.sum("discount_amount").alias("total_discounts"),
            F.sum("net_amount").alias("net_revenue"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.sum("items_count").alias("total_items_sold"),
        )
        .withColumn("avg_order_value", ratio(F.col("gross_revenue"), F.col("total_orders"), 2))
    )


def revenue_trend(monthly: DataFrame, grain: str = "region") -> DataFrame:
    """Previous value, growth and year-to-date revenue per region.

    ``grain="region"`` first sums to one row per region and month. ``grain="detail"`` keeps device and payment
    method rows and orders them fully, so that the previous row is defined.
    """
    ties = []
    if grain == "region":
        monthly = monthly.groupBy("region", "order_year", "order_month", "month_start").agg(
            F.sum("gross_revenue").alias("gross_revenue"), F.sum("total_orders").alias("total_orders")
        )
    else:
        ties = ["device", "payment_method"]
    by_month = Window.partitionBy("region").orderBy("month_start", *ties)
    so_far = (
        Window.partitionBy("region", "order_year")
        .orderBy("month_start", *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    gross, before = F.col("gross_revenue"), F.col("prev_month_revenue")
    return monthly.withColumn("prev_month_revenue", F.lag("gross_revenue").over(by_month)).withColumns(
        {
            "revenue_growth_pct": ratio(gross - before, before, 2, 100),
            "ytd_revenue": F.sum("gross_revenue").over(so_far),
        }
    )


def monthly_revenue_report(stg_orders: DataFrame) -> DataFrame:
    """The full revenue mart: monthly rows with trend columns, newest and largest first."""
    return revenue_trend(monthly_revenue(stg_orders), grain="detail").orderBy(
        F.desc("month_start"), F.desc("gross_revenue")
    )


def product_analytics(raw_events: DataFrame) -> DataFrame:
    """Funnel per product from the JSON payload.

    Product lists in purchases count once for every product listed. ``unique_viewers`` is the largest count among
    the (name, category) variants of a product, as the two-level aggregate defines it.
    """
    parsed = raw_events.select(
        "customer_id",
        "event_type",
        F.from_json(
            "payload",
            "product_id string, product_name string, category string, product_ids array<string>",
        ).alias("p"),
    )
    listed = F.when(F.size("p.product_ids") > 0, F.col("p.product_ids")).otherwise(F.array("p.product_id"))
    rows = parsed.select(
        "customer_id", "event_type", "p.product_name", "p.category", F.explode(listed).alias("product_id")
    ).filter(F.col("product_id").isNotNull())
    variants = rows.groupBy("product_id", "product_name", "category", "event_type").agg(
        F.count("*").alias("event_count"), F.countDistinct("customer_id").alias("unique_customers")
    )
    kind, n = F.col("event_type"), F.col("event_count")
    total = lambda name: F.sum(F.when(kind == name, n).otherwise(0))
    funnel = variants.groupBy("product_id").agg(
        F.max("product_name").alias("product_name"),
        F.max("category").alias("category"),
        total("PRODUCT_VIEW").alias("views"),
        total("ADD_TO_CART").alias("cart_adds"),
        total("PURCHASE").alias("purchases"),
        total("REFUND").alias("refunds"),
        F.max(F.when(kind == "PRODUCT_VIEW", F.col("unique_customers"))).alias("unique_viewers"),
    )
    views, carts, bought = F.col("views"), F.col("cart_adds"), F.col("purchases")
    return funnel.withColumns(
        {
            "view_to_cart_rate": ratio(carts, views, 2, 100),
            "cart_to_purchase_rate": ratio(bought, carts, 2, 100),
            "overall_conversion_rate": ratio(bought, views, 2, 100),
            "refund_rate": ratio(F.col("refunds"), bought, 2, 100),
        }
    )


def customer_retention_report(stg_orders: DataFrame) -> DataFrame:
    """The retention mart in reading order."""
    return customer_retention(stg_orders).orderBy("cohort_month", "period_number")


def product_analytics_report(raw_events: DataFrame) -> DataFrame:
    """The product mart, most bought first."""
    return product_analytics(raw_events).orderBy(F.desc("purchases"), "product_id")
