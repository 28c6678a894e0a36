"""Dashboard and lookup queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.functions import Moment, as_moment, count_when


def kpi_stats(fact_orders: DataFrame, scores: DataFrame, as_of: Moment) -> DataFrame:
    """One row: orders, revenue, customers active in 30 days, high-risk customers."""
    since = as_moment(as_of) - F.expr("interval 30 days")
    recent = F.when(F.col("event_timestamp") >= since, F.col("customer_id"))
    zero = F.lit(0).cast("decimal(25,2)")
    from_orders = fact_orders.agg(
        F.count("*").alias("total_orders"),
        F.coalesce(F.sum("total_amount"), zero).alias("total_revenue"),
        F.countDistinct(recent).alias("active_customers"),
        F.lit(0).cast("bigint").alias("high_risk"),
    )
    none = F.lit(0).cast("bigint")
    from_scores = scores.agg(
        none.alias("total_orders"),
        zero.alias("total_revenue"),
        none.alias("active_customers"),
        count_when(F.col("churn_segment") == "high_risk").alias("high_risk"),
    )
    merged = from_orders.unionByName(from_scores)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def total_customers(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.agg(F.count("*").alias("total_customers"))


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def customer_profile(
    wanted: DataFrame, dim_customer: DataFrame, fact_orders: DataFrame, scores: DataFrame, recent: int = 10
) -> DataFrame:
    """Profile, newest orders and churn score for the customers in ``wanted`` (column ``customer_id``).

    The rank filter reaches the map side of the window, so a customer with very many orders sends ``recent`` rows
    per task; the collected list has at most ``recent`` entries.
    """
    ids = wanted.select("customer_id").distinct()
    newest = Window.partitionBy("customer_id").orderBy(F.desc("event_timestamp"), F.desc("order_id"))
    orders = (
        fact_orders.join(ids, "customer_id", "left_semi")
        .select("customer_id", "order_id", "event_timestamp", "total_amount", "payment_method")
        .withColumn("place", F.row_number().over(newest))
        .filter(F.col("place") <= recent)
        .groupBy("customer_id")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("place", "order_id", "event_timestamp", "total_amount", "payment_method"))
            ).alias("recent_orders")
        )
    )
    profile = dim_customer.join(ids, "customer_id", "left_semi").select(
        "customer_id", "region", "total_events", "total_purchases", "total_spend", "avg_spend", "last_seen_date"
    )
    churn = scores.select("customer_id", "churn_probability", "churn_segment", "scored_at")
    return profile.join(orders, "customer_id", "left").join(churn, "customer_id", "left")


def latest_dq_results(results: DataFrame, k: int = 20) -> DataFrame:
    return (
        results.withColumn("failure_rate", F.round("failure_rate", 4))
        .orderBy(F.desc("checked_at"), "rule_name", "table_name")
        .limit(k)
    )


def monthly_revenue_by_region(fact_orders: DataFrame, start: Moment, end: Moment) -> DataFrame:
    return (
        fact_orders.filter(F.col("event_timestamp").between(as_moment(start), as_moment(end)))
        .groupBy(F.date_trunc("month", "event_timestamp").alias("time"), "region")
        .agg(F.sum("total_amount").alias("value"))
    )


def top_churn_risk(scores: DataFrame, k: int = 15) -> DataFrame:
    return (
        scores.filter(F.col("churn_segment").isin("high_risk", "medium_risk"))
        .select("customer_id", F.round("churn_probability", 4).alias("shown"), "churn_segment", "scored_at",
                "churn_probability")
        .orderBy(F.desc("churn_probability"), "customer_id")
        .limit(k)
        .select("customer_id", F.col("shown").alias("churn_probability"), "churn_segment", "scored_at")
    )


def latest_pipeline_runs(runs: DataFrame, k: int = 20) -> DataFrame:
    return (
        runs.select("dag_id", "task_id", "status", "records_processed", "duration_seconds", "started_at")
        .orderBy(F.desc("started_at"), "dag_id", "task_id")
        .limit(k)
    )


def feature_snapshots(store: DataFrame, k: int = 5) -> DataFrame:
    return (
        store.groupBy("snapshot_date")
        .agg(F.count("*").alias("customer_count"))
        .orderBy(F.desc("snapshot_date"))
        .limit(k)
    )


def churn_distribution(scores: DataFrame) -> DataFrame:
    return scores.groupBy("churn_segment").agg(
        F.count("*").alias("customer_count"), F.round(F.avg("churn_probability"), 3).alias("avg_probability")
    )


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


READS = ("select", "with", "from", "values", "table")


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """A read-only query over the registered views."""
    words = query.strip().lstrip("(").split(None, 1)
    if not words or words[0].lower() not in READS:
        raise ValueError("only queries are allowed")
    plan = spark.sql(f"SELECT * FROM ({query.strip().rstrip(';')})")
    return plan
