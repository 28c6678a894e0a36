"""Schemas of the event payload and of the warehouse tables, as DDL text."""

from __future__ import annotations

from pyspark.sql import types as T

ENVELOPE = (
    "event_id string, customer_id string, event_type string, session_id string, device string, "
    "region string, country string, city string, ip_address string, user_agent string, "
    "timestamp string, kafka_topic string, ingestion_time string, schema_version string"
)

# Names and types of the stored and transported tables.
# One wide nullable row: the union of the fields of all event types, lists included.
PAYLOAD = (
    ENVELOPE
    + ", product_id string, product_name string, category string, subcategory string, price double, "
    "quantity int, total_amount double, discount_amount double, tax_amount double, order_id string, "
    "payment_method string, search_query string, results_count int, session_duration_seconds int, "
    "login_method string, success boolean, failure_reason string, cart_total double, "
    "refund_amount double, plan string, amount double, "
    "product_ids array<string>, product_names array<string>, categories array<string>, "
    "items_count int, retry_count int, attempted_amount double, reason string, initiated_by string, "
    "action string, billing_cycle string, coupon_code string, delivery_type string, "
    "view_duration_seconds int, referrer string"
)

SOURCE_COLUMNS = "topic string, partition int, offset bigint, broker_timestamp timestamp"

CLEAN_COLUMNS = (
    "event_timestamp timestamp, event_date date, event_hour int, year int, month int, day int, "
    "processing_timestamp timestamp, processing_date date"
)

FLAG_COLUMNS = (
    "dq_missing_customer_id boolean, dq_missing_event_type boolean, dq_invalid_timestamp boolean, "
    "dq_negative_amount boolean, dq_future_timestamp boolean, dq_passed boolean"
)

SILVER = ", ".join([PAYLOAD, SOURCE_COLUMNS, CLEAN_COLUMNS, FLAG_COLUMNS])

FACT_ORDERS = (
    "order_id string, customer_id string, event_timestamp timestamp, event_date date, "
    "total_amount decimal(15,2), discount_amount decimal(12,2), tax_amount decimal(12,2), "
    "net_amount decimal(15,2), payment_method string, items_count int, region string, device string, "
    "delivery_type string, created_at timestamp"
)

DIM_CUSTOMER = (
    "customer_id string, region string, country string, city string, preferred_device string, "
    "customer_segment string, total_events bigint, total_purchases bigint, total_spend decimal(15,2), "
    "avg_spend decimal(12,2), days_active int, first_seen_date timestamp, last_seen_date timestamp, "
    "created_at timestamp, updated_at timestamp"
)

RAW_EVENTS = (
    "event_id string, customer_id string, event_type string, payload string, kafka_topic string, "
    "event_timestamp timestamp, ingested_at timestamp"
)

FEATURE_STORE = (
    "customer_id string, snapshot_date date, feature_set string, recency_days int, frequency int, "
    "monetary decimal(15,2), avg_purchase_value decimal(12,2), max_purchase_value decimal(12,2), "
    "min_purchase_value decimal(12,2), product_view_count int, search_count int, cart_add_count int, "
    "purchase_count int, login_count int, cart_abandonment_rate decimal(6,4), "
    "days_since_last_login int, monthly_orders decimal(8,2), avg_session_duration decimal(10,2), "
    "created_at timestamp, updated_at timestamp"
)

CHURN_SCORES = (
    "customer_id string, churn_probability decimal(8,6), churn_segment string, "
    "model_version string, scored_at timestamp"
)

QUALITY_RESULTS = (
    "rule_name string, table_name string, total_records bigint, failed_records bigint, "
    "failure_rate decimal(8,6), passed boolean, severity string, checked_at timestamp"
)

RUN_LOG = (
    "dag_id string, run_id string, task_id string, status string, records_processed bigint, "
    "duration_seconds int, error_message string, started_at timestamp, completed_at timestamp"
)

TICKETS = (
    "ticket_id string, customer_id string, issue_text string, status string, created_at string"
)

MESSAGE = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def shaped(df, ddl: str):
    """``df`` with exactly the columns and types of ``ddl``; columns it lacks are null."""
    from pyspark.sql import functions as F

    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in struct(ddl).fields
    ])


def struct(ddl: str) -> T.StructType:
    """The parsed schema (needs a running session)."""
    return T.StructType.fromDDL(ddl)
