"""Event contract: required fields per type and enumerated domains, as one list of reasons per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.vocabulary import CONTRACT_DEVICES, EVENT_TYPES, PAYMENT_METHODS, PLANS

# Fields every event needs, and those a type adds.
BASE_FIELDS = [
    "event_id", "customer_id", "event_type", "session_id", "device", "region", "country", "city", "ip_address",
    "user_agent", "timestamp", "kafka_topic",
]
TYPE_FIELDS = {
    "LOGIN": ["login_method", "success"],
    "LOGOUT": ["session_duration_seconds"],
    "PRODUCT_VIEW": ["product_id", "product_name", "category", "subcategory", "price", "view_duration_seconds"],
    "SEARCH": ["search_query", "results_count"],
    "ADD_TO_CART": ["product_id", "product_name", "category", "price", "quantity", "cart_total"],
    "PURCHASE": [
        "order_id", "product_ids", "total_amount", "discount_amount", "tax_amount", "payment_method", "items_count",
    ],
    "REFUND": ["order_id", "product_id", "refund_amount", "reason", "initiated_by"],
    "SUBSCRIPTION": ["plan", "action", "amount", "billing_cycle"],
    "PAYMENT_FAILURE": ["order_id", "attempted_amount", "payment_method", "failure_reason", "retry_count"],
}
DOMAINS = {
    "event_type": EVENT_TYPES,
    "device": CONTRACT_DEVICES,
    "payment_method": PAYMENT_METHODS,
    "plan": PLANS,
}


def violation_reasons(columns: list[str], defaulted: tuple[str, ...] = ("event_id", "kafka_topic")) -> Column:
    """Array of reasons, empty for a valid event. ``defaulted`` fields are filled by the producer when absent."""

    def missing(name: str) -> Column:
        return F.col(name).isNull() if name in columns else F.lit(True)

    reasons = [
        F.when(missing(f), F.lit(f"missing {f}")) for f in BASE_FIELDS if f not in defaulted
    ]
    kind = F.col("event_type")
    for event_type, fields in TYPE_FIELDS.items():
        own = [f for f in fields if not (event_type == "PURCHASE" and f == "order_id")]
        reasons += [F.when((kind == event_type) & missing(f), F.lit(f"missing {f}")) for f in own]
    # A domain binds where the field belongs to the event: plan and payment method only to types that carry them.
    carriers = {name: [t for t, fields in TYPE_FIELDS.items() if name in fields] for name in DOMAINS}
    for name, allowed in DOMAINS.items():
        if name in columns:
            applies = kind.isin(carriers[name]) if carriers[name] else F.lit(True)
            reasons.append(F.when(applies & ~F.col(name).isin(allowed), F.lit(f"unknown {name}")))
    return F.array_compact(F.array(*reasons))


def validate_event_contract(events: DataFrame) -> DataFrame:
    """Events with ``contract_reasons`` and ``contract_valid``."""
    return events.withColumn("contract_reasons", violation_reasons(events.columns)).withColumn(
        "contract_valid", F.size("contract_reasons") == 0
    )
