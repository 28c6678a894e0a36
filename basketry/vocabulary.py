"""Names, word lists and thresholds shared by every operator."""

# Event types and the topic each one travels on.
TOPIC_OF_EVENT = {
    "LOGIN": "customer-login",
    "LOGOUT": "customer-login",
    "PRODUCT_VIEW": "product-events",
    "SEARCH": "product-events",
    "ADD_TO_CART": "cart-events",
    "PURCHASE": "purchase-events",
    "REFUND": "refund-events",
    "SUBSCRIPTION": "payment-events",
    "PAYMENT_FAILURE": "payment-events",
}
DEFAULT_TOPIC = "product-events"
EVENT_TYPES = list(TOPIC_OF_EVENT)

# Enumerated domains of the event contract.
CONTRACT_DEVICES = ["Mobile", "Desktop", "Tablet", "App"]
PAYMENT_METHODS = ["credit_card", "debit_card", "upi", "net_banking", "wallet", "cod"]
PLANS = ["free", "basic", "pro", "enterprise"]

# Devices the silver suite accepts.
SILVER_DEVICES = ["Mobile", "Desktop", "Tablet"]

# Payment method lookup (name, category, digital).
PAYMENT_CATEGORIES = [
    ("credit_card", "card", True),
    ("debit_card", "card", True),
    ("upi", "upi", True),
    ("net_banking", "banking", True),
    ("wallet", "wallet", True),
    ("cod", "cash", False),
]

# Region lookup (name, country, tier).
REGION_TIERS = [
    ("Maharashtra", "India", "metro"),
    ("Karnataka", "India", "metro"),
    ("Delhi", "India", "metro"),
    ("Tamil Nadu", "India", "metro"),
    ("West Bengal", "India", "tier1"),
    ("Telangana", "India", "metro"),
    ("Gujarat", "India", "tier1"),
    ("Rajasthan", "India", "tier1"),
    ("Uttar Pradesh", "India", "tier1"),
    ("Kerala", "India", "tier1"),
    ("Punjab", "India", "tier2"),
    ("Madhya Pradesh", "India", "tier2"),
    ("Andhra Pradesh", "India", "tier2"),
    ("Haryana", "India", "tier2"),
    ("Bihar", "India", "tier2"),
]

# Thresholds. Bands are (inclusive upper edge, label); tiers are (lower edge, label).
CHURN_AFTER_DAYS = 90
ACTIVITY_BANDS = [(30, "active"), (90, "at_risk"), (180, "lapsed")]
ACTIVITY_LAST = "churned"
VALUE_TIERS = [(500000, "platinum"), (100000, "gold"), (25000, "silver")]
VALUE_LOWEST = "bronze"
CHURN_BANDS = [(0.3, "low_risk"), (0.6, "medium_risk")]
CHURN_LAST = "high_risk"
RFM_BANDS = [(6, "Bronze"), (9, "Silver"), (12, "Gold")]
RFM_LAST = "Platinum"
NEVER_DAYS = 9999

# Model inputs. The first list is the full set, the second the weekly retraining set, the third the set
# that exploration looks at.
FEATURE_COLUMNS = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_purchase_value",
    "max_purchase_value",
    "min_purchase_value",
    "cart_abandonment_rate",
    "product_view_count",
    "search_count",
    "cart_add_count",
    "purchase_count",
    "login_count",
    "monthly_orders",
    "days_since_last_login",
    "avg_session_duration",
]
WEEKLY_FEATURES = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_purchase_value",
    "cart_abandonment_rate",
    "product_view_count",
    "search_count",
]
EDA_FEATURES = [
    "recency_days",
    "frequency",
    "monetary",
    "avg_purchase_value",
    "cart_abandonment_rate",
    "product_view_count",
    "login_count",
    "monthly_orders",
    "days_since_last_login",
]
