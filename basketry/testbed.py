"""Adapter: the supplied test tables as this engine's canonical tables.

Everything is derived from whole tables; the remainders below pick variants of a value, never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.vocabulary import PAYMENT_METHODS, PLANS

EVENTS_AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_START = "2024-01-01 00:00:00"

# Labels given to the numeric keys of the test tables.
REGIONS = ["Maharashtra", "Karnataka", "Delhi", "Tamil Nadu", "West Bengal"]
DEVICES = ["Mobile", "Desktop", "Tablet", "Unknown"]
DIRTY_DEVICES = [" mobile", "APP", "Desktop ", "tablet", "smart tv"]
CATEGORIES = ["Electronics", "Fashion", "Home", "Beauty", "Sports", "Books", "Toys", "Grocery"]
METHODS = PAYMENT_METHODS
SIGNUP_AS = ["LOGOUT", "SEARCH", "LOGIN"]
ERROR_AS = ["REFUND", "PAYMENT_FAILURE", "SUBSCRIPTION"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(labels: list[str], number: str) -> str:
    """SQL text: the label whose place is ``number`` modulo the number of labels."""
    names = ", ".join(f"'{x}'" for x in labels)
    return f"elt(cast(({number}) % {len(labels)} + 1 AS int), {names})"


def customer_code(number) -> F.Column:
    return F.concat(F.lit("C"), F.lpad(number.cast("string"), 7, "0"))


def events(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Canonical clean events (all nine types); with ``tasks`` dealt evenly to so many tasks.

    A file is read by no more tasks than it has row groups, and a small file can hold many events. What is made of the
    rows, JSON above all, costs far more than the rows themselves.
    """
    return events_from(_dealt(table(spark, sf_dir, "events"), tasks))


def event_stream(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The same events as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    return events_from(_dealt(spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet"), tasks))


def _dealt(source: DataFrame, tasks: int | None) -> DataFrame:
    return source.select("event_id", "user_id", "props", "value", "event_type", "ts").repartition(tasks) if tasks else source


def events_from(source: DataFrame) -> DataFrame:
    keyed = source.selectExpr(
        "event_id AS n", "user_id AS u", "cast(get_json_object(props, '$.k') AS int) AS k", "value",
        "event_type AS raw", "cast(ts AS timestamp) AS event_timestamp",
    )
    typed = keyed.selectExpr(
        "*",
        f"""CASE raw WHEN 'view' THEN 'PRODUCT_VIEW' WHEN 'click' THEN 'ADD_TO_CART' WHEN 'purchase' THEN 'PURCHASE'
            WHEN 'signup' THEN {pick(SIGNUP_AS, 'k')} ELSE {pick(ERROR_AS, 'k')} END AS event_type""",
        "concat('C', lpad(cast(u AS string), 7, '0')) AS customer_id",
        "concat('P', lpad(cast(k AS string), 7, '0')) AS p0",
        "concat('P', lpad(cast((k + 1) % 100 AS string), 7, '0')) AS p1",
    )

    def only(kinds: str, value: str, name: str) -> str:
        return f"CASE WHEN event_type IN ({kinds}) THEN {value} END AS {name}"

    shown, bought = "'PRODUCT_VIEW', 'ADD_TO_CART', 'REFUND'", "'PURCHASE'"
    return typed.selectExpr(
        "concat('E', cast(n AS string)) AS event_id", "customer_id", "event_type", "event_timestamp",
        f"{pick(DEVICES, 'u + k')} AS device",
        f"{pick(REGIONS, 'u')} AS region",
        "'India' AS country",
        "concat(customer_id, '-', date_format(event_timestamp, 'yyyyMMdd')) AS session_id",
        only(shown, "p0", "product_id"),
        only(shown, "concat('Product ', cast(k AS string))", "product_name"),
        only(shown, pick(CATEGORIES, "k"), "category"),
        only("'PRODUCT_VIEW', 'ADD_TO_CART'", "value", "price"),
        only(bought, "array(p0, p1)", "product_ids"),
        only(bought, f"array({pick(CATEGORIES, 'k')}, {pick(CATEGORIES, 'k + 1')})", "categories"),
        only(bought, "value", "total_amount"),
        only(bought, "floor((cast(round(value * 100) AS bigint) + 5) / 10) / 100", "discount_amount"),
        only(bought, "k % 3 + 1", "items_count"),
        only("'PURCHASE', 'REFUND', 'PAYMENT_FAILURE'", "concat('ORD-', cast(n AS string))", "order_id"),
        only("'PURCHASE', 'PAYMENT_FAILURE'", pick(METHODS, "k"), "payment_method"),
        only("'REFUND'", "value", "refund_amount"),
        only("'SUBSCRIPTION'", "value", "amount"),
        only("'SUBSCRIPTION'", pick(PLANS, "k"), "plan"),
        only("'PAYMENT_FAILURE'", "value", "attempted_amount"),
        only("'PAYMENT_FAILURE'", "'card_declined'", "failure_reason"),
    )


def untidy_events(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The same events as they might arrive: padded, mis-cased, signed, partly broken, every seventh sent twice."""
    return untidy_from(events(spark, sf_dir, tasks))


def untidy_from(tidy: DataFrame) -> DataFrame:
    signed = "CASE WHEN n % 11 = 0 THEN -1.0D ELSE 1.0D END"
    return tidy.selectExpr(
        "*", "cast(substring(event_id, 2, 20) AS bigint) AS n"
    ).selectExpr(
        "*", "explode(sequence(1, CASE WHEN n % 7 = 0 THEN 2 ELSE 1 END)) AS copy_no"
    ).selectExpr(
        "event_id",
        "CASE WHEN n % 101 <> 0 THEN concat(' ', lower(customer_id)) END AS customer_id",
        "CASE WHEN n % 103 = 0 THEN 'wishlist' ELSE concat(lower(event_type), ' ') END AS event_type",
        "session_id",
        f"{pick(DIRTY_DEVICES, 'n')} AS device",
        "upper(region) AS region",
        "country",
        """CASE WHEN n % 97 = 0 THEN 'not a time'
            WHEN n % 3 = 0 THEN date_format(event_timestamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")
            WHEN n % 3 = 1 THEN date_format(event_timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSS")
            ELSE date_format(event_timestamp, "yyyy-MM-dd'T'HH:mm:ss") END AS timestamp""",
        "product_id", "product_name", "category",
        f"price * {signed} AS price",
        "product_ids", "categories",
        f"total_amount * {signed} AS total_amount",
        "discount_amount", "items_count",
        "CASE WHEN n % 13 <> 0 THEN order_id END AS order_id",
        "payment_method", "refund_amount", "amount", "plan", "attempted_amount", "failure_reason", "copy_no",
        "event_timestamp AS sent_at",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table: envelope columns plus the whole event as JSON."""
    from basketry.plans.warehouse import raw_events_landing

    return raw_events_landing(events(spark, sf_dir))


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Discounts add up in ten-thousandths as integers, which is exact and cheaper than decimals per line.
    lines = (
        table(spark, sf_dir, "lineitem")
        .selectExpr(
            "l_orderkey AS o_orderkey",
            "cast(round(l_extendedprice * 100) AS bigint) * cast(round(l_discount * 100) AS bigint) AS off",
        )
        .groupBy("o_orderkey")
        .agg(F.sum("off").alias("off"), F.count("*").cast("int").alias("items"))
    )
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("n_nationkey AS c_nationkey", "r_name")
    )
    buyers = (
        table(spark, sf_dir, "customer")
        .join(places, "c_nationkey", "left")
        .selectExpr("c_custkey AS o_custkey", "r_name", "c_mktsegment")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(lines, "o_orderkey", "left")
        .join(buyers, "o_custkey", "left")
        .selectExpr(
            "cast(o_orderkey AS string) AS order_id",
            "concat('C', lpad(cast(o_custkey AS string), 7, '0')) AS customer_id",
            "cast(o_orderdate AS timestamp) AS event_timestamp",
            "cast(o_totalprice AS decimal(15,2)) AS total_amount",
            "cast(coalesce(floor((off + 50) / 100), 0) / 100BD AS decimal(12,2)) AS discount_amount",
            "cast(0 AS decimal(12,2)) AS tax_amount",
            "o_orderpriority AS payment_method",
            "coalesce(items, 0) AS items_count",
            "r_name AS region",
            "c_mktsegment AS device",
        )
        .selectExpr(
            "*", "to_date(event_timestamp) AS event_date",
            "cast(total_amount - discount_amount AS decimal(15,2)) AS net_amount",
        )
    )


def messages_from(untidy: DataFrame) -> DataFrame:
    """Untidy events as broker messages, one source partition, stamped with the time they were sent."""
    body = [c for c in untidy.columns if c not in ("copy_no", "sent_at")]
    return untidy.select(
        F.col("customer_id").cast("binary").alias("key"),
        F.to_json(F.struct(*body)).cast("binary").alias("value"),
        F.lit("product-events").alias("topic"),
        F.lit(0).alias("partition"),
        F.substring("event_id", 2, 20).cast("long").alias("offset"),
        F.col("sent_at").alias("timestamp"),
    )


def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score and an outcome per customer by key arithmetic, in the shape of the score table."""
    from basketry.plans.churn import churn_band

    key = F.col("c_custkey")
    score = (key * 7919 % 1000 / 1000).cast("decimal(8,6)")
    return table(spark, sf_dir, "customer").select(
        customer_code(key).alias("customer_id"),
        score.alias("churn_probability"),
        churn_band(score).alias("churn_segment"),
        F.lit("v1.0").alias("model_version"),
        F.lit(ORDERS_AS_OF).cast("timestamp").alias("scored_at"),
        (key * 104729 % 1000 < score * 1000).cast("int").alias("label"),
    )


def combined_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from basketry.plans import features, warehouse

    source = events(spark, sf_dir)
    return features.combined_features(
        features.rfm_features(fact_orders(spark, sf_dir), ORDERS_AS_OF),
        features.behavioral_features(source, EVENTS_AS_OF),
        features.session_features(warehouse.gap_sessions(source)),
        EVENTS_AS_OF,
    )


def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined features of two snapshots a week apart."""
    now = combined_features(spark, sf_dir)
    earlier = now.withColumns(
        {
            "snapshot_date": F.date_sub("snapshot_date", 7),
            "recency_days": F.col("recency_days") + 7,
            "product_view_count": F.floor(F.col("product_view_count") / 2),
        }
    )
    return now.unionByName(earlier)
