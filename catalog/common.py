"""Shared parts of the registered queries and of their independent SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.testbed import EVENTS_AS_OF, EVENTS_START, ORDERS_AS_OF

Query = Callable[[SparkSession, str], DataFrame]

EV_DAY, EV_NOW, EV_START = EVENTS_AS_OF[:10], EVENTS_AS_OF, EVENTS_START
ORD_DAY, ORD_NOW = ORDERS_AS_OF[:10], ORDERS_AS_OF


def portable(df: DataFrame) -> DataFrame:
    """Output types both engines print alike: bigint, double, boolean, string."""

    def plain(field: T.StructField) -> F.Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


class Catalog:
    """Named queries with their SQL counterparts."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = lambda spark, sf_dir: portable(query(spark, sf_dir))
            if sql is not None:
                self.oracles[name] = sql
            return query

        return register


# --- SQL fragments -------------------------------------------------------------------------------------------


def day_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def time_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def exact_ratio(part: str, whole: str, digits: int, scale: int = 1, in_cents: bool = False) -> str:
    """Half-up rounded quotient of two integers, in integer arithmetic."""
    ten = 10**digits
    return (
        f"(sign({part}) * ((abs({part})::HUGEINT * {2 * scale * ten} + ({whole})) // "
        f"(2 * nullif({whole}, 0)))::DOUBLE / {ten * (100 if in_cents else 1)}.0)"
    )


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS BIGINT)"


def pick_sql(labels: list[str], number: str) -> str:
    names = ", ".join(f"'{x}'" for x in labels)
    return f"([{names}])[(({number}) % {len(labels)}) + 1]"


from basketry import testbed as tb  # noqa: E402

EVENTS_CTE = f"""
ev0 AS (
  SELECT event_id AS n, user_id AS u, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value, ts,
         event_type AS raw
  FROM events),
ev1 AS (
  SELECT *, CASE raw WHEN 'view' THEN 'PRODUCT_VIEW' WHEN 'click' THEN 'ADD_TO_CART'
                     WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN {pick_sql(tb.SIGNUP_AS, 'k')}
                     ELSE {pick_sql(tb.ERROR_AS, 'k')} END AS event_type,
         'C' || lpad(u::VARCHAR, 7, '0') AS customer_id,
         'P' || lpad(k::VARCHAR, 7, '0') AS p0, 'P' || lpad(((k + 1) % 100)::VARCHAR, 7, '0') AS p1
  FROM ev0),
ev AS (
  SELECT 'E' || n AS event_id, customer_id, event_type, ts AS event_timestamp,
         {pick_sql(tb.DEVICES, 'u + k')} AS device, {pick_sql(tb.REGIONS, 'u')} AS region, 'India' AS country,
         customer_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
         CASE WHEN event_type IN ('PRODUCT_VIEW','ADD_TO_CART','REFUND') THEN p0 END AS product_id,
         CASE WHEN event_type IN ('PRODUCT_VIEW','ADD_TO_CART','REFUND') THEN 'Product ' || k END AS product_name,
         CASE WHEN event_type IN ('PRODUCT_VIEW','ADD_TO_CART','REFUND')
              THEN {pick_sql(tb.CATEGORIES, 'k')} END AS category,
         CASE WHEN event_type IN ('PRODUCT_VIEW','ADD_TO_CART') THEN value END AS price,
         CASE WHEN event_type = 'PURCHASE' THEN [p0, p1] END AS product_ids,
         CASE WHEN event_type = 'PURCHASE'
              THEN [{pick_sql(tb.CATEGORIES, 'k')}, {pick_sql(tb.CATEGORIES, 'k + 1')}] END AS categories,
         CASE WHEN event_type = 'PURCHASE' THEN value END AS total_amount,
         CASE WHEN event_type = 'PURCHASE'
              THEN ((CAST(round(value * 100) AS BIGINT) + 5) // 10)::DOUBLE / 100.0 END AS discount_amount,
         CASE WHEN event_type = 'PURCHASE' THEN k % 3 + 1 END AS items_count,
         CASE WHEN event_type IN ('PURCHASE','REFUND','PAYMENT_FAILURE') THEN 'ORD-' || n END AS order_id,
         CASE WHEN event_type IN ('PURCHASE','PAYMENT_FAILURE') THEN {pick_sql(tb.METHODS, 'k')} END
           AS payment_method,
         CASE WHEN event_type = 'REFUND' THEN value END AS refund_amount,
         CASE WHEN event_type = 'SUBSCRIPTION' THEN value END AS amount,
         CASE WHEN event_type = 'SUBSCRIPTION' THEN {pick_sql(tb.PLANS, 'k')} END AS plan,
         CASE WHEN event_type = 'PAYMENT_FAILURE' THEN value END AS attempted_amount,
         CASE WHEN event_type = 'PAYMENT_FAILURE' THEN 'card_declined' END AS failure_reason,
         n, u, k
  FROM ev1)"""

UNTIDY_CTE = f"""{EVENTS_CTE},
untidy AS (
  SELECT event_id, n,
         CASE WHEN n % 101 = 0 THEN NULL ELSE ' ' || lower(customer_id) END AS customer_id,
         CASE WHEN n % 103 = 0 THEN 'wishlist' ELSE lower(event_type) || ' ' END AS event_type,
         session_id, {pick_sql(tb.DIRTY_DEVICES, 'n')} AS device, upper(region) AS region, country,
         n % 97 <> 0 AS has_time,
         CASE WHEN n % 97 = 0 THEN NULL WHEN n % 3 = 1 THEN date_trunc('millisecond', event_timestamp)
              ELSE date_trunc('second', event_timestamp) END AS parsed,
         product_id, product_name, category,
         price * CASE WHEN n % 11 = 0 THEN -1 ELSE 1 END AS price, product_ids, categories,
         total_amount * CASE WHEN n % 11 = 0 THEN -1 ELSE 1 END AS total_amount, discount_amount, items_count,
         CASE WHEN n % 13 = 0 THEN NULL ELSE order_id END AS order_id, payment_method, refund_amount, amount, plan,
         attempted_amount, failure_reason, copy_no
  FROM ev, LATERAL (SELECT unnest(CASE WHEN n % 7 = 0 THEN [1, 2] ELSE [1] END) AS copy_no))"""

ORDERS_CTE = """
li AS (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount,
         count(*) AS items
  FROM lineitem GROUP BY 1),
fo AS (
  SELECT o_orderkey::VARCHAR AS order_id, 'C' || lpad(o_custkey::VARCHAR, 7, '0') AS customer_id,
         o_orderdate AS event_timestamp, CAST(o_orderdate AS DATE) AS order_date,
         CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount,
         CAST(round(coalesce(discount, 0), 2) AS DECIMAL(12,2)) AS discount_amount,
         o_orderpriority AS payment_method, coalesce(items, 0) AS items_count, r_name AS region,
         c_mktsegment AS device
  FROM orders
  LEFT JOIN li ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey),
so AS (
  SELECT *, year(order_date) AS order_year, month(order_date) AS order_month,
         CAST(date_trunc('month', order_date) AS DATE) AS month_start,
         total_amount - discount_amount AS net_amount,
         array_to_string(list_transform(string_split(trim(region), ' '),
                         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS reg,
         array_to_string(list_transform(string_split(trim(device), ' '),
                         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS dev
  FROM fo WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount > 0)"""
