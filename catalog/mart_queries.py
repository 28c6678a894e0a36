"""Staging, intermediate, mart and gold queries."""

from __future__ import annotations

from basketry import testbed as tb
from basketry.plans import gold, marts, staging, warehouse
from catalog.common import (
    EV_DAY, EV_NOW, EV_START, EVENTS_CTE, ORD_DAY, ORD_NOW, ORDERS_CTE, Catalog, cents, day_text, exact_ratio,
    time_text,
)

CATALOG = Catalog()
add = CATALOG.add


def orders(spark, sf_dir):
    return staging.stg_orders(tb.fact_orders(spark, sf_dir))


@add("stg_orders", f"""WITH {ORDERS_CTE}
SELECT order_id, customer_id, {time_text('event_timestamp')} AS order_timestamp,
       {day_text('order_date')} AS order_date, order_year::BIGINT AS order_year, order_month::BIGINT AS order_month,
       total_amount::DOUBLE AS total_amount, discount_amount::DOUBLE AS discount_amount, 0::DOUBLE AS tax_amount,
       net_amount::DOUBLE AS net_amount, payment_method, items_count::BIGINT AS items_count, reg AS region,
       dev AS device FROM so""")
def _(spark, sf_dir):
    return orders(spark, sf_dir)


@add("stg_events", f"""WITH {EVENTS_CTE}
SELECT event_id, customer_id, event_type, session_id,
       CASE WHEN event_type IN ('LOGIN','LOGOUT') THEN 'customer-login'
            WHEN event_type IN ('PRODUCT_VIEW','SEARCH') THEN 'product-events'
            WHEN event_type = 'ADD_TO_CART' THEN 'cart-events' WHEN event_type = 'PURCHASE' THEN 'purchase-events'
            WHEN event_type = 'REFUND' THEN 'refund-events' ELSE 'payment-events' END AS kafka_topic,
       device, region, {time_text('event_timestamp')} AS event_timestamp, {day_text('event_timestamp')} AS event_date,
       year(event_timestamp)::BIGINT AS event_year, month(event_timestamp)::BIGINT AS event_month,
       hour(event_timestamp)::BIGINT AS event_hour, extract(dow FROM event_timestamp)::BIGINT AS day_of_week,
       {time_text('event_timestamp')} AS ingested_at
FROM ev WHERE event_timestamp BETWEEN TIMESTAMP '{EV_START}' AND TIMESTAMP '{EV_NOW}'""")
def _(spark, sf_dir):
    return staging.stg_events(tb.raw_events(spark, sf_dir), EV_NOW, EV_START)


DIM_CTE = f"""
c360 AS (
  SELECT customer_id, count(event_id) AS total_events, count(*) FILTER (event_type = 'PURCHASE') AS total_purchases,
         coalesce(sum(CAST(total_amount AS DECIMAL(15,2))), 0) AS total_spend,
         count(total_amount) AS paid, max(event_timestamp) AS last_event_date,
         min(event_timestamp) AS first_event_date, min_by(region, n) AS region
  FROM ev GROUP BY 1),
modes AS (
  SELECT customer_id, device AS preferred_device FROM (
    SELECT customer_id, device,
           row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, device) AS r
    FROM ev GROUP BY 1, 2) WHERE r = 1),
dc AS (
  SELECT *, (epoch_us(last_event_date) - epoch_us(first_event_date)) // 86400000000 AS days_active,
         {cents('total_spend')} AS spend_cents,
         CASE WHEN last_event_date >= TIMESTAMP '{EV_NOW}' - INTERVAL 30 DAY THEN 'active'
              WHEN last_event_date >= TIMESTAMP '{EV_NOW}' - INTERVAL 90 DAY THEN 'at_risk'
              WHEN last_event_date >= TIMESTAMP '{EV_NOW}' - INTERVAL 180 DAY THEN 'lapsed'
              ELSE 'churned' END AS activity_status
  FROM c360 JOIN modes USING (customer_id))"""


def dim_customer(spark, sf_dir):
    return warehouse.dim_customer(gold.customer_360(tb.events(spark, sf_dir)), EV_NOW)


@add("stg_customers", f"""WITH {EVENTS_CTE}, {DIM_CTE}
SELECT customer_id, region, 'India' AS country, preferred_device, NULL::VARCHAR AS customer_segment, total_events,
       total_purchases, total_spend::DOUBLE AS total_spend,
       coalesce({exact_ratio('spend_cents', 'paid', 0)} / 100.0, 0) AS avg_spend, days_active::BIGINT AS days_active,
       {time_text('first_event_date')} AS first_seen_date, {time_text('last_event_date')} AS last_seen_date,
       activity_status, {time_text(f"TIMESTAMP '{EV_NOW}'")} AS updated_at
FROM dc""")
def _(spark, sf_dir):
    return staging.stg_customers(dim_customer(spark, sf_dir), EV_NOW)


@add("customer_360", f"""WITH {EVENTS_CTE}, {DIM_CTE}
SELECT customer_id, total_events, total_purchases, total_spend::DOUBLE AS total_spend,
       {exact_ratio('spend_cents', 'paid', 4, in_cents=True)} AS avg_spend,
       {time_text('last_event_date')} AS last_event_date, {time_text('first_event_date')} AS first_event_date,
       preferred_device, region, days_active::BIGINT AS days_active FROM dc""")
def _(spark, sf_dir):
    return gold.customer_360(tb.events(spark, sf_dir))


@add("dim_customer", f"""WITH {EVENTS_CTE}, {DIM_CTE}
SELECT customer_id, region, 'India' AS country, NULL::VARCHAR AS city, preferred_device,
       NULL::VARCHAR AS customer_segment, total_events, total_purchases, total_spend::DOUBLE AS total_spend,
       coalesce({exact_ratio('spend_cents', 'paid', 0)} / 100.0, 0) AS avg_spend, days_active::BIGINT AS days_active,
       {time_text('first_event_date')} AS first_seen_date, {time_text('last_event_date')} AS last_seen_date,
       {time_text(f"TIMESTAMP '{EV_NOW}'")} AS created_at, {time_text(f"TIMESTAMP '{EV_NOW}'")} AS updated_at
FROM dc""")
def _(spark, sf_dir):
    return dim_customer(spark, sf_dir)


@add("int_customer_events", f"""WITH {EVENTS_CTE}, c AS (
  SELECT customer_id, count(*) AS total_events, count(DISTINCT event_timestamp::DATE) AS active_days,
         min(event_timestamp::DATE) AS f, max(event_timestamp::DATE) AS l,
         count(*) FILTER (event_type = 'LOGIN') AS login_count,
         count(*) FILTER (event_type = 'PRODUCT_VIEW') AS product_view_count,
         count(*) FILTER (event_type = 'SEARCH') AS search_count,
         count(*) FILTER (event_type = 'ADD_TO_CART') AS cart_add_count,
         count(*) FILTER (event_type = 'PURCHASE') AS purchase_count,
         count(*) FILTER (event_type = 'REFUND') AS refund_count,
         count(*) FILTER (event_type = 'PAYMENT_FAILURE') AS payment_fail_count,
         count(*) FILTER (event_type = 'WISHLIST_ADD') AS wishlist_count,
         count(*) FILTER (event_type = 'REVIEW_SUBMIT') AS review_count,
         count(*) FILTER (event_timestamp::DATE >= DATE '{EV_DAY}' - 30) AS events_last_30d,
         count(*) FILTER (event_type = 'LOGIN' AND event_timestamp::DATE >= DATE '{EV_DAY}' - 30) AS logins_last_30d,
         count(*) FILTER (event_type = 'PURCHASE' AND event_timestamp::DATE >= DATE '{EV_DAY}' - 30)
           AS purchases_last_30d
  FROM ev GROUP BY 1)
SELECT * EXCLUDE (f, l), {day_text('f')} AS first_event_date, {day_text('l')} AS last_event_date,
       (DATE '{EV_DAY}' - l)::BIGINT AS days_since_last_event,
       {exact_ratio('(cart_add_count - purchase_count)', 'cart_add_count', 4)} AS cart_abandonment_rate,
       coalesce({exact_ratio('purchase_count', 'product_view_count', 4)}, 0) AS browse_to_buy_ratio,
       {exact_ratio('(login_count + 2 * product_view_count + search_count + 5 * cart_add_count'
                    ' + 10 * purchase_count + 8 * review_count)', 'active_days', 2)} AS daily_engagement_score
FROM c""")
def _(spark, sf_dir):
    return marts.int_customer_events(tb.raw_events(spark, sf_dir), EV_NOW)


def _mode_sql(column: str) -> str:
    return f"""(SELECT customer_id, region, {column} AS m FROM (
      SELECT customer_id, region, {column}, row_number() OVER (
        PARTITION BY customer_id, region ORDER BY count(*) DESC, {column}) AS r
      FROM fo WHERE total_amount > 0 GROUP BY 1, 2, 3) WHERE r = 1)"""


TIER_SQL = "CASE WHEN {0} >= 500000 THEN 'platinum' WHEN {0} >= 100000 THEN 'gold' WHEN {0} >= 25000 " \
           "THEN 'silver' ELSE 'bronze' END"


@add("int_customer_orders", f"""WITH {ORDERS_CTE}, s AS (
  SELECT customer_id, region, count(order_id) AS total_orders, sum(total_amount) AS spend,
         max(total_amount) AS hi, min(total_amount) AS lo, sum(items_count)::BIGINT AS total_items,
         min(order_date) AS f, max(order_date) AS l,
         count(*) FILTER (order_date >= DATE '{ORD_DAY}' - INTERVAL 12 MONTH) AS orders_last_12m,
         sum(total_amount) FILTER (order_date >= DATE '{ORD_DAY}' - INTERVAL 12 MONTH) AS s12,
         count(*) FILTER (order_date >= DATE '{ORD_DAY}' - 30) AS orders_last_30d,
         sum(total_amount) FILTER (order_date >= DATE '{ORD_DAY}' - 30) AS s30,
         sum(discount_amount) AS disc
  FROM fo WHERE total_amount > 0 GROUP BY 1, 2)
SELECT s.customer_id, s.region, total_orders, spend::DOUBLE AS total_spend,
       {exact_ratio(cents('spend'), 'total_orders', 4, in_cents=True)} AS avg_order_value, hi::DOUBLE AS max_order_value,
       lo::DOUBLE AS min_order_value, total_items, total_items::DOUBLE / total_orders AS avg_items_per_order,
       {day_text('f')} AS first_order_date, {day_text('l')} AS last_order_date,
       (DATE '{ORD_DAY}' - l)::BIGINT AS days_since_last_order, (l - f)::BIGINT AS customer_lifespan_days,
       orders_last_12m, s12::DOUBLE AS spend_last_12m, orders_last_30d, s30::DOUBLE AS spend_last_30d,
       {exact_ratio(cents('disc'), 'total_orders', 4, in_cents=True)} AS avg_discount, disc::DOUBLE AS total_discount,
       p.m AS preferred_payment, d.m AS preferred_device,
       {exact_ratio('total_orders', 'greatest((l - f) // 30, 1)', 2)} AS monthly_order_frequency,
       CASE WHEN DATE '{ORD_DAY}' - l <= 30 THEN 'active' WHEN DATE '{ORD_DAY}' - l <= 90 THEN 'at_risk'
            WHEN DATE '{ORD_DAY}' - l <= 180 THEN 'lapsed' ELSE 'churned' END AS recency_segment,
       {TIER_SQL.format('s12')} AS value_tier
FROM s JOIN {_mode_sql('payment_method')} p USING (customer_id, region)
JOIN {_mode_sql('device')} d USING (customer_id, region)""")
def _(spark, sf_dir):
    return marts.int_customer_orders(tb.fact_orders(spark, sf_dir), ORD_NOW)


LTV_CTE = f"""
h AS (
  SELECT customer_id, count(order_id) AS total_orders, sum(total_amount) AS spend, min(order_date) AS f,
         max(order_date) AS l, count(*) FILTER (order_date >= DATE '{ORD_DAY}' - INTERVAL 12 MONTH) AS o12,
         coalesce(sum(total_amount) FILTER (order_date >= DATE '{ORD_DAY}' - INTERVAL 12 MONTH), 0) AS s12
  FROM so GROUP BY 1),
ltv AS (
  SELECT customer_id, total_orders, spend::DOUBLE AS total_spend, {day_text('f')} AS first_order_date,
         {day_text('l')} AS last_order_date, o12 AS orders_last_12m, s12::DOUBLE AS spend_last_12m,
         {exact_ratio(cents('spend'), 'total_orders', 0)} / 100.0 AS avg_order_value,
         (l - f)::BIGINT AS customer_lifespan_days,
         CASE WHEN l > f THEN {exact_ratio(cents('spend'), '(l - f)', 0, 365)} / 100.0
              ELSE {exact_ratio(cents('spend'), 'total_orders', 0)} / 100.0 END AS predicted_ltv_12m,
         {TIER_SQL.format('s12')} AS ltv_segment,
         least(100.0, round(5 * log10(greatest(spend, 1)::DOUBLE) + 2 * total_orders
               + greatest(0, 30 - (DATE '{ORD_DAY}' - l)) * 0.5, 1)) AS ltv_score
  FROM h)"""


def ltv(spark, sf_dir):
    customers = staging.stg_customers(dim_customer(spark, sf_dir), EV_NOW)
    return marts.customer_lifetime_value(orders(spark, sf_dir), customers, ORD_NOW)


@add("customer_lifetime_value", f"""WITH {EVENTS_CTE}, {DIM_CTE}, {ORDERS_CTE}, {LTV_CTE}
SELECT ltv.*, dc.region, dc.preferred_device, dc.activity_status FROM ltv LEFT JOIN dc USING (customer_id)""")
def _(spark, sf_dir):
    return ltv(spark, sf_dir)


@add("customer_ltv_table", f"""WITH {ORDERS_CTE}, {LTV_CTE}
SELECT customer_id, spend_last_12m AS total_spend_12m, orders_last_12m AS total_orders_12m, avg_order_value,
       ltv_segment, ltv_score, predicted_ltv_12m FROM ltv""")
def _(spark, sf_dir):
    return warehouse.customer_ltv_table(ltv(spark, sf_dir))


RETENTION_CTE = """
fp AS (SELECT customer_id, date_trunc('month', min(order_date)) AS cohort FROM so GROUP BY 1),
cd AS (
  SELECT cohort, month_start AS pm, count(DISTINCT so.customer_id) AS kept
  FROM so JOIN fp USING (customer_id) GROUP BY 1, 2),
cr AS (
  SELECT cd.*, sz.kept AS size FROM cd JOIN cd sz ON sz.cohort = cd.cohort AND sz.pm = cd.cohort)"""


@add("customer_retention", f"""WITH {ORDERS_CTE}, {RETENTION_CTE}
SELECT {day_text('cohort')} AS cohort_month, {day_text('pm')} AS purchase_month,
       date_diff('month', cohort, pm)::BIGINT AS period_number, size AS cohort_size, kept AS retained_customers,
       {exact_ratio('kept', 'size', 2, 100)} AS retention_rate_pct, size - kept AS churned_customers,
       {exact_ratio('(size - kept)', 'size', 2, 100)} AS churn_rate_pct FROM cr""")
def _(spark, sf_dir):
    return marts.customer_retention_report(orders(spark, sf_dir))


@add("customer_retention_table", f"""WITH {ORDERS_CTE}, {RETENTION_CTE}
SELECT {day_text('cohort')} AS cohort_month, {day_text('pm')} AS period_month, size AS cohort_size,
       kept AS retained_customers, {exact_ratio('kept', 'size', 4)} AS retention_rate FROM cr""")
def _(spark, sf_dir):
    return warehouse.retention_table(marts.customer_retention(orders(spark, sf_dir)))


MONTHLY_CTE = """
mr AS (
  SELECT order_year, order_month, month_start, reg AS region, dev AS device, payment_method,
         count(order_id) AS total_orders, sum(total_amount) AS gross, sum(discount_amount) AS disc,
         sum(net_amount) AS net, count(DISTINCT customer_id) AS unique_customers,
         sum(items_count)::BIGINT AS total_items_sold
  FROM so GROUP BY ALL)"""

MONTHLY_COLUMNS = f"""order_year, order_month, {day_text('month_start')} AS month_start, region, device, payment_method,
       total_orders, gross::DOUBLE AS gross_revenue, disc::DOUBLE AS total_discounts, net::DOUBLE AS net_revenue,
       unique_customers, total_items_sold, {exact_ratio(cents('gross'), 'total_orders', 0)} / 100.0 AS avg_order_value"""


@add("monthly_revenue", f"WITH {ORDERS_CTE}, {MONTHLY_CTE} SELECT {MONTHLY_COLUMNS} FROM mr")
def _(spark, sf_dir):
    return marts.monthly_revenue(orders(spark, sf_dir))


@add("monthly_revenue_report", f"""WITH {ORDERS_CTE}, {MONTHLY_CTE}, t AS (
  SELECT *, lag(gross) OVER (PARTITION BY region ORDER BY month_start, device, payment_method) AS prev,
         sum(gross) OVER (PARTITION BY region, order_year ORDER BY month_start, device, payment_method
                          ROWS UNBOUNDED PRECEDING) AS ytd FROM mr)
SELECT {MONTHLY_COLUMNS}, prev::DOUBLE AS prev_month_revenue,
       {exact_ratio(f"({cents('gross')} - {cents('prev')})", cents('prev'), 2, 100)} AS revenue_growth_pct,
       ytd::DOUBLE AS ytd_revenue
FROM t ORDER BY month_start DESC, gross DESC""")
def _(spark, sf_dir):
    return marts.monthly_revenue_report(orders(spark, sf_dir))


@add("revenue_growth_and_ytd", f"""WITH {ORDERS_CTE}, {MONTHLY_CTE}, r AS (
  SELECT region, order_year, order_month, month_start, sum(gross) AS gross, sum(total_orders)::BIGINT AS total_orders
  FROM mr GROUP BY ALL), t AS (
  SELECT *, lag(gross) OVER (PARTITION BY region ORDER BY month_start) AS prev,
         sum(gross) OVER (PARTITION BY region, order_year ORDER BY month_start) AS ytd FROM r)
SELECT region, order_year, order_month, {day_text('month_start')} AS month_start, gross::DOUBLE AS gross_revenue,
       total_orders, prev::DOUBLE AS prev_month_revenue,
       {exact_ratio(f"({cents('gross')} - {cents('prev')})", cents('prev'), 2, 100)} AS revenue_growth_pct,
       ytd::DOUBLE AS ytd_revenue FROM t""")
def _(spark, sf_dir):
    return marts.revenue_trend(marts.monthly_revenue(orders(spark, sf_dir)))


@add("product_analytics", f"""WITH {EVENTS_CTE}, r AS (
  SELECT customer_id, event_type, product_name, category,
         unnest(CASE WHEN len(product_ids) > 0 THEN product_ids ELSE [product_id] END) AS product_id FROM ev),
v AS (
  SELECT product_id, product_name, category, event_type, count(*) AS n, count(DISTINCT customer_id) AS c
  FROM r WHERE product_id IS NOT NULL GROUP BY ALL),
f AS (
  SELECT product_id, max(product_name) AS product_name, max(category) AS category,
         coalesce(sum(n) FILTER (event_type = 'PRODUCT_VIEW'), 0)::BIGINT AS views,
         coalesce(sum(n) FILTER (event_type = 'ADD_TO_CART'), 0)::BIGINT AS cart_adds,
         coalesce(sum(n) FILTER (event_type = 'PURCHASE'), 0)::BIGINT AS purchases,
         coalesce(sum(n) FILTER (event_type = 'REFUND'), 0)::BIGINT AS refunds,
         max(c) FILTER (event_type = 'PRODUCT_VIEW') AS unique_viewers
  FROM v GROUP BY 1)
SELECT *, {exact_ratio('cart_adds', 'views', 2, 100)} AS view_to_cart_rate,
       {exact_ratio('purchases', 'cart_adds', 2, 100)} AS cart_to_purchase_rate,
       {exact_ratio('purchases', 'views', 2, 100)} AS overall_conversion_rate,
       {exact_ratio('refunds', 'purchases', 2, 100)} AS refund_rate FROM f""")
def _(spark, sf_dir):
    return marts.product_analytics_report(tb.raw_events(spark, sf_dir))


@add("gold_revenue_by_region", f"""WITH {EVENTS_CTE}
SELECT region, year(event_timestamp) AS event_year, month(event_timestamp) AS event_month,
       sum(CAST(total_amount AS DECIMAL(15,2)))::DOUBLE AS total_revenue, count(event_id) AS order_count,
       {exact_ratio(cents('sum(CAST(total_amount AS DECIMAL(15,2)))'), 'count(total_amount)', 4, in_cents=True)}
         AS avg_order_value, count(DISTINCT customer_id) AS unique_customers
FROM ev WHERE event_type = 'PURCHASE' GROUP BY ALL""")
def _(spark, sf_dir):
    return gold.revenue_by_region(tb.events(spark, sf_dir))


@add("gold_revenue_by_category", f"""WITH {EVENTS_CTE}, x AS (
  SELECT event_id, total_amount, event_timestamp, unnest(categories) AS category FROM ev
  WHERE event_type = 'PURCHASE')
SELECT category, year(event_timestamp) AS event_year, month(event_timestamp) AS event_month,
       sum(CAST(total_amount AS DECIMAL(15,2)))::DOUBLE AS total_revenue, count(event_id) AS order_count
FROM x GROUP BY ALL""")
def _(spark, sf_dir):
    return gold.revenue_by_category(tb.events(spark, sf_dir))


PERF_CTE = f"""
pr AS (
  SELECT event_type, price, total_amount,
         unnest(CASE WHEN len(product_ids) > 0 THEN product_ids ELSE [product_id] END) AS product_id FROM ev),
pv AS (
  SELECT product_id, count(*) AS view_count, {cents('sum(CAST(price AS DECIMAL(15,2)))')} AS pc,
         count(price) AS priced
  FROM pr WHERE event_type = 'PRODUCT_VIEW' AND product_id IS NOT NULL GROUP BY 1),
pk AS (SELECT product_id, count(*) AS cart_count FROM pr WHERE event_type = 'ADD_TO_CART' GROUP BY 1),
pb AS (
  SELECT product_id, count(*) AS purchase_count, sum(CAST(total_amount AS DECIMAL(15,2))) AS revenue
  FROM pr WHERE event_type = 'PURCHASE' GROUP BY 1),
pp AS (
  SELECT product_id, view_count, pc, priced, coalesce(cart_count, 0) AS cart_count,
         coalesce(purchase_count, 0) AS purchase_count, coalesce(revenue, 0)::DOUBLE AS total_revenue
  FROM pv LEFT JOIN pk USING (product_id) LEFT JOIN pb USING (product_id))"""


@add("gold_product_performance", f"""WITH {EVENTS_CTE}, {PERF_CTE}
SELECT product_id, view_count, {exact_ratio('pc', 'priced', 4, in_cents=True)} AS avg_price, cart_count, purchase_count,
       total_revenue, cart_count / view_count AS cart_rate, purchase_count / view_count AS conversion_rate FROM pp""")
def _(spark, sf_dir):
    return gold.product_performance(tb.events(spark, sf_dir))


@add("product_performance_table", f"""WITH {EVENTS_CTE}, {PERF_CTE}, names AS (
  SELECT product_id, max(product_name) AS product_name, max(category) AS category FROM ev
  WHERE product_id IS NOT NULL GROUP BY 1)
SELECT product_id, product_name, category, view_count, cart_count, purchase_count, total_revenue,
       {exact_ratio('pc', 'priced', 0)} / 100.0 AS avg_price, {exact_ratio('cart_count', 'view_count', 4)} AS cart_rate,
       {exact_ratio('purchase_count', 'view_count', 4)} AS conversion_rate
FROM pp LEFT JOIN names USING (product_id)""")
def _(spark, sf_dir):
    events = tb.events(spark, sf_dir)
    return warehouse.product_performance_table(gold.product_performance(events), warehouse.dim_product(events))
