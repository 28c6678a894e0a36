"""Dimensions, facts, keyed writes, snapshots, files and serving queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from basketry import schemas
from basketry import testbed as tb
from basketry.operators import cleaning, keyed
from basketry.plans import gold, serving, staging, warehouse
from basketry.session import shared_path
from basketry.sinks import versions, writers
from basketry.sources import readers
from catalog.common import (
    EV_DAY, EVENTS_CTE, ORD_NOW, ORDERS_CTE, Catalog, cents, day_text, exact_ratio, time_text,
)
from catalog.mart_queries import DIM_CTE, dim_customer

CATALOG = Catalog()
add = CATALOG.add


def fresh_folder(spark) -> str:
    return shared_path(spark)


@add("dim_time", f"""WITH s AS (
  SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events),
d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM s)
SELECT {day_text('d')} AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
       monthname(d) AS month_name, weekofyear(d) AS week, day(d) AS day_of_month,
       extract(dow FROM d)::BIGINT AS day_of_week, dayname(d) AS day_name,
       extract(dow FROM d) IN (0, 6) AS is_weekend, FALSE AS is_holiday FROM d""")
def _(spark, sf_dir):
    span = tb.table(spark, sf_dir, "events").agg(
        F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")
    )
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("full_date"))
    return warehouse.with_day_attributes(days)


@add("enrich_region", f"""WITH {EVENTS_CTE}
SELECT event_id, region, CASE region WHEN 'West Bengal' THEN 'tier1' ELSE 'metro' END AS region_tier FROM ev""")
def _(spark, sf_dir):
    lookup = warehouse.region_lookup(spark).drop("country")
    return warehouse.enrich_with_reference(tb.events(spark, sf_dir), lookup, "region").select(
        "event_id", "region", "region_tier"
    )


@add("enrich_payment", f"""WITH {EVENTS_CTE}
SELECT event_id, payment_method,
       CASE payment_method WHEN 'credit_card' THEN 'card' WHEN 'debit_card' THEN 'card' WHEN 'upi' THEN 'upi'
            WHEN 'net_banking' THEN 'banking' WHEN 'wallet' THEN 'wallet' WHEN 'cod' THEN 'cash' END
         AS method_category,
       CASE WHEN payment_method IS NOT NULL THEN payment_method <> 'cod' END AS is_digital FROM ev""")
def _(spark, sf_dir):
    lookup = warehouse.payment_lookup(spark)
    return warehouse.enrich_with_reference(tb.events(spark, sf_dir), lookup, "payment_method").select(
        "event_id", "payment_method", "method_category", "is_digital"
    )


@add("dim_product", f"""WITH {EVENTS_CTE}
SELECT product_id, max_by(product_name, n) AS product_name, max_by(category, n) AS category,
       CAST(max_by(price, event_timestamp) FILTER (price IS NOT NULL) AS DECIMAL(12,2))::DOUBLE AS base_price,
       {time_text('max(event_timestamp)')} AS updated_at
FROM ev WHERE product_id IS NOT NULL GROUP BY 1""")
def _(spark, sf_dir):
    return warehouse.dim_product(tb.events(spark, sf_dir))


FACT_SQL = f"""
SELECT order_id, customer_id, {time_text('event_timestamp')} AS event_timestamp,
       {day_text('event_timestamp')} AS event_date, total_amount, discount_amount, payment_method,
       items_count::BIGINT AS items_count, region, device,
       ({cents('CAST(total_amount AS DECIMAL(15,2))')} - {cents('CAST(discount_amount AS DECIMAL(12,2))')})::DOUBLE
         / 100.0 AS net_amount
FROM ev WHERE event_type = 'PURCHASE'"""


@add("fact_orders", f"WITH {EVENTS_CTE} {FACT_SQL}")
def _(spark, sf_dir):
    return warehouse.fact_orders(tb.events(spark, sf_dir)).drop("tax_amount", "delivery_type", "created_at")


@add("fact_transactions", f"""WITH {EVENTS_CTE}
SELECT event_id AS transaction_id, order_id, customer_id, lower(event_type) AS transaction_type,
       CASE event_type WHEN 'PURCHASE' THEN total_amount WHEN 'REFUND' THEN refund_amount
            WHEN 'SUBSCRIPTION' THEN amount ELSE attempted_amount END AS amount,
       payment_method, CASE WHEN event_type = 'PAYMENT_FAILURE' THEN 'failed' ELSE 'success' END AS status,
       failure_reason, {time_text('event_timestamp')} AS event_timestamp, {day_text('event_timestamp')} AS event_date,
       region
FROM ev WHERE event_type IN ('PURCHASE','REFUND','SUBSCRIPTION','PAYMENT_FAILURE')""")
def _(spark, sf_dir):
    return warehouse.fact_transactions(tb.events(spark, sf_dir))


def _sessions_sql(source: str, key: str) -> str:
    return f"""
SELECT {key} AS session_id, min(customer_id) AS customer_id, {time_text('min(event_timestamp)')} AS session_start,
       {time_text('max(event_timestamp)')} AS session_end, count(*) AS event_count,
       count(*) FILTER (event_type IN ('PRODUCT_VIEW','SEARCH')) AS page_views,
       count(*) FILTER (event_type = 'PRODUCT_VIEW') AS product_views,
       count(*) FILTER (event_type = 'ADD_TO_CART') AS cart_adds,
       count(*) FILTER (event_type = 'PURCHASE') AS purchases,
       min_by(device, event_timestamp) AS device, min_by(region, event_timestamp) AS region,
       (epoch(date_trunc('second', max(event_timestamp))) - epoch(date_trunc('second', min(event_timestamp))))::BIGINT
         AS session_duration_s,
       count(*) FILTER (event_type = 'PURCHASE') > 0 AS converted
FROM {source} GROUP BY {key}"""


@add("fact_sessions", f"WITH {EVENTS_CTE} {_sessions_sql('ev', 'session_id')}")
def _(spark, sf_dir):
    return warehouse.fact_sessions(tb.events(spark, sf_dir))


GAP_CTE = """
gaps AS (
  SELECT *, CASE WHEN epoch_us(event_timestamp) - epoch_us(lag(event_timestamp) OVER w) <= 1800000000 THEN 0
                 ELSE 1 END AS opens FROM ev WINDOW w AS (PARTITION BY customer_id ORDER BY event_timestamp)),
gapped AS (
  SELECT * EXCLUDE (session_id), customer_id || '-' || sum(opens) OVER (
           PARTITION BY customer_id ORDER BY event_timestamp ROWS UNBOUNDED PRECEDING) AS sid FROM gaps)"""


@add("gap_sessions", f"WITH {EVENTS_CTE}, {GAP_CTE} {_sessions_sql('gapped', 'sid')}")
def _(spark, sf_dir):
    return warehouse.gap_sessions(tb.events(spark, sf_dir)).drop("session_no")


@add("raw_events", f"""WITH {EVENTS_CTE}
SELECT event_id, customer_id, event_type, region AS payload_region, product_id AS payload_product,
       {time_text('event_timestamp')} AS event_timestamp FROM ev""")
def _(spark, sf_dir):
    return tb.raw_events(spark, sf_dir).select(
        "event_id", "customer_id", "event_type", F.get_json_object("payload", "$.region").alias("payload_region"),
        F.get_json_object("payload", "$.product_id").alias("payload_product"), "event_timestamp",
    )


# --- keyed writes: history up to a date is the target, later data the update ----------------------------------

TURN = "2000-01-01"
LATE = "1999-07-01"


def order_totals(orders):
    return orders.groupBy("customer_id").agg(
        F.max_by("region", "order_id").alias("region"),
        F.count("*").alias("total_orders"),
        F.sum("total_amount").cast("decimal(15,2)").alias("total_spend"),
        F.max("event_timestamp").alias("last_seen_date"),
    )


def _totals_sql(where: str) -> str:
    return f"""SELECT customer_id, max_by(region, order_id) AS region, count(*) AS total_orders,
         sum(total_amount)::DOUBLE AS total_spend, {time_text('max(event_timestamp)')} AS last_seen_date
  FROM fo WHERE {where} GROUP BY 1"""


def split(spark, sf_dir):
    orders = tb.fact_orders(spark, sf_dir)
    return orders.filter(F.col("event_timestamp") < TURN), orders.filter(F.col("event_timestamp") >= TURN)


@add("upsert_customers", f"""WITH {ORDERS_CTE}, t AS ({_totals_sql(f"event_timestamp < TIMESTAMP '{TURN}'")}),
u AS ({_totals_sql(f"event_timestamp >= TIMESTAMP '{TURN}'")})
SELECT coalesce(t.customer_id, u.customer_id) AS customer_id, coalesce(t.region, u.region) AS region,
       coalesce(u.total_orders, t.total_orders) AS total_orders,
       coalesce(u.total_spend, t.total_spend) AS total_spend,
       coalesce(t.last_seen_date, u.last_seen_date) AS last_seen_date
FROM t FULL JOIN u ON t.customer_id = u.customer_id""")
def _(spark, sf_dir):
    old, new = split(spark, sf_dir)
    return keyed.upsert(order_totals(old), order_totals(new), ["customer_id"], ["total_orders", "total_spend"])


def _region_month_sql(where: str) -> str:
    return f"""SELECT region, year(event_timestamp) AS year, month(event_timestamp) AS month,
         sum(total_amount)::DOUBLE AS total_revenue, count(*) AS order_count FROM fo WHERE {where} GROUP BY 1, 2, 3"""


def region_months(orders):
    return orders.groupBy(
        "region", F.year("event_timestamp").alias("year"), F.month("event_timestamp").alias("month")
    ).agg(F.sum("total_amount").alias("total_revenue"), F.count("*").alias("order_count"))


@add("upsert_revenue", f"""WITH {ORDERS_CTE}, t AS ({_region_month_sql(f"event_timestamp < TIMESTAMP '{TURN}'")}),
u AS ({_region_month_sql(f"event_timestamp >= TIMESTAMP '{LATE}'")})
SELECT region, year, month, coalesce(u.total_revenue, t.total_revenue) AS total_revenue,
       coalesce(u.order_count, t.order_count) AS order_count
FROM t FULL JOIN u USING (region, year, month)""")
def _(spark, sf_dir):
    orders = tb.fact_orders(spark, sf_dir)
    return keyed.upsert(
        region_months(orders.filter(F.col("event_timestamp") < TURN)),
        region_months(orders.filter(F.col("event_timestamp") >= LATE)),
        ["region", "year", "month"],
    )


@add("insert_ignore_orders", f"""WITH {ORDERS_CTE}
SELECT order_id, customer_id, total_amount::DOUBLE AS total_amount,
       CASE WHEN event_timestamp < TIMESTAMP '{TURN}' THEN 'kept' ELSE 'new' END AS origin FROM fo""")
def _(spark, sf_dir):
    orders = tb.fact_orders(spark, sf_dir).select("order_id", "customer_id", "total_amount", "event_timestamp")
    target = orders.filter(F.col("event_timestamp") < TURN).drop("event_timestamp").withColumn("origin", F.lit("kept"))
    batch = orders.drop("event_timestamp").withColumn("origin", F.lit("new"))
    return keyed.insert_ignore(target, batch.unionAll(batch), ["order_id"])


@add("upsert_features", f"""WITH {ORDERS_CTE}, t AS (
  SELECT customer_id, count(*) AS frequency, max(total_amount)::DOUBLE AS max_purchase_value FROM fo
  WHERE event_timestamp < TIMESTAMP '{TURN}' GROUP BY 1),
u AS (SELECT customer_id, count(*) AS frequency, max(total_amount)::DOUBLE AS max_purchase_value FROM fo GROUP BY 1)
SELECT customer_id, '{EV_DAY}' AS snapshot_date, 'rfm' AS feature_set, u.frequency AS frequency,
       coalesce(t.max_purchase_value, u.max_purchase_value) AS max_purchase_value
FROM u LEFT JOIN t USING (customer_id)""")
def _(spark, sf_dir):
    from basketry.plans.features import rfm_features

    def store(orders):
        return rfm_features(orders, ORD_NOW).select(
            "customer_id", F.lit(EV_DAY).cast("date").alias("snapshot_date"), F.lit("rfm").alias("feature_set"),
            "frequency", "max_purchase_value",
        )

    orders, folder = tb.fact_orders(spark, sf_dir), fresh_folder(spark)
    store(orders.filter(F.col("event_timestamp") < TURN)).write.partitionBy("snapshot_date").parquet(folder)
    writers.upsert_partitions(
        store(orders), folder, ["customer_id", "snapshot_date", "feature_set"], "snapshot_date", ["frequency"]
    )
    return spark.read.parquet(folder)


@add("stored_upsert_scores", f"""WITH s AS (
  SELECT 'C' || lpad(c_custkey::VARCHAR, 7, '0') AS customer_id, (c_custkey * 7919 % 1000) / 1000.0 AS p, c_custkey AS k
  FROM customer)
SELECT customer_id, CASE WHEN k % 3 = 0 THEN 0.5 ELSE p END::DOUBLE AS churn_probability,
       CASE WHEN k % 3 = 0 THEN 'v2.0' ELSE 'v1.0' END AS model_version FROM s""")
def _(spark, sf_dir):
    """Scores stored, then new ones for every third customer (some twice) upserted, twice."""
    path = fresh_folder(spark)
    scores = tb.churn_scores(spark, sf_dir).select("customer_id", "churn_probability", "model_version")
    versions.upsert_stored(scores, path, ["customer_id"])
    third = F.substring("customer_id", 2, 7).cast("long") % 3 == 0
    new = scores.filter(third).withColumns({
        "churn_probability": F.lit(0.5).cast("decimal(8,6)"), "model_version": F.lit("v2.0")})
    both = new.unionByName(new.withColumn("churn_probability", F.lit(0.9).cast("decimal(8,6)")))
    for _run in range(2):
        versions.upsert_stored(both, path, ["customer_id"], order_by=["churn_probability"])
    return versions.read_current(spark, path)


@add("pipeline_monthly_revenue", f"""WITH {EVENTS_CTE}, untidy AS (
  SELECT event_id, n % 101 <> 0 AND n % 97 <> 0 AND n % 103 <> 0 AND n % 13 <> 0 AS kept, region, total_amount,
         discount_amount, event_timestamp, customer_id FROM ev WHERE event_type = 'PURCHASE'),
o AS (
  SELECT *, CAST(total_amount AS DECIMAL(15,2)) AS total, CAST(discount_amount AS DECIMAL(12,2)) AS off
  FROM untidy WHERE kept AND total_amount > 0)
SELECT region, year(event_timestamp) AS order_year, month(event_timestamp) AS order_month, count(*) AS orders,
       sum(total)::DOUBLE AS total_revenue, sum(total - off)::DOUBLE AS net_revenue, 0.0::DOUBLE AS tax FROM o GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    """Untidy events through cleaning, the order fact and its staging model, into a report."""
    clean = cleaning.clean_batch(tb.untidy_events(spark, sf_dir), EV_DAY)
    staged = staging.stg_orders(warehouse.fact_orders(clean, EV_DAY))
    return staged.groupBy("region", "order_year", "order_month").agg(
        F.count("*").alias("orders"), F.sum("total_amount").alias("total_revenue"), F.sum("net_amount").alias("net_revenue"),
        F.sum("tax_amount").alias("tax"))


# --- files and snapshots --------------------------------------------------------------------------------------


@add("gold_latest_snapshot", f"""WITH {EVENTS_CTE}
SELECT region, year(event_timestamp) AS event_year, month(event_timestamp) AS event_month,
       sum(CAST(total_amount AS DECIMAL(15,2)))::DOUBLE AS total_revenue, count(event_id) AS order_count,
       '2024-01-31' AS run_date
FROM ev WHERE event_type = 'PURCHASE' GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    folder = fresh_folder(spark)
    events = tb.events(spark, sf_dir)
    early = gold.revenue_by_region(events.filter(F.col("event_timestamp") < "2024-01-15"))
    writers.write_gold(early, folder, "2024-01-15")
    writers.write_gold(early, folder, "2024-01-31")
    writers.write_gold(gold.revenue_by_region(events), folder, "2024-01-31")
    return readers.read_latest_snapshot(spark, folder).drop("avg_order_value", "unique_customers")


@add("materialized_table", f"""WITH {EVENTS_CTE}
SELECT region, year(event_timestamp) AS event_year, month(event_timestamp) AS event_month, count(event_id) AS order_count
FROM ev WHERE event_type = 'PURCHASE' GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    """A gold model as a managed table, read back by name."""
    name = f"gold_{uuid.uuid4().hex}"
    writers.materialize(gold.revenue_by_region(tb.events(spark, sf_dir)), name)
    return readers.read_table(spark, name).select("region", "event_year", "event_month", "order_count")


@add("ticket_files", """
SELECT 'T' || conv_id || '-' || turn AS ticket_id, text AS issue_text, role AS status FROM conversations""")
def _(spark, sf_dir):
    """Tickets as files that hold one JSON array each, read back; a thousand tickets or so to a file."""
    folder = fresh_folder(spark)
    rows = tb.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("T"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("ticket_id"),
        F.col("text").alias("issue_text"), F.col("role").alias("status"))
    share = F.pmod(F.xxhash64("ticket_id"), F.lit(rows.count() // 1000 + 1))
    arrays = rows.groupBy(share.alias("share")).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return readers.read_json_array(spark, f"{folder}/*.txt").select("ticket_id", "issue_text", "status")


@add("read_layer_since", f"""WITH {EVENTS_CTE}
SELECT event_id, customer_id, event_type, day(event_timestamp) AS day FROM ev
WHERE event_timestamp >= TIMESTAMP '2024-01-20'""")
def _(spark, sf_dir):
    from basketry.functions import event_calendar

    folder = fresh_folder(spark)
    calendar = event_calendar(F.col("event_timestamp"))
    rows = tb.events(spark, sf_dir).withColumns({c: calendar[c] for c in ("year", "month", "day")})
    rows.write.partitionBy("year", "month", "day").parquet(folder)
    return readers.read_layer(spark, folder, since="2024-01-20").select(
        "event_id", "customer_id", "event_type", "day"
    )


FILE_COLUMNS = ["event_id", "customer_id", "event_type", "product_id", "price", "total_amount"]
FILE_SQL = f"""WITH {EVENTS_CTE}
SELECT event_id, customer_id, event_type, product_id, price, total_amount,
       array_to_string(categories, ',') AS categories FROM ev"""


def _file_rows(spark, sf_dir):
    names = schemas.struct(schemas.PAYLOAD).fieldNames()
    rows = tb.events(spark, sf_dir)
    kept = [c for c in names if c in rows.columns]
    return rows.select(*kept), names


def _shown(df):
    return df.select(*FILE_COLUMNS, F.array_join("categories", ",").alias("categories"))


@add("read_json_lines", FILE_SQL)
def _(spark, sf_dir):
    folder = fresh_folder(spark)
    rows, _ = _file_rows(spark, sf_dir)
    rows.write.json(folder)
    return _shown(readers.read_events_files(spark, folder, "json"))


@add("read_csv", FILE_SQL)
def _(spark, sf_dir):
    folder = fresh_folder(spark)
    rows, names = _file_rows(spark, sf_dir)
    lists = {c: F.to_json(c) for c in ("product_ids", "categories")}
    flat = rows.withColumns(lists)
    ordered = [F.col(c) if c in flat.columns else F.lit(None).cast("string").alias(c) for c in names]
    flat.select(*ordered).write.csv(folder, header=True, escape='"')
    return _shown(readers.read_events_files(spark, folder, "csv"))


@add("read_parquet_events", FILE_SQL)
def _(spark, sf_dir):
    folder = fresh_folder(spark)
    rows, _ = _file_rows(spark, sf_dir)
    rows.write.parquet(folder)
    return _shown(readers.read_events_files(spark, folder, "parquet"))


# --- serving --------------------------------------------------------------------------------------------------

SCORES_CTE = f"""
sc0 AS (
  SELECT 'C' || lpad(c_custkey::VARCHAR, 7, '0') AS customer_id, (c_custkey * 7919) % 1000 AS m,
         ((c_custkey * 104729) % 1000 < (c_custkey * 7919) % 1000)::BIGINT AS label FROM customer),
sc AS (
  SELECT customer_id, m::DOUBLE / 1000.0 AS churn_probability, label, m,
         CASE WHEN m <= 300 THEN 'low_risk' WHEN m <= 600 THEN 'medium_risk' ELSE 'high_risk' END AS churn_segment,
         {time_text(f"TIMESTAMP '{ORD_NOW}'")} AS scored_at FROM sc0)"""


@add("kpi_stats", f"""WITH {ORDERS_CTE}, {SCORES_CTE}
SELECT (SELECT count(*) FROM fo) AS total_orders, (SELECT sum(total_amount)::DOUBLE FROM fo) AS total_revenue,
       (SELECT count(DISTINCT customer_id) FROM fo
        WHERE event_timestamp >= TIMESTAMP '{ORD_NOW}' - INTERVAL 30 DAY) AS active_customers,
       (SELECT count(*) FROM sc WHERE churn_segment = 'high_risk') AS high_risk""")
def _(spark, sf_dir):
    return serving.kpi_stats(tb.fact_orders(spark, sf_dir), tb.churn_scores(spark, sf_dir), ORD_NOW)


@add("total_customers", "SELECT count(DISTINCT user_id) AS total_customers FROM events")
def _(spark, sf_dir):
    return serving.total_customers(dim_customer(spark, sf_dir))


@add("table_row_counts", f"""WITH {EVENTS_CTE}
SELECT 'fact_orders' AS table_name, (SELECT count(*) FROM orders) AS row_count
UNION ALL SELECT 'fact_transactions', (SELECT count(*) FROM ev
  WHERE event_type IN ('PURCHASE','REFUND','SUBSCRIPTION','PAYMENT_FAILURE'))
UNION ALL SELECT 'dim_customer', (SELECT count(DISTINCT customer_id) FROM ev)
UNION ALL SELECT 'revenue_metrics', (SELECT count(*) FROM (
  SELECT DISTINCT region, year(event_timestamp), month(event_timestamp) FROM ev WHERE event_type = 'PURCHASE'))
UNION ALL SELECT 'customer_churn_scores', (SELECT count(*) FROM customer)""")
def _(spark, sf_dir):
    events = tb.events(spark, sf_dir)
    return serving.table_row_counts(
        {
            "fact_orders": tb.fact_orders(spark, sf_dir),
            "fact_transactions": warehouse.fact_transactions(events),
            "dim_customer": dim_customer(spark, sf_dir),
            "revenue_metrics": gold.revenue_by_region(events),
            "customer_churn_scores": tb.churn_scores(spark, sf_dir),
        }
    )


@add("customer_profile", f"""WITH {EVENTS_CTE}, {DIM_CTE}, {ORDERS_CTE}, {SCORES_CTE}, ranked AS (
  SELECT customer_id, order_id, event_timestamp, total_amount, payment_method, row_number() OVER (
    PARTITION BY customer_id ORDER BY event_timestamp DESC, order_id DESC) AS place FROM fo)
SELECT dc.customer_id, dc.region, dc.total_events, dc.total_spend::DOUBLE AS total_spend, place, order_id,
       {time_text('event_timestamp')} AS ordered_at, r.total_amount::DOUBLE AS total_amount, r.payment_method,
       sc.churn_probability, sc.churn_segment
FROM dc LEFT JOIN (SELECT * FROM ranked WHERE place <= 10) r USING (customer_id)
LEFT JOIN sc USING (customer_id)""")
def _(spark, sf_dir):
    profiles = serving.customer_profile(
        tb.events(spark, sf_dir), dim_customer(spark, sf_dir), tb.fact_orders(spark, sf_dir),
        tb.churn_scores(spark, sf_dir),
    )
    opened = profiles.select("*", F.explode_outer("recent_orders").alias("o"))
    return opened.select(
        "customer_id", "region", "total_events", "total_spend", "o.place", "o.order_id",
        F.col("o.event_timestamp").alias("ordered_at"), "o.total_amount", "o.payment_method", "churn_probability",
        "churn_segment",
    )


@add("monthly_revenue_by_region", f"""WITH {ORDERS_CTE}
SELECT {time_text("date_trunc('month', event_timestamp)")} AS time, region, sum(total_amount)::DOUBLE AS value
FROM fo WHERE event_timestamp BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31' GROUP BY 1, 2""")
def _(spark, sf_dir):
    return serving.monthly_revenue_by_region(tb.fact_orders(spark, sf_dir), "1997-01-01", "1999-12-31")


@add("top_churn_risk", f"""WITH {SCORES_CTE}
SELECT customer_id, churn_probability, churn_segment, scored_at FROM sc
WHERE churn_segment IN ('high_risk', 'medium_risk') ORDER BY churn_probability DESC, customer_id LIMIT 15""")
def _(spark, sf_dir):
    return serving.top_churn_risk(tb.churn_scores(spark, sf_dir))


@add("churn_distribution", f"""WITH {SCORES_CTE}
SELECT churn_segment, count(*) AS customer_count, {exact_ratio('sum(m)::BIGINT', 'count(*)', 0)} / 1000.0
         AS avg_probability FROM sc GROUP BY 1""")
def _(spark, sf_dir):
    return serving.churn_distribution(tb.churn_scores(spark, sf_dir))


def run_log(spark, sf_dir):
    events, orders = tb.events(spark, sf_dir), tb.fact_orders(spark, sf_dir)
    runs = [
        ("bronze_to_silver", "clean", events, "2024-01-31 00:00:00", "2024-01-31 00:05:00"),
        ("silver_to_gold", "customer_360", gold.customer_360(events), "2024-01-31 01:00:00", "2024-01-31 01:01:30"),
        ("gold_to_warehouse", "fact_orders", orders, "2024-01-31 02:00:00", "2024-01-31 02:00:45"),
    ]
    rows = [writers.run_log_row(df, dag, "r1", task, a, b) for dag, task, df, a, b in runs]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@add("latest_pipeline_runs", """
SELECT 'bronze_to_silver' AS dag_id, 'clean' AS task_id, 'success' AS status, count(*) AS records_processed,
       300::BIGINT AS duration_seconds, '2024-01-31 00:00:00.000000' AS started_at FROM events
UNION ALL SELECT 'silver_to_gold', 'customer_360', 'success', count(DISTINCT user_id), 90,
                 '2024-01-31 01:00:00.000000' FROM events
UNION ALL SELECT 'gold_to_warehouse', 'fact_orders', 'success', count(*), 45, '2024-01-31 02:00:00.000000'
FROM orders""")
def _(spark, sf_dir):
    folder = fresh_folder(spark)
    writers.append_run_log(run_log(spark, sf_dir), folder)
    return serving.latest_pipeline_runs(spark.read.parquet(folder))


@add("latest_runs_of_many", """
SELECT 'daily' AS dag_id, strftime(ts, '%Y-%m-%d') AS task_id, 'success' AS status, count(*) AS records_processed,
       60::BIGINT AS duration_seconds, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S.%f') AS started_at
FROM events GROUP BY 2, 6 ORDER BY started_at DESC LIMIT 20""")
def _(spark, sf_dir):
    """A run for every day of events, of which twenty are shown."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    runs = tb.table(spark, sf_dir, "events").groupBy(day.alias("started_at")).agg(F.count("*").alias("records_processed"))
    return serving.latest_pipeline_runs(runs.select(
        F.lit("daily").alias("dag_id"), F.date_format("started_at", "yyyy-MM-dd").alias("task_id"),
        F.lit("success").alias("status"), "records_processed", F.lit(60).alias("duration_seconds"), "started_at"))


@add("warehouse_sql", f"""WITH {ORDERS_CTE}, {SCORES_CTE}
SELECT churn_segment, count(DISTINCT customer_id) AS customers, sum(total_amount)::DOUBLE AS revenue
FROM fo JOIN sc USING (customer_id) GROUP BY 1""")
def _(spark, sf_dir):
    serving.register_views(
        {"fact_orders": tb.fact_orders(spark, sf_dir), "customer_churn_scores": tb.churn_scores(spark, sf_dir)}
    )
    return serving.run_sql(
        spark,
        "SELECT churn_segment, count(DISTINCT o.customer_id) AS customers, sum(total_amount) AS revenue "
        "FROM fact_orders o JOIN customer_churn_scores s ON o.customer_id = s.customer_id GROUP BY churn_segment",
    )


@add("staged_orders_view", f"""WITH {ORDERS_CTE}
SELECT reg AS region, count(*) AS orders, sum(net_amount)::DOUBLE AS net FROM so GROUP BY 1""")
def _(spark, sf_dir):
    writers.materialize(staging.stg_orders(tb.fact_orders(spark, sf_dir)), "stg_orders", "view")
    return serving.run_sql(
        spark, "SELECT region, count(*) AS orders, sum(net_amount) AS net FROM stg_orders GROUP BY region"
    )
