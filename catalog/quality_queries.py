"""Cleaning, deduplication, contract and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry import testbed as tb
from basketry.operators import cleaning, contract, dedup, quality
from basketry.plans import marts, staging
from basketry.session import shared_path
from basketry.sinks.writers import append_dq_results, to_topic_rows
from catalog.common import (
    EV_NOW, EVENTS_CTE, ORD_NOW, ORDERS_CTE, UNTIDY_CTE, Catalog, cents, day_text, exact_ratio, time_text,
)
from catalog.mart_queries import LTV_CTE, ltv, orders

CATALOG = Catalog()
add = CATALOG.add

CLEAN_VALUES = """
         upper(trim(customer_id)) AS customer_id, upper(trim(event_type)) AS event_type,
         CASE lower(trim(device)) WHEN 'mobile' THEN 'Mobile' WHEN 'app' THEN 'Mobile' WHEN 'desktop' THEN 'Desktop'
              WHEN 'tablet' THEN 'Tablet' ELSE 'Unknown' END AS device,
         array_to_string(list_transform(string_split(trim(region), ' '),
                         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS region"""

DIRTY_CTE = f"""{UNTIDY_CTE},
cleaned AS (
  SELECT event_id, n, copy_no, {CLEAN_VALUES}, parsed AS event_timestamp, total_amount AS signed,
         abs(total_amount) AS total_amount, abs(price) AS price, order_id, has_time, product_id
  FROM untidy)"""


@add("clean_stream", f"""WITH {DIRTY_CTE}
SELECT event_id, copy_no::BIGINT AS copy_no, customer_id, event_type, device, region, total_amount, price,
       {time_text('event_timestamp')} AS event_timestamp, {day_text('event_timestamp')} AS event_date,
       hour(event_timestamp)::BIGINT AS event_hour, year(event_timestamp)::BIGINT AS year,
       month(event_timestamp)::BIGINT AS month, day(event_timestamp)::BIGINT AS day FROM cleaned""")
def _(spark, sf_dir):
    return cleaning.clean_stream(tb.untidy_events(spark, sf_dir), EV_NOW).select(
        "event_id", "copy_no", "customer_id", "event_type", "device", "region", "total_amount", "price",
        "event_timestamp", "event_date", "event_hour", "year", "month", "day",
    )


FLAGS_SQL = f"""
flags AS (
  SELECT *, customer_id IS NULL OR customer_id = '' AS dq_missing_customer_id,
         event_type IS NULL AS dq_missing_event_type, event_timestamp IS NULL AS dq_invalid_timestamp,
         coalesce(signed < 0, FALSE) AS dq_negative_amount,
         coalesce(event_timestamp > TIMESTAMP '{EV_NOW}' - INTERVAL 1 DAY, FALSE) AS dq_future_timestamp
  FROM cleaned)"""


@add("quality_flags", f"""WITH {DIRTY_CTE}, {FLAGS_SQL}
SELECT event_id, copy_no::BIGINT AS copy_no, dq_missing_customer_id, dq_missing_event_type, dq_invalid_timestamp,
       dq_negative_amount, dq_future_timestamp,
       NOT (dq_missing_customer_id OR dq_missing_event_type OR dq_invalid_timestamp OR dq_negative_amount)
         AS dq_passed FROM flags""")
def _(spark, sf_dir):
    clean = cleaning.clean_stream(tb.untidy_events(spark, sf_dir), EV_NOW)
    flagged = cleaning.quality_flags(clean, "2024-01-30 00:00:00")
    return flagged.select("event_id", "copy_no", *[c for c in flagged.columns if c.startswith("dq_")])


@add("clean_batch", f"""WITH {DIRTY_CTE}
SELECT DISTINCT event_id, customer_id, event_type, device, region, total_amount, price,
       {time_text('event_timestamp')} AS event_timestamp, {day_text('event_timestamp')} AS event_date,
       year(event_timestamp)::BIGINT AS event_year, month(event_timestamp)::BIGINT AS event_month,
       hour(event_timestamp)::BIGINT AS event_hour, TRUE AS dq_passed, '' AS dq_issues
FROM cleaned WHERE customer_id IS NOT NULL AND event_timestamp IS NOT NULL""")
def _(spark, sf_dir):
    return cleaning.clean_batch(tb.untidy_events(spark, sf_dir), EV_NOW).select(
        "event_id", "customer_id", "event_type", "device", "region", "total_amount", "price", "event_timestamp",
        "event_date", "event_year", "event_month", "event_hour", "dq_passed", "dq_issues",
    )


@add("cleaning_report", f"""WITH {DIRTY_CTE}, t AS (
  SELECT count(*) AS rows_in, count(*) FILTER (customer_id IS NULL) AS incomplete,
         count(*) FILTER (customer_id IS NOT NULL) - count(DISTINCT event_id) FILTER (customer_id IS NOT NULL)
           AS copies,
         count(DISTINCT event_id) FILTER (customer_id IS NOT NULL AND NOT has_time) AS undated,
         count(DISTINCT event_id) FILTER (customer_id IS NOT NULL AND has_time) AS rows_out FROM cleaned)
SELECT *, rows_in - rows_out AS removed, rows_out = 0 AS is_empty FROM t""")
def _(spark, sf_dir):
    return cleaning.cleaning_report(tb.untidy_events(spark, sf_dir))


@add("dedup_batch", f"""WITH {UNTIDY_CTE}
SELECT event_id, session_id, country, min(copy_no)::BIGINT AS copy_no FROM untidy GROUP BY ALL""")
def _(spark, sf_dir):
    rows = tb.untidy_events(spark, sf_dir)
    return dedup.dedup_batch(rows, "event_id", ["timestamp", "copy_no"]).select(
        "event_id", "session_id", "country", "copy_no"
    )


@add("duplicate_rows", f"""WITH {UNTIDY_CTE}
SELECT event_id, copy_no::BIGINT AS copy_no, session_id FROM untidy
WHERE event_id IN (SELECT event_id FROM untidy GROUP BY 1 HAVING count(*) > 1)""")
def _(spark, sf_dir):
    return dedup.duplicate_rows(tb.untidy_events(spark, sf_dir)).select("event_id", "copy_no", "session_id")


def cleaned(spark, sf_dir):
    """Untidy events, cleaned but with the sign of the amount kept."""
    clean = cleaning.clean_stream(tb.untidy_events(spark, sf_dir), EV_NOW)
    return clean.withColumn("total_amount", F.col("raw_total_amount")).drop("raw_total_amount")


KNOWN = "'LOGIN','LOGOUT','PRODUCT_VIEW','SEARCH','ADD_TO_CART','PURCHASE','REFUND','SUBSCRIPTION','PAYMENT_FAILURE'"
RULES_CTE = f"""{DIRTY_CTE}, counts AS (
  SELECT count(*) AS total,
    count(*) FILTER (customer_id IS NULL) AS no_null_customer_id,
    count(*) FILTER (event_type IS NULL) AS no_null_event_type,
    count(*) FILTER (event_timestamp IS NULL) AS no_null_timestamp,
    count(*) FILTER (event_type NOT IN ({KNOWN})) AS valid_event_types,
    count(*) FILTER (signed < 0) AS no_negative_amounts,
    count(*) FILTER (event_timestamp > TIMESTAMP '{EV_NOW}') AS no_future_timestamps,
    (SELECT sum(c)::BIGINT FROM (SELECT count(*) AS c FROM cleaned GROUP BY event_id HAVING count(*) > 1))
      AS duplicate_events,
    count(*) FILTER (NOT regexp_full_match(customer_id, 'C[0-9]+')) AS valid_customer_id_format,
    count(*) FILTER (event_type = 'PURCHASE' AND order_id IS NULL) AS purchase_has_order_id,
    count(*) FILTER (event_type = 'PURCHASE' AND (signed IS NULL OR signed <= 0)) AS purchase_has_amount
  FROM cleaned),
long AS (UNPIVOT counts ON COLUMNS(* EXCLUDE total) INTO NAME rule_name VALUE failed),
rules AS (
  SELECT rule_name, 'silver_events' AS table_name, total AS total_records, failed AS failed_records,
         round(failed / total, 6) AS failure_rate,
         failed / total <= CASE WHEN rule_name IN ('no_future_timestamps', 'valid_customer_id_format') THEN 0.001
                           ELSE 0 END AS passed,
         CASE WHEN rule_name IN ('no_future_timestamps', 'valid_customer_id_format', 'duplicate_events')
              THEN 'warning' ELSE 'error' END AS severity,
         {time_text(f"TIMESTAMP '{EV_NOW}'")} AS checked_at
  FROM long)"""


def rule_results(spark, sf_dir):
    return quality.run_rules(cleaned(spark, sf_dir), quality.standard_rules(EV_NOW), "silver_events", EV_NOW)


@add("run_rules", f"WITH {RULES_CTE} SELECT * FROM rules")
def _(spark, sf_dir):
    return rule_results(spark, sf_dir)


@add("rule_summary", f"""WITH {RULES_CTE}
SELECT count(*) AS total_rules, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
       count(*) FILTER (passed) / count(*) AS pass_rate FROM rules""")
def _(spark, sf_dir):
    return quality.rule_summary(rule_results(spark, sf_dir))


@add("dq_alerts", f"WITH {RULES_CTE} SELECT * FROM rules WHERE failure_rate > 0.01")
def _(spark, sf_dir):
    return quality.dq_alerts(rule_results(spark, sf_dir))


@add("latest_dq_results", f"""WITH {RULES_CTE}
SELECT * REPLACE (round(failure_rate, 4) AS failure_rate) FROM rules
ORDER BY checked_at DESC, rule_name, table_name LIMIT 20""")
def _(spark, sf_dir):
    from basketry.plans.serving import latest_dq_results

    folder = shared_path(spark)
    append_dq_results(rule_results(spark, sf_dir), folder)
    return latest_dq_results(spark.read.parquet(folder))


@add("latest_dq_results_of_many", f"""WITH {RULES_CTE}, many AS (
  SELECT rules.* REPLACE (table_name || '_' || k AS table_name, round(failure_rate, 4) AS failure_rate)
  FROM rules, (SELECT unnest([0, 1, 2]) AS k))
SELECT * FROM many ORDER BY checked_at DESC, rule_name, table_name LIMIT 20""")
def _(spark, sf_dir):
    """Thirty stored results, of which the panel shows twenty."""
    from basketry.plans.serving import latest_dq_results

    folder, results = shared_path(spark), rule_results(spark, sf_dir)
    for k in range(3):
        append_dq_results(results.withColumn("table_name", F.concat("table_name", F.lit(f"_{k}"))), folder)
    return latest_dq_results(spark.read.parquet(folder))


NOT_NULL, TO_EXIST, IN_SET = (
    "expect_column_values_to_not_be_null", "expect_column_to_exist", "expect_column_values_to_be_in_set"
)
SUITE_CTE = f"""{DIRTY_CTE}, s AS (
  SELECT count(*) AS n, count(*) FILTER (customer_id IS NULL) AS b1, count(*) FILTER (event_type IS NULL) AS b2,
         count(*) FILTER (event_timestamp IS NULL) AS b3, count(*) FILTER (event_id IS NULL) AS b4,
         count(*) - count(DISTINCT event_id) AS b8,
         count(*) FILTER (NOT coalesce(event_type IN ({KNOWN}), FALSE)) AS b9,
         count(*) FILTER (NOT coalesce(device IN ('Mobile','Desktop','Tablet'), FALSE)) AS b10,
         count(*) FILTER (signed < 0 OR signed > 1000000) AS b11, count(signed) AS seen
  FROM cleaned),
suite AS (
  SELECT 1::BIGINT AS position, '{NOT_NULL}' AS expectation, 'customer_id' AS column_name, 'critical' AS severity,
         b1 AS bad_rows, b1 = 0 AS passed FROM s
  UNION ALL SELECT 2, '{NOT_NULL}', 'event_type', 'critical', b2, b2 = 0 FROM s
  UNION ALL SELECT 3, '{NOT_NULL}', 'event_timestamp', 'critical', b3, b3 = 0 FROM s
  UNION ALL SELECT 4, '{NOT_NULL}', 'event_id', 'critical', b4, b4 = 0 FROM s
  UNION ALL SELECT 5, '{TO_EXIST}', 'customer_id', 'critical', 0, TRUE FROM s
  UNION ALL SELECT 6, '{TO_EXIST}', 'event_type', 'critical', 0, TRUE FROM s
  UNION ALL SELECT 7, 'expect_table_columns_to_match_set', NULL, 'warning', 1, FALSE FROM s
  UNION ALL SELECT 8, 'expect_column_values_to_be_unique', 'event_id', 'warning', b8, b8 = 0 FROM s
  UNION ALL SELECT 9, '{IN_SET}', 'event_type', 'critical', b9, b9 = 0 FROM s
  UNION ALL SELECT 10, '{IN_SET}', 'device', 'warning', b10, b10 = 0 FROM s
  UNION ALL SELECT 11, 'expect_column_values_to_be_between', 'total_amount', 'warning', b11,
                   b11 / seen <= 1 - 0.999 FROM s
  UNION ALL SELECT 12, 'expect_table_row_count_to_be_between', NULL, 'info', 0, n BETWEEN 1 AND 50000000 FROM s)"""


def suite_results(spark, sf_dir):
    return quality.run_suite(cleaned(spark, sf_dir), quality.SILVER_SUITE)


@add("expectation_suite", f"WITH {SUITE_CTE} SELECT * FROM suite")
def _(spark, sf_dir):
    return suite_results(spark, sf_dir)


@add("suite_summary", f"""WITH {SUITE_CTE}
SELECT 'silver_events' AS suite, count(*) AS total, count(*) FILTER (passed) AS passed,
       count(*) FILTER (NOT passed) AS failed, count(*) FILTER (passed) / count(*) AS pass_rate,
       count(*) FILTER (severity = 'critical' AND NOT passed) = 0 AS success FROM suite""")
def _(spark, sf_dir):
    return quality.suite_summary(suite_results(spark, sf_dir), "silver_events")


@add("schema_tests", f"""WITH {DIRTY_CTE}, {ORDERS_CTE}
SELECT 'not_null customer_id' AS test, count(*) AS violations, count(*) = 0 AS passed
FROM cleaned WHERE customer_id IS NULL
UNION ALL SELECT 'unique event_id', count(*), count(*) = 0
FROM (SELECT event_id FROM cleaned GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'accepted_values event_type', count(*), count(*) = 0
FROM (SELECT DISTINCT event_type FROM cleaned WHERE event_type NOT IN ({KNOWN}))
UNION ALL SELECT 'unique customer_id, region', count(*), count(*) = 0
FROM (SELECT customer_id, region FROM (SELECT DISTINCT customer_id, region FROM fo WHERE total_amount > 0)
      GROUP BY 1, 2 HAVING count(*) > 1)""")
def _(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    summary = marts.int_customer_orders(tb.fact_orders(spark, sf_dir), ORD_NOW)
    by_row = quality.table_tests(rows, {
        "not_null customer_id": quality.bad_rows(F.col("customer_id").isNull()),
        "accepted_values event_type": quality.bad_values("event_type", KNOWN.strip("'").split("','")),
    })
    return by_row.union(quality.violation_counts({
        "unique event_id": quality.unique_violations(rows, "event_id"),
        "unique customer_id, region": quality.unique_violations(summary, "customer_id", "region"),
    }))


@add("singular_tests", f"""WITH {DIRTY_CTE}, {ORDERS_CTE}, {LTV_CTE}
SELECT 'orders positive amount' AS test, count(*) AS violations, count(*) = 0 AS passed
FROM cleaned WHERE order_id IS NOT NULL AND event_type = 'PURCHASE' AND signed <= 0
UNION ALL SELECT 'revenue keys not null', count(*), count(*) = 0 FROM (
  SELECT region FROM so GROUP BY order_year, order_month, month_start, region, device, payment_method
  HAVING region IS NULL OR order_year IS NULL OR order_month IS NULL OR sum(total_amount) IS NULL)
UNION ALL SELECT 'score between 0 and 100', count(*), count(*) = 0 FROM ltv
WHERE ltv_score < 0 OR ltv_score > 100
UNION ALL SELECT 'revenue not negative', count(*), count(*) = 0 FROM (
  SELECT region FROM so GROUP BY order_year, order_month, month_start, region, device, payment_method
  HAVING sum(total_amount) < 0)""")
def _(spark, sf_dir):
    bought = cleaned(spark, sf_dir).filter((F.col("event_type") == "PURCHASE") & F.col("order_id").isNotNull())
    monthly = marts.monthly_revenue(orders(spark, sf_dir))
    no_key = F.lit(False)
    for c in ("order_year", "order_month", "region", "gross_revenue"):
        no_key = no_key | F.col(c).isNull()
    score = F.col("ltv_score")
    return (
        quality.table_tests(bought, {"orders positive amount": quality.bad_rows(F.col("total_amount") <= 0)})
        .union(quality.table_tests(monthly, {
            "revenue keys not null": quality.bad_rows(no_key),
            "revenue not negative": quality.bad_rows(F.col("gross_revenue") < 0),
        }))
        .union(quality.table_tests(ltv(spark, sf_dir), {
            "score between 0 and 100": quality.bad_rows((score < 0) | (score > 100))}))
    )


@add("suite_from_text", f"""WITH {DIRTY_CTE}
SELECT 1::BIGINT AS position, 'expect_column_values_to_not_be_null' AS expectation, 'customer_id' AS column_name,
       'critical' AS severity, count(*) FILTER (customer_id IS NULL) AS bad_rows,
       count(*) FILTER (customer_id IS NULL) = 0 AS passed FROM cleaned
UNION ALL SELECT 2, 'expect_table_row_count_to_be_between', NULL, 'info', 0, count(*) BETWEEN 1 AND 100 FROM cleaned""")
def _(spark, sf_dir):
    suite = quality.load_suite("""{"expectations": [
      {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "customer_id"},
       "meta": {"severity": "critical"}},
      {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 100},
       "meta": {"severity": "info"}}]}""")
    return quality.run_suite(cleaned(spark, sf_dir), suite)


@add("event_contract", f"""WITH {EVENTS_CTE}, v AS (
  SELECT event_id, event_type,
    list_filter([
      'missing city', 'missing ip_address', 'missing user_agent', 'missing timestamp',
      CASE WHEN event_type = 'LOGIN' THEN 'missing login_method' END,
      CASE WHEN event_type = 'LOGIN' THEN 'missing success' END,
      CASE WHEN event_type = 'LOGOUT' THEN 'missing session_duration_seconds' END,
      CASE WHEN event_type = 'PRODUCT_VIEW' THEN 'missing subcategory' END,
      CASE WHEN event_type = 'PRODUCT_VIEW' THEN 'missing view_duration_seconds' END,
      CASE WHEN event_type = 'SEARCH' THEN 'missing search_query' END,
      CASE WHEN event_type = 'SEARCH' THEN 'missing results_count' END,
      CASE WHEN event_type = 'ADD_TO_CART' THEN 'missing quantity' END,
      CASE WHEN event_type = 'ADD_TO_CART' THEN 'missing cart_total' END,
      CASE WHEN event_type = 'PURCHASE' THEN 'missing tax_amount' END,
      CASE WHEN event_type = 'REFUND' THEN 'missing reason' END,
      CASE WHEN event_type = 'REFUND' THEN 'missing initiated_by' END,
      CASE WHEN event_type = 'SUBSCRIPTION' THEN 'missing action' END,
      CASE WHEN event_type = 'SUBSCRIPTION' THEN 'missing billing_cycle' END,
      CASE WHEN event_type = 'PAYMENT_FAILURE' THEN 'missing retry_count' END,
      CASE WHEN device NOT IN ('Mobile','Desktop','Tablet','App') THEN 'unknown device' END
    ], lambda x: x IS NOT NULL) AS reasons FROM ev)
SELECT event_id, event_type, array_to_string(reasons, '; ') AS reasons, FALSE AS contract_valid FROM v""")
def _(spark, sf_dir):
    checked = contract.validate_event_contract(tb.events(spark, sf_dir))
    return checked.select(
        "event_id", "event_type", F.array_join("contract_reasons", "; ").alias("reasons"), "contract_valid"
    )


@add("event_contract_complete", f"""WITH {EVENTS_CTE}
SELECT event_id, event_type, CASE WHEN device = 'Unknown' THEN 'unknown device' ELSE '' END AS reasons,
       device <> 'Unknown' AS contract_valid FROM ev""")
def _(spark, sf_dir):
    """Events with all fields of their type: valid but for the device."""
    events = tb.events(spark, sf_dir)
    wanted = [*contract.BASE_FIELDS, *(f for fields in contract.TYPE_FIELDS.values() for f in fields)]
    whole = events.withColumns({f: F.lit("x") for f in dict.fromkeys(wanted) if f not in events.columns})
    return contract.validate_event_contract(whole).select(
        "event_id", "event_type", F.array_join("contract_reasons", "; ").alias("reasons"), "contract_valid")


@add("topic_rows", f"""WITH {EVENTS_CTE}
SELECT customer_id AS key,
       CASE WHEN event_type IN ('LOGIN','LOGOUT') THEN 'customer-login'
            WHEN event_type IN ('PRODUCT_VIEW','SEARCH') THEN 'product-events'
            WHEN event_type = 'ADD_TO_CART' THEN 'cart-events' WHEN event_type = 'PURCHASE' THEN 'purchase-events'
            WHEN event_type = 'REFUND' THEN 'refund-events' ELSE 'payment-events' END AS topic,
       event_id, total_amount FROM ev""")
def _(spark, sf_dir):
    rows = to_topic_rows(tb.events(spark, sf_dir))
    return rows.select(
        "key", "topic", F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.total_amount").cast("double").alias("total_amount"),
    )


@add("parse_payload", f"""WITH {EVENTS_CTE}
SELECT event_id, customer_id, event_type, session_id, product_id, price, total_amount, items_count::BIGINT AS items_count,
       array_to_string(product_ids, ',') AS product_ids, array_to_string(categories, ',') AS categories,
       {time_text('event_timestamp')} AS broker_timestamp FROM ev""")
def _(spark, sf_dir):
    from basketry import schemas

    source = tb.events(spark, sf_dir)
    messages = source.select(
        F.to_json(F.struct(*source.columns)).cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.col("event_timestamp").alias("timestamp"),
    )
    parsed = cleaning.parse_payload(messages, schemas.PAYLOAD)
    return parsed.select(
        "event_id", "customer_id", "event_type", "session_id", "product_id", "price", "total_amount", "items_count",
        F.array_join("product_ids", ",").alias("product_ids"), F.array_join("categories", ",").alias("categories"),
        "broker_timestamp",
    )


@add("net_amount", f"""WITH {ORDERS_CTE}
SELECT order_id, {exact_ratio(cents('total_amount - discount_amount'), '1', 0)} / 100.0 AS net_amount FROM fo""")
def _(spark, sf_dir):
    return tb.fact_orders(spark, sf_dir).select("order_id", staging.net_amount().alias("net_amount"))


@add("fill_defaults", f"""WITH {EVENTS_CTE}
SELECT event_id, coalesce(total_amount, 0) AS total_amount, coalesce(payment_method, 'unknown') AS payment_method,
       coalesce(items_count, 1)::BIGINT AS items_count, 'Unknown' AS city FROM ev""")
def _(spark, sf_dir):
    return cleaning.fill_defaults(
        tb.events(spark, sf_dir),
        {"total_amount": 0.0, "payment_method": "unknown", "items_count": 1, "city": "Unknown"},
    ).select("event_id", "total_amount", "payment_method", "items_count", "city")
