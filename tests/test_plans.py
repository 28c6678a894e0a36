"""Marts, gold, facts, keyed writes and serving on hand-written rows with ties, gaps and zero bases."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators import keyed
from basketry.plans import gold, marts, serving, staging, warehouse

AS_OF = "2024-07-01 00:00:00"
ORDERS = (
    "order_id string, customer_id string, event_timestamp timestamp, total_amount decimal(15,2), "
    "discount_amount decimal(12,2), tax_amount decimal(12,2), payment_method string, items_count int, "
    "region string, device string"
)


def order(i, customer, day, amount, region="east", device="Mobile", method="upi", discount=0, items=1):
    return (f"o{i}", customer, datetime.fromisoformat(day), None if amount is None else Decimal(str(amount)),
            None if discount is None else Decimal(str(discount)), Decimal(0), method, items, region, device)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def test_staged_orders_drop_empty_amounts_and_fill_discounts(spark):
    df = orders(spark, order(1, "c", "2024-01-05", 10, " new delhi "), order(2, "c", "2024-01-05", 0),
                order(3, None, "2024-01-05", 5), order(4, "c", "2024-01-05", 8, discount=None))
    rows = {r.order_id: r for r in staging.stg_orders(df).collect()}
    assert set(rows) == {"o1", "o4"}
    assert rows["o1"].region == "New Delhi" and rows["o4"].net_amount == Decimal("8.00")


def test_segments_and_tiers_on_their_edges(spark):
    days = {"a": 30, "b": 31, "c": 90, "d": 91, "e": 180, "f": 181}
    spend = {"a": 25000, "b": 24999.99, "c": 100000, "d": 500000, "e": 99999.99, "f": 499999.99}
    today = datetime(2024, 7, 1)
    df = orders(spark, *[order(k, k, (today - timedelta(days=n)).isoformat(), spend[k]) for k, n in days.items()])
    rows = {r.customer_id: r for r in marts.int_customer_orders(df, AS_OF).collect()}
    assert [rows[k].recency_segment for k in "abcdef"] == [
        "active", "at_risk", "at_risk", "lapsed", "lapsed", "churned"]
    assert [rows[k].value_tier for k in "abcdef"] == ["silver", "bronze", "gold", "platinum", "silver", "gold"]
    assert rows["a"].monthly_order_frequency == 1 and rows["a"].customer_lifespan_days == 0


def test_mode_takes_the_lowest_of_equals_and_frequency_divides_whole_months(spark):
    df = orders(spark, order(1, "c", "2024-01-01", 10, device="Tablet", method="upi"),
                order(2, "c", "2024-03-15", 10, device="Desktop", method="card"),
                order(3, "c", "2024-03-16", 10, device="Mobile", method="card"))
    row = marts.int_customer_orders(df, AS_OF).first()
    assert (row.preferred_device, row.preferred_payment) == ("Desktop", "card")
    assert row.customer_lifespan_days == 75 and float(row.monthly_order_frequency) == 1.5


def test_value_of_a_single_order_customer_without_profile(spark):
    dims = spark.createDataFrame(
        [("z",)], "customer_id string").selectExpr("customer_id", "'r' AS region", "'d' AS preferred_device",
                                                   "'active' AS activity_status")
    df = staging.stg_orders(orders(spark, order(1, "c", "2024-06-21", 1000)))
    row = marts.customer_lifetime_value(df, dims, AS_OF).first()
    assert float(row.predicted_ltv_12m) == 1000 and row.region is None
    assert row.ltv_score == 27.0  # 5 * 3 + 2 * 1 + 0.5 * 20


def test_retention_runs_past_twelve_months_and_counts_customers_once(spark):
    df = staging.stg_orders(orders(
        spark, order(1, "a", "2022-01-10", 1), order(2, "a", "2022-01-20", 1), order(3, "b", "2022-01-31", 1),
        order(4, "a", "2023-02-01", 1), order(5, "c", "2023-02-01", 1)))
    rows = {(r.cohort_month, r.purchase_month): r for r in marts.customer_retention(df).collect()}
    later = rows[(date(2022, 1, 1), date(2023, 2, 1))]
    assert (later.period_number, later.cohort_size, later.retained_customers) == (13, 2, 1)
    assert later.retention_rate_pct == 50 and later.churned_customers == 1
    assert rows[(date(2023, 2, 1), date(2023, 2, 1))].cohort_size == 1 and len(rows) == 3


def test_growth_after_a_gap_and_from_nothing(spark):
    df = staging.stg_orders(orders(
        spark, order(1, "a", "2023-11-10", 100), order(2, "a", "2024-01-20", 150), order(3, "b", "2024-02-01", 75)))
    rows = marts.revenue_trend(marts.monthly_revenue(df)).orderBy("month_start").collect()
    assert [r.revenue_growth_pct if r.revenue_growth_pct is None else float(r.revenue_growth_pct) for r in rows] == [
        None, 50.0, -50.0]
    assert [float(r.ytd_revenue) for r in rows] == [100, 150, 225]


EVENTS = (
    "event_id string, customer_id string, event_type string, event_timestamp timestamp, device string, "
    "region string, session_id string, product_id string, product_ids array<string>, category string, "
    "categories array<string>, product_name string, price double, total_amount double"
)


def event(i, customer, kind, when, **more):
    names = [f.split()[0] for f in EVENTS.split(", ")]
    base = dict(event_id=f"e{i}", customer_id=customer, event_type=kind, event_timestamp=datetime.fromisoformat(when))
    return tuple({**base, **more}.get(n) for n in names)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


def test_event_model_ratios_without_carts_or_views(spark):
    df = warehouse.raw_events_landing(events(
        spark, event(1, "a", "PURCHASE", "2024-06-30"), event(2, "b", "ADD_TO_CART", "2024-05-01"),
        event(3, "b", "PRODUCT_VIEW", "2024-06-01"), event(4, None, "LOGIN", "2024-06-01")))
    rows = {r.customer_id: r for r in marts.int_customer_events(df, AS_OF).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].cart_abandonment_rate is None and rows["a"].browse_to_buy_ratio == 0
    assert rows["b"].cart_abandonment_rate == 1 and float(rows["b"].daily_engagement_score) == 3.5
    assert (rows["b"].events_last_30d, rows["b"].total_events, rows["b"].active_days) == (1, 2, 2)


def test_gold_customer_view_keeps_customers_without_purchases(spark):
    df = events(
        spark, event(1, "a", "LOGIN", "2024-01-01 23:00:00", device="Tablet", region=None),
        event(2, "a", "LOGIN", "2024-01-02 22:00:00", device="Mobile", region="west"),
        event(3, None, "PURCHASE", "2024-01-02", total_amount=5.0))
    rows = gold.customer_360(df).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.total_events, row.total_purchases, row.total_spend, row.avg_spend) == (2, 0, 0, None)
    assert (row.days_active, row.preferred_device, row.region) == (0, "Mobile", "west")


def test_product_lists_count_for_every_product(spark):
    df = events(
        spark, event(1, "a", "PRODUCT_VIEW", "2024-01-01", product_id="p1", price=2.0),
        event(2, "a", "PURCHASE", "2024-01-01", product_ids=["p1", "p2"], categories=["x", "y"], total_amount=9.0),
        event(3, "a", "PURCHASE", "2024-01-01", product_id="p1", category="x", total_amount=1.0),
        event(4, "a", "ADD_TO_CART", "2024-01-01", product_id="p2"))
    perf = gold.product_performance(df).collect()
    assert [(r.product_id, r.view_count, r.purchase_count, r.cart_count, float(r.total_revenue)) for r in perf] == [
        ("p1", 1, 2, 0, 10.0)]
    by_category = {r.category: (float(r.total_revenue), r.order_count) for r in gold.revenue_by_category(df).collect()}
    assert by_category == {"x": (10.0, 2), "y": (9.0, 1)}
    funnel = {r.product_id: r for r in marts.product_analytics(warehouse.raw_events_landing(df)).collect()}
    assert funnel["p2"].views == 0 and funnel["p2"].view_to_cart_rate is None and funnel["p2"].purchases == 1


def test_gap_sessions_split_only_after_more_than_the_gap(spark):
    start = datetime(2024, 1, 1, 0, 10)
    minutes = [0, 29, 59, 89.5, 89.6, 200]
    df = events(spark, *[event(i, "a", "PURCHASE" if i == 4 else "SEARCH", (start + timedelta(minutes=m)).isoformat())
                         for i, m in enumerate(minutes)], event(9, "b", "SEARCH", "2024-01-01"))
    rows = warehouse.gap_sessions(df).filter("customer_id = 'a'").orderBy("session_start").collect()
    assert [(r.event_count, r.converted, r.session_duration_s) for r in rows] == [
        (3, False, 3540), (2, True, 6), (1, False, 0)]
    sessions = warehouse.gap_sessions(df.repartition(7))
    assert sessions.agg(F.sum("event_count")).first()[0] == 7


def test_calendar_rows(spark):
    days = {r.full_date: r for r in warehouse.dim_time(spark, "2025-01-01", "2027-12-31").collect()}
    assert len(days) == 1095
    sunday = days[date(2025, 6, 1)]
    assert (sunday.month_name, sunday.day_name, sunday.day_of_week, sunday.is_weekend) == ("June", "Sunday", 0, True)
    assert days[date(2027, 1, 1)].week == 53


def test_lookups_keep_unknown_keys(spark):
    df = spark.createDataFrame([("Delhi",), ("Nowhere",), (None,)], "region string")
    out = {r.region: r.region_tier for r in warehouse.enrich_with_reference(
        df, warehouse.region_lookup(spark), "region").collect()}
    assert out == {"Delhi": "metro", "Nowhere": None, None: None}


TARGET = "k int, a string, b string"


def test_upsert_updates_only_the_named_columns_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], TARGET)
    updates = spark.createDataFrame([(2, "A2", None), (3, "A3", "B3")], TARGET)
    once = keyed.upsert(target, updates, ["k"], ["b"])
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a1", "b1"), (2, "a2", None), (3, "A3", "B3")]
    assert sorted(map(tuple, keyed.upsert(once, updates, ["k"], ["b"]).collect())) == sorted(map(tuple, once.collect()))
    everything = keyed.upsert(target, updates, ["k"])
    assert (2, "A2", None) in [tuple(r) for r in everything.collect()]
    partial = keyed.upsert(target, updates.select("k", "a"), ["k"])
    assert (2, "A2", "b2") in [tuple(r) for r in partial.collect()]
    with pytest.raises(ValueError):
        keyed.upsert(target, updates.withColumn("z", F.lit(1)), ["k"])


def test_upsert_never_matches_null_keys(spark):
    target = spark.createDataFrame([(None, "a", "b")], TARGET)
    assert keyed.upsert(target, target, ["k"]).count() == 2


def test_upsert_takes_one_update_per_key_and_adds_null_keys(spark):
    target = spark.createDataFrame([("a", 1, "x"), (None, 2, "x")], "k string, n int, t string")
    updates = spark.createDataFrame([("a", 5, "late"), ("a", 4, "early"), (None, 6, "z"), (None, 6, "z")], target.schema)
    got = sorted((str(r.k), r.n, r.t) for r in keyed.upsert(target, updates, ["k"], order_by=["n"]).collect())
    assert got == [("None", 2, "x"), ("None", 6, "z"), ("None", 6, "z"), ("a", 4, "early")]


def test_orders_feed_their_own_staging(spark):
    from basketry import schemas
    from basketry.plans import staging, warehouse

    ddl = ("event_id string, event_type string, order_id string, customer_id string, event_timestamp timestamp, total_amount double, "
           "discount_amount double, payment_method string, items_count int, region string, device string")
    events = spark.sql("SELECT 'e', 'PURCHASE', 'o', 'c', timestamp'2024-01-01 00:00:00', 10D, 1D, 'upi', 1, 'delhi', 'app'").toDF(
        *[x.split()[0] for x in ddl.split(", ")])
    facts = warehouse.fact_orders(events, "2024-02-01")
    assert facts.schema.simpleString() == schemas.struct(schemas.FACT_ORDERS).simpleString()
    row = staging.stg_orders(facts).first()
    assert (float(row.tax_amount), float(row.net_amount), row.region) == (0.0, 9.0, "Delhi")


def test_insert_ignore_keeps_old_rows_and_the_first_of_a_batch(spark):
    target = spark.createDataFrame([(1, "old", "x")], TARGET)
    rows = spark.createDataFrame([(1, "new", "y"), (2, "late", "9"), (2, "early", "1")], TARGET)
    once = keyed.insert_ignore(target, rows, ["k"], ["b"])
    assert sorted(map(tuple, once.collect())) == [(1, "old", "x"), (2, "early", "1")]
    assert sorted(map(tuple, keyed.insert_ignore(once, rows, ["k"], ["b"]).collect())) == sorted(
        map(tuple, once.collect()))


def test_profiles_hold_the_newest_orders_only(spark):
    fact = orders(spark, *[order(i, "a", f"2024-01-{i:02d}", i) for i in range(1, 15)], order(99, "b", "2024-01-01", 1))
    dims = spark.createDataFrame([("a",), ("b",), ("c",)], "customer_id string").selectExpr(
        "customer_id", "'r' region", "1L total_events", "1L total_purchases", "1 total_spend", "1 avg_spend",
        "timestamp'2024-01-01' last_seen_date")
    scores = spark.createDataFrame([("a", 0.5)], "customer_id string, churn_probability double").selectExpr(
        "*", "'medium_risk' churn_segment", "timestamp'2024-01-01' scored_at")
    wanted = spark.createDataFrame([("a",), ("c",), ("c",)], "customer_id string")
    rows = {r.customer_id: r for r in serving.customer_profile(wanted, dims, fact, scores).collect()}
    assert [o.order_id for o in rows["a"].recent_orders] == [f"o{i}" for i in range(14, 4, -1)]
    assert rows["c"].recent_orders is None and rows["c"].churn_segment is None and "b" not in rows
    plan = serving.customer_profile(wanted, dims, fact, scores)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_only_queries_run(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert serving.run_sql(spark, "WITH t AS (SELECT * FROM three) SELECT count(*) AS n FROM t;").first().n == 3
    for text in ("DROP VIEW three", "INSERT INTO three VALUES (1)", "", "with x as (select 1) insert into y select 1"):
        with pytest.raises(Exception):
            serving.run_sql(spark, text)


def test_kpis_of_empty_tables(spark):
    scores = spark.createDataFrame([], "churn_segment string")
    row = serving.kpi_stats(orders(spark), scores, AS_OF).first()
    assert (row.total_orders, row.total_revenue, row.active_customers, row.high_risk) == (0, 0, 0, 0)
