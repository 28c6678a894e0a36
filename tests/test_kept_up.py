"""Sessions, sketches, buckets, deliveries, as-of joins and parsed payloads on hand-written rows."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.operators import asof, dedup, sketches
from basketry.plans import features, incremental, staging, warehouse
from basketry.sinks import buckets
from basketry.sources import readers
from basketry.sinks.writers import write_gold
from basketry.streaming import panes, sessions, windows


def event(spark, rows):
    """(id, customer, type, time, product)"""
    full = [(i, c, k, t, "Mobile", "Delhi", p, p and f"Product {p}", None, 2.5 if p != "z" else None) for i, c, k, t, p in rows]
    return spark.createDataFrame(full, "event_id string, customer_id string, event_type string, at string, device string, region string,"
                                 " product_id string, product_name string, category string, price double").withColumn(
        "event_timestamp", F.col("at").cast("timestamp")).drop("at")


def test_a_late_row_joins_two_open_sessions(spark, folder):
    rows = [("e1", "a", "SEARCH", "2024-01-01 10:00:00", None), ("e2", "a", "PURCHASE", "2024-01-01 10:50:00", None),
            ("e3", "b", "SEARCH", "2024-01-01 10:00:00", None), ("e4", "b", "SEARCH", "2024-01-01 10:30:01", None),
            ("e5", None, "SEARCH", "2024-01-01 10:00:00", None)]
    later = [("e6", "a", "PRODUCT_VIEW", "2024-01-01 10:25:00", "p"), ("e7", "c", "SEARCH", "2024-01-02 10:00:00", None)]
    schema = event(spark, rows).schema
    for part in (rows, later):
        event(spark, part).write.mode("append").parquet(f"{folder}/in")
        stream = readers.read_layer_stream(spark, f"{folder}/in", schema)
        sessions.write_sessions(stream, f"{folder}/out", f"{folder}/cp", watermark="2 hours", available_now=True,
                                partitions=2).awaitTermination()
    out = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r.customer_id, str(r.session_start)[11:], r.event_count, r.converted) for r in out) == [
        ("a", "10:00:00", 3, True), ("b", "10:00:00", 1, False), ("b", "10:30:01", 1, False)]
    whole = warehouse.gap_sessions(event(spark, rows + later)).select("customer_id", "session_start", "session_end", "event_count")
    batch = sessions.sessions(event(spark, rows + later)).select(*whole.columns)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, batch.collect()))


def test_sketches_of_a_stream_are_those_of_the_batch(spark, folder):
    rows = [(f"e{k}", f"c{k % 700}", "SEARCH", f"2024-01-01 10:{k % 50:02d}:00", None) for k in range(3000)]
    events = event(spark, rows + [("x", None, "SEARCH", "2024-01-03 00:00:00", None)])
    events.write.parquet(f"{folder}/in")
    stream = readers.read_layer_stream(spark, f"{folder}/in", events.schema)
    made = sketches.distinct_sketches(stream, ["region"], ["customer_id"])
    made.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(
        availableNow=True).start().awaitTermination()
    day = lambda df: sketches.estimated(sketches.united(df, ["region"], ["customer_id"], "day"), ["customer_id"])
    streamed = day(spark.read.parquet(f"{folder}/out")).collect()
    whole = [r for r in day(sketches.distinct_sketches(events, ["region"], ["customer_id"])).collect() if r.window_start.day == 1]
    assert streamed == whole and whole[0].events == 3000 and abs(whole[0].customer_id_count - 700) <= 21


def test_panes_give_the_sliding_windows(spark):
    rows = [("e1", "a", "PRODUCT_VIEW", "2024-01-01 10:01:00", "p"), ("e2", "a", "PRODUCT_VIEW", "2024-01-01 10:20:00", "p"),
            ("e3", "b", "PRODUCT_VIEW", "2024-01-01 10:59:59", "p"), ("e4", "a", "PRODUCT_VIEW", "2024-01-01 12:00:00", "p"),
            ("e5", None, "PRODUCT_VIEW", "2024-01-01 10:05:00", "p"), ("e6", "b", "PRODUCT_VIEW", "2024-01-01 10:00:00", "z"),
            ("e7", "b", "SEARCH", "2024-01-01 10:00:00", "p"), ("e8", "b", "PRODUCT_VIEW", "2024-01-01 23:59:00", None)]
    events = event(spark, rows)
    want = windows.most_viewed_products(events).withColumn("avg_price", F.round("avg_price", 6))
    got = panes.most_viewed_products(events).withColumn("avg_price", F.round("avg_price", 6)).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_an_upsert_leaves_other_buckets_alone(spark, folder):
    path = f"{folder}/t"
    table = spark.range(200).selectExpr("id", "id * 2 AS v", "'old' AS w").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 1L AS v, 'old' AS w"))
    buckets.upsert_buckets(table, path, ["id"], 8)
    before = files(path)
    buckets.upsert_buckets(spark.sql("SELECT 7 AS id, 0 AS v UNION ALL SELECT 7, 5"), path, ["id"], update_cols=["v"])
    after = files(path)
    assert len({os.path.dirname(f) for f in before - after}) == 1 and len(before & after) >= 7
    rows = {r.id: (r.v, r.w) for r in buckets.read_buckets(spark, path).collect()}
    assert len(rows) == 201 and rows[7] == (0, "old") and rows[8] == (16, "old") and rows[None] == (1, "old")
    buckets.upsert_buckets(spark.sql("SELECT 999L AS id, 1L AS v, 'new' AS w UNION ALL SELECT NULL, 2L, 'new'"), path, ["id"])
    assert buckets.read_buckets(spark, path).count() == 203
    assert [r.v for r in buckets.lookup(spark.sql("SELECT 8 AS id UNION ALL SELECT 5000"), path, ["id"]).collect()] == [16]


def order(spark, rows):
    made = spark.createDataFrame([(i, c, d, a) for i, c, d, a in rows], "order_id string, customer_id string, day string, amount int")
    money = F.col("amount").cast("decimal(15,2)")
    return made.select(
        "order_id", "customer_id", F.col("day").cast("timestamp").alias("order_timestamp"), F.col("day").cast("date").alias("order_date"),
        F.year(F.col("day").cast("date")).alias("order_year"), F.month(F.col("day").cast("date")).alias("order_month"),
        money.alias("total_amount"), F.lit(0).cast("decimal(12,2)").alias("discount_amount"), money.alias("net_amount"),
        F.lit("card").alias("payment_method"), F.lit(1).alias("items_count"), F.lit("Delhi").alias("region"), F.lit("Mobile").alias("device"))


def test_deliveries_touch_only_their_months(spark, folder):
    first = [("1", "a", "2024-01-05", 10), ("2", "b", "2024-01-06", 20), ("3", "a", "2024-02-01", 30), ("4", "c", "2024-03-01", 40)]
    assert len(incremental.deliver_orders(order(spark, first), folder, 4)) == 3
    january = files(f"{folder}/orders/month_start=2024-01-01")
    moved = order(spark, [("4", "c", "2024-02-10", 45), ("5", "a", "2024-02-11", 5)])
    for _ in range(2):  # the same delivery twice changes nothing
        incremental.deliver_orders(moved, folder)
        mart = {r.order_month: (r.total_orders, int(r.gross_revenue), r.unique_customers) for r in incremental.monthly_mart(spark, folder).collect()}
        assert mart == {1: (2, 30, 2), 2: (3, 80, 2)}
    assert files(f"{folder}/orders/month_start=2024-01-01") == january


def test_as_of_join_carries_values_over_days(spark):
    left = spark.sql("""SELECT * FROM VALUES (1, 'a', timestamp'2024-01-05 10:00:00'), (2, 'a', timestamp'2024-01-01 09:59:59'),
      (3, 'b', timestamp'2024-01-02 00:00:00'), (4, NULL, timestamp'2024-01-02 00:00:00'), (5, 'a', NULL),
      (6, 'a', timestamp'2024-01-01 10:00:00'), (6, 'a', timestamp'2024-01-01 10:00:00') AS l(n, k, t)""")
    right = spark.sql("""SELECT * FROM VALUES ('a', timestamp'2024-01-01 10:00:00', 1), ('a', timestamp'2024-01-01 10:00:00', 2),
      ('a', timestamp'2024-01-01 12:00:00', NULL), (NULL, timestamp'2024-01-01 00:00:00', 9), ('b', NULL, 9) AS r(k, at, v)""")
    rows = asof.asof_join(left, right, "k", "t", "at", ["at", "v"]).collect()
    got = Counter((r.n, r.at and str(r.at)[11:], r.v) for r in rows)
    assert got == {(1, "12:00:00", None): 1, (2, None, None): 1, (3, None, None): 1, (4, None, None): 1, (5, None, None): 1, (6, "10:00:00", 2): 2}
    assert asof.asof_join(left.limit(0), right, "k", "t", "at", ["v"]).count() == 0
    assert asof.asof_join(left, right.limit(0), "k", "t", "at", ["v"]).count() == 7


def test_features_at_dates_are_those_of_each_date_alone(spark):
    rows = [(f"e{k}", f"c{k % 3}", ["LOGIN", "PRODUCT_VIEW", "ADD_TO_CART"][k % 3 - k % 2], f"2024-01-{k % 27 + 1:02d} 05:00:00", None) for k in range(80)]
    events = event(spark, rows)
    orders = spark.sql("""SELECT * FROM VALUES ('o1', 'c0', timestamp'2024-01-03 00:00:00', 10.00BD), ('o2', 'c0', timestamp'2024-01-09 01:00:00', 7.00BD),
      ('o3', 'c9', timestamp'2024-01-20 00:00:00', 5.00BD), ('o4', 'c1', timestamp'2024-01-02 00:00:00', 0.00BD) AS o(order_id, customer_id, event_timestamp, total_amount)""")
    dates = ["2024-01-20", "2024-01-03", "2024-01-10", "2024-02-01"]
    got = features.features_at(orders, events, dates)
    for day in dates:
        past = F.col("event_timestamp") < F.lit(day).cast("timestamp")
        rfm, behaviour = features.rfm_features(orders.filter(past), day), features.behavioral_features(events.filter(past), day)
        own = got.filter(F.col("snapshot_date") == day)
        for part, zero in ((rfm, "frequency"), (behaviour, None)):
            names = [c for c in part.columns if c not in ("avg_purchase_value",)]
            mine = own.filter(F.col(zero) > 0) if zero else own.join(behaviour.select("customer_id"), "customer_id", "left_semi")
            assert Counter(map(tuple, mine.select(*names).collect())) == Counter(map(tuple, part.select(*names).collect()))


def test_payloads_keep_unknown_fields_and_mark_broken_ones(spark, folder):
    rows = [("e1", "a", "LOGIN", '{"device":" mobile","region":"west bengal","extra":{"deep":[1,2]},"session_id":7}'),
            ("e2", "a", "LOGIN", "{broken"), ("e3", "a", "LOGIN", None)]
    raw = spark.createDataFrame(rows, "event_id string, customer_id string, event_type string, payload string").selectExpr(
        "*", "'t' AS kafka_topic", "timestamp'2024-01-01 00:00:00' AS event_timestamp", "timestamp'2024-01-01 00:00:00' AS ingested_at")
    staging.with_variant(raw).write.parquet(f"{folder}/raw")
    staged = staging.stg_events_variant(spark.read.parquet(f"{folder}/raw"), "2024-02-01", "2024-01-01")
    out = {r.event_id: r for r in staged.withColumn("deep", F.try_variant_get("fields", "$.extra.deep[1]", "int")).drop("fields").collect()}
    assert (out["e1"].device, out["e1"].region, out["e1"].session_id, out["e1"].deep) == ("Mobile", "West Bengal", "7", 2)
    assert [out[k].payload_broken for k in ("e1", "e2", "e3")] == [False, True, False] and out["e2"].device is None


def test_most_frequent_values(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 'x', 1), ('a', 'y', 1), ('a', 'y', 2), ('a', NULL, 2), ('b', NULL, 3), ('c', NULL, NULL) AS t(k, v, w)")
    got = {r.k: (r.v1, r.w1) for r in features.most_frequent(rows, "k", {"v": "v1", "w": "w1"}).collect()}
    assert got == {"a": ("y", "1"), "b": (None, "3")}


@pytest.mark.parametrize("most", [0, 100])
def test_copies_are_found_by_hash_or_by_row(spark, most):
    rows = spark.sql("""SELECT * FROM VALUES ('a', 2, 'x'), ('a', 1, 'y'), ('b', 1, 'z'), (NULL, 1, 'n'), (NULL, 1, 'n'), ('c', NULL, 'u'),
      ('c', 9, 'v') AS t(event_id, event_timestamp, w)""")
    kept = dedup.dedup_batch(rows, most=most)
    assert Counter(map(tuple, kept.collect())) == {("a", 1, "y"): 1, ("b", 1, "z"): 1, (None, 1, "n"): 2, ("c", 9, "v"): 1}


def test_an_unfinished_run_is_not_the_newest(spark, folder):
    df = spark.range(2)
    for day in ("2024-01-01", "2024-01-02"):
        write_gold(df, folder, day)
    assert str(readers.read_latest_snapshot(spark, folder).first().run_date) == "2024-01-02"
    os.remove(f"{folder}/_finished/run_date=2024-01-02")
    assert str(readers.read_latest_snapshot(spark, folder).first().run_date) == "2024-01-01"
