"""Streams against batch, late rows, layers, sources and sinks."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators.dedup import dedup_stream
from basketry.sinks import writers
from basketry.sources import readers
from basketry.streaming import layers, windows

EVENTS = (
    "event_id string, customer_id string, event_type string, event_timestamp timestamp, device string, "
    "region string, country string, session_id string, product_id string, product_name string, category string, "
    "price double, order_id string, total_amount double"
)
T0 = datetime(2024, 1, 1, 10)


def event(i, minutes, kind="PURCHASE", customer="a", **more):
    base = dict(event_id=f"e{i}", customer_id=customer, event_type=kind, event_timestamp=T0 + timedelta(minutes=minutes),
                device="Mobile", region="r", country="c", session_id="s1", order_id=f"o{i}", total_amount=10.0)
    names = [f.split()[0] for f in EVENTS.split(", ")]
    return tuple({**base, **more}.get(n) for n in names)


def drop(spark, folder, *rows):
    spark.createDataFrame(list(rows), EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def advance(spark, folder, name, metric):
    stream = readers.read_layer_stream(spark, f"{folder}/in", EVENTS, max_files=1)
    for query in windows.run_aggregations(stream, f"{folder}/out", f"{folder}/cp", available_now=True,
                                          metrics={name: metric}):
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out/{name}")


def test_late_rows_are_dropped_and_rows_in_time_count(spark, folder):
    drop(spark, folder, event(1, 0), event(2, 59.99))
    advance(spark, folder, "revenue_per_hour", windows.revenue_per_hour)
    drop(spark, folder, event(3, 60), event(4, 100), event(5, 30))
    advance(spark, folder, "revenue_per_hour", windows.revenue_per_hour)
    drop(spark, folder, event(6, 300))
    advance(spark, folder, "revenue_per_hour", windows.revenue_per_hour)
    drop(spark, folder, event(7, 10), event(8, 400))
    out = advance(spark, folder, "revenue_per_hour", windows.revenue_per_hour)
    got = {r.window_start: (r.order_count, float(r.total_revenue)) for r in out.collect()}
    assert got == {T0: (3, 30.0), T0 + timedelta(hours=1): (2, 20.0)}


def test_stream_counts_users_and_sessions_once(spark, folder):
    rows = [event(1, 0), event(2, 1), event(3, 2, customer="b"), event(4, 3, customer="b", session_id="s2"),
            event(5, 4, customer=None, session_id=None), event(6, 5)]
    drop(spark, folder, *rows, event(9, 500))
    out = advance(spark, folder, "active_users", windows.active_users).orderBy("window_start").collect()
    assert [(r.active_users, r.total_events, r.active_sessions) for r in out] == [(2, 5, 2), (1, 1, 1)]
    batch = windows.active_users(spark.createDataFrame(rows, EVENTS)).orderBy("window_start").collect()
    assert [(r.active_users, r.total_events, r.active_sessions) for r in batch] == [(2, 5, 2), (1, 1, 1)]


def test_sliding_windows_and_zero_views(spark):
    view = dict(kind="PRODUCT_VIEW", product_id="p", product_name="P", category="x", price=3.0)
    df = spark.createDataFrame([event(1, 0, **view), event(2, 15, **view, customer="b")], EVENTS)
    rows = windows.most_viewed_products(df).orderBy("window_start").collect()
    assert [(r.view_count, r.unique_viewers) for r in rows] == [(1, 1), (2, 2), (2, 2), (2, 2), (1, 1)]
    only_carts = spark.createDataFrame([event(1, 0, kind="ADD_TO_CART")], EVENTS)
    row = windows.conversion_rate(only_carts).first()
    assert (row.view_to_cart_rate, row.cart_to_purchase_rate, row.overall_conversion_rate) == (0, 0, 0)


@pytest.mark.parametrize("shares", [1, 3])
def test_dedup_stream_across_batches(spark, folder, shares):
    spread = F.pmod(F.minute("event_timestamp"), F.lit(shares)) if shares > 1 else None

    def run():
        stream = readers.read_layer_stream(spark, f"{folder}/in", EVENTS, max_files=1)
        dedup_stream(stream, delay="1 hour", spread=spread).writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination()

    drop(spark, folder, event(1, 0), event(1, 0), event(2, 1))
    run()
    drop(spark, folder, event(1, 10), event(3, 5))
    run()
    ids = sorted(r.event_id for r in spark.read.parquet(f"{folder}/out").collect())
    assert ids == ["e1", "e2", "e3"]


def message(i, at, **payload):
    return ("k", json.dumps(payload) if payload else "{broken", "product-events", 0, i, T0 + timedelta(minutes=at))


def test_layers_keep_every_message_and_split_good_from_bad(spark, folder):
    good = dict(event_id="e1", customer_id=" c1", event_type="login", timestamp="2024-01-01T10:00:00Z")
    rows = [message(1, 0, **good), message(2, 1, **good), message(3, 2),
            message(4, 3, **dict(good, event_id="e2", timestamp="2999-01-01T00:00:00")),
            message(5, 4, **dict(good, event_id="e3", customer_id="")),
            message(6, 5, **dict(good, event_id="e4", total_amount=-4.0, event_type="purchase"))]
    spark.createDataFrame(rows, schemas.MESSAGE).coalesce(1).write.parquet(f"{folder}/in")

    def run():
        stream = readers.read_event_stream(spark, f"{folder}/in", kind="files", max_files=1)
        for query in layers.split_sinks(stream, folder, f"{folder}/cp", as_of="2024-02-01", available_now=True):
            query.awaitTermination()

    run()
    run()
    assert spark.read.parquet(f"{folder}/bronze").count() == 6
    silver = {r.event_id: r for r in spark.read.parquet(f"{folder}/silver").collect()}
    assert set(silver) == {"e1", "e2"} and silver["e2"].dq_future_timestamp and silver["e1"].customer_id == "C1"
    dead = sorted(str(r.event_id) for r in spark.read.parquet(f"{folder}/dlq").collect())
    assert dead == ["None", "e3", "e4"]


def test_single_sinks(spark, folder):
    df = spark.createDataFrame([message(1, 0, event_id="e1", customer_id="c", event_type="login",
                                        timestamp="2024-01-01T10:00:00"), message(2, 0)], schemas.MESSAGE)
    df.coalesce(1).write.parquet(f"{folder}/in")
    from basketry.operators.cleaning import parse_payload

    parsed = parse_payload(readers.read_event_stream(spark, f"{folder}/in", kind="files"), schemas.PAYLOAD)
    flagged = layers.silver_rows(parsed, "2024-02-01")
    for query in (
        layers.write_bronze(parsed, f"{folder}/b", f"{folder}/cb", by_hour=True, available_now=True),
        layers.write_silver(flagged, f"{folder}/s", f"{folder}/cs", available_now=True),
        layers.write_dlq(flagged, f"{folder}/d", f"{folder}/cd", available_now=True),
    ):
        query.awaitTermination()
    assert spark.read.parquet(f"{folder}/b").count() == 2
    assert spark.read.parquet(f"{folder}/s").first().event_type == "LOGIN"
    assert spark.read.parquet(f"{folder}/d").count() == 1


def test_snapshots_replace_their_own_date_only(spark, folder):
    for day, n in (("2024-01-01", 3), ("2024-01-02", 5), ("2024-01-02", 4)):
        writers.write_gold(spark.range(n), f"{folder}/g", day)
    assert spark.read.parquet(f"{folder}/g").count() == 7
    latest = readers.read_latest_snapshot(spark, f"{folder}/g")
    assert latest.count() == 4 and str(latest.first().run_date) == "2024-01-02"


def test_records_of_quality_and_runs(spark, folder):
    from basketry.operators.quality import Rule, run_rules

    results = run_rules(spark.range(10), [Rule("small", F.col("id") < 1)], "t", "2024-01-01")
    writers.append_dq_results(results, f"{folder}/dq")
    writers.append_dq_results(results, f"{folder}/dq")
    stored = spark.read.parquet(f"{folder}/dq")
    assert stored.count() == 2 and float(stored.first().failure_rate) == 0.1 and not stored.first().passed
    row = writers.run_log_row(spark.range(7), "d", "r", "t", "2024-01-01 00:00:00", "2024-01-01 00:01:00")
    writers.append_run_log(row, f"{folder}/log")
    logged = spark.read.parquet(f"{folder}/log").first()
    assert (logged.records_processed, logged.duration_seconds, logged.error_message) == (7, 60, None)


def test_ticket_file_and_tables(spark, folder):
    tickets = [dict(ticket_id="T1", customer_id="C1", issue_text="a\nb", status="Open", created_at="x")] * 2
    with open(f"{folder}/t.json", "w") as f:
        json.dump(tickets, f, indent=2)
    assert readers.read_json_array(spark, f"{folder}/t.json").count() == 2
    writers.materialize(spark.range(3), "a_view", "view")
    assert readers.read_table(spark, "a_view").count() == 3


def test_partition_upsert_leaves_other_partitions_alone(spark, folder):
    import os

    path = f"{folder}/store"
    ddl = "customer_id string, snapshot_date date, recency int, extra int"

    def rows(*data):
        return spark.createDataFrame([(c, datetime.fromisoformat(d).date(), r, e) for c, d, r, e in data], ddl)

    rows(("a", "2024-01-01", 1, 1), ("a", "2024-01-02", 2, 2), ("b", "2024-01-02", 3, 3)).write.partitionBy(
        "snapshot_date").parquet(path)
    untouched = sorted(os.listdir(f"{path}/snapshot_date=2024-01-01"))
    updates = rows(("a", "2024-01-02", 9, 9), ("c", "2024-01-02", 5, 5), ("d", "2024-01-03", 6, 6))
    keys = ["customer_id", "snapshot_date"]
    for _ in range(3):
        writers.upsert_partitions(updates, path, keys, "snapshot_date", ["recency"])
        got = sorted((r.customer_id, str(r.snapshot_date), r.recency, r.extra) for r in spark.read.parquet(path).collect())
        assert got == [("a", "2024-01-01", 1, 1), ("a", "2024-01-02", 9, 2), ("b", "2024-01-02", 3, 3),
                       ("c", "2024-01-02", 5, 5), ("d", "2024-01-03", 6, 6)]
        assert sorted(os.listdir(f"{path}/snapshot_date=2024-01-01")) == untouched


def test_partition_upsert_keeps_rows_of_the_null_partition(spark, folder):
    ddl, path = "id int, part string, v int", f"{folder}/store"
    spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, None, 3), (4, "b", 4)], ddl).write.partitionBy("part").parquet(path)
    updates = spark.createDataFrame([(1, "a", 7), (9, None, 9)], ddl)
    writers.upsert_partitions(updates, path, ["id", "part"], "part")
    got = sorted((r.id, str(r.part), r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", 7), (2, "None", 2), (3, "None", 3), (4, "b", 4), (9, "None", 9)]
    writers.upsert_partitions(updates.filter("part = 'a'"), path, ["id", "part"], "part")
    assert spark.read.parquet(path).count() == 5


def test_stored_tables_switch_versions(spark, folder):
    import os

    from basketry.sinks import versions

    path, ddl = f"{folder}/scores", "k string, v int"
    make = lambda *rows: spark.createDataFrame(list(rows), ddl)
    with pytest.raises(ValueError):
        versions.read_current(spark, path)
    versions.upsert_stored(make(("a", 1), ("b", 2)), path, ["k"])
    for _ in range(2):
        versions.upsert_stored(make(("b", 5), ("c", 3)), path, ["k"])
    assert sorted(map(tuple, versions.read_current(spark, path).collect())) == [("a", 1), ("b", 5), ("c", 3)]
    versions.insert_ignore_stored(make(("c", 9), ("d", 4), ("d", 6)), path, ["k"], ["v"])
    assert sorted(map(tuple, versions.read_current(spark, path).collect())) == [("a", 1), ("b", 5), ("c", 3), ("d", 4)]
    assert sorted(x for x in os.listdir(path) if x.startswith("v=")) == ["v=3", "v=4"]
    os.makedirs(f"{path}/v=9")  # a write that failed
    assert versions.read_current(spark, path).count() == 4


def test_nothing_vanishes_between_bronze_and_the_other_layers(spark, folder):
    good = dict(customer_id="c1", event_type="login", timestamp="2024-01-01T10:00:00Z")
    batches = [
        [message(1, 60 * 72, event_id="e1", **good), message(2, 60 * 72)],
        [message(10 + k, 0) for k in range(5)] + [message(20 + k, 1, **good) for k in range(4)],
        [message(30, 2, event_id="e2", **dict(good, customer_id="")), message(31, 3, event_id="e2", **good)],
        [message(40, -60 * 100, event_id="e3", **good), message(41, 4, event_id="e1", **good), message(42, 5, event_id="e2", **good)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schemas.MESSAGE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = readers.read_event_stream(spark, f"{folder}/in", kind="files", max_files=1)
        for query in layers.split_sinks(stream, folder, f"{folder}/cp", as_of="2024-02-01", available_now=True):
            query.awaitTermination()
    assert spark.read.parquet(f"{folder}/bronze").count() == 16
    silver = sorted(str(r.event_id) for r in spark.read.parquet(f"{folder}/silver").collect())
    assert silver == ["None"] * 4 + ["e1", "e2", "e3"]
    dead = sorted(str(r.event_id) for r in spark.read.parquet(f"{folder}/dlq").collect())
    assert dead == ["None"] * 6 + ["e2"]


def test_compaction_bounds_files_and_loses_nothing(spark, folder):
    import os

    from basketry.streaming.compaction import compact, live_batches

    path, parts = f"{folder}/silver", ["event_type", "day"]
    for batch in range(20):
        rows = spark.range(6).selectExpr(f"id + {batch * 6} AS n", "concat('T', id % 2) AS event_type", "id % 3 AS day")
        layers._write_batch(rows.coalesce(1), path, batch, parts)
    rows_of = lambda df: sorted(tuple(r) for r in df.select("n", "event_type", F.col("day").cast("int")).collect())
    read = lambda: rows_of(readers.read_layer(spark, path))
    count = lambda: sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)
    before, files, at_work = read(), count(), readers.read_layer(spark, path)
    assert compact(spark, path, parts, keep=2) == 18
    # a reader that began before can finish, the next one reads the merged folder
    assert rows_of(at_work) == read() == before and live_batches(spark, path) == ["batch=0-17", "batch=18", "batch=19"]
    assert compact(spark, path, parts, keep=2) == 0
    assert read() == before and count() <= files // 5
    # broken off before the merged rows got their name: the next run removes them
    os.makedirs(f"{path}/_merged-18-40")
    for batch in range(20, 32):
        layers._write_batch(spark.range(3).selectExpr("id + 500 AS n", "'T0' AS event_type", "1L AS day"), path, batch, parts)
    assert compact(spark, path, parts, keep=2) == 12 and live_batches(spark, path)[:2] == ["batch=0-17", "batch=18-29"]
    assert compact(spark, path, parts, keep=2, at_least=2) == 2 and live_batches(spark, path)[0] == "batch=0-29"
    assert not os.path.exists(f"{path}/_merged-18-40") and len(read()) == len(before) + 36


def test_intermediate_folders_can_be_dropped(spark):
    import os

    from basketry import session

    path = session.shared_path(spark, "kept")
    spark.range(3).write.parquet(path)
    place = path.removeprefix("file://")
    assert os.path.isdir(place) and session.drop_intermediates(spark) >= 1
    assert not os.path.exists(place) and session.drop_intermediates(spark) == 0


def test_console_shows_batches(spark, folder, capfd):
    spark.range(3).write.parquet(f"{folder}/in")
    query = layers.write_console(spark.readStream.schema("id long").parquet(f"{folder}/in"))
    try:
        query.processAllAvailable()
        assert query.lastProgress["numInputRows"] in (0, 3) and query.isActive
    finally:
        query.stop()


def test_events_of_one_file_are_dealt_to_all_tasks(spark, folder):
    from basketry import testbed as tb

    rows = spark.range(600, numPartitions=1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 10:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type",
        "1.5D AS value", "'{\"k\": 3}' AS props")
    rows.write.parquet(f"{folder}/events.parquet")
    dealt = tb.events(spark, folder, 6)
    counts = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert [r["count"] for r in counts] == [100] * 6
    plain = tb.events(spark, folder)
    assert plain.exceptAll(dealt).isEmpty() and dealt.count() == 600
    stream = tb.event_stream(spark, folder, 6).groupBy(F.spark_partition_id().alias("task")).count()
    query = stream.writeStream.format("memory").queryName("dealt").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["count"] for r in spark.table("dealt").collect()) == [100] * 6


def test_state_has_a_partition_for_every_core_unless_set():
    from types import SimpleNamespace

    from catalog.stream_queries import state_size

    def on(cores, **conf):
        context = SimpleNamespace(defaultParallelism=cores)
        settings = SimpleNamespace(get=lambda name, other: conf.get("partitions", other))
        return state_size(SimpleNamespace(conf=settings, sparkContext=context), "")

    assert (on(12), on(2), on(12, partitions="5")) == (12, 8, 5)
