"""Inverted-file search, the ledger of a stream's keys, and retention from bitmaps."""

import glob
import json
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import ivf, vectors
from basketry.plans import marts, retention
from basketry.session import STATE_ON_DISK
from basketry.sources import readers
from basketry.streaming import layers, ledger
from test_vectors import brute, found, frame

T0 = datetime(2024, 1, 1, 10)


# --- index ----------------------------------------------------------------------------------------------------


def clustered(rows, seed=5, dim=16):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(12, dim))[rng.integers(0, 12, rows)] * 3 + rng.normal(size=(rows, dim))


def test_few_lists_give_the_recall_asked_for(spark, folder):
    points = clustered(3000)
    stored = frame(spark, "vec_id", points).repartition(5)
    asked = stored.filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    ivf.build_index(stored, folder)
    centres, probes = ivf.read_centres(spark, folder)
    assert spark.read.parquet(f"{folder}/lists").count() == 3000 and probes < len(centres) // 2
    row = ivf.recall_of(ivf.search_index(asked, folder), vectors.similarity_topk(asked, stored, 10)).first()
    assert (row.queries, row.neighbours) == (30, 300) and row.recall >= 0.9


def test_hot_lists_are_split_and_all_lists_are_exact(spark, folder):
    points = np.vstack([clustered(200), np.ones((100, 16)), np.zeros((5, 16))])  # a third are copies of one vector
    stored, asked = frame(spark, "vec_id", points).repartition(3), frame(spark, "query_id", points[::20])
    ivf.build_index(stored, folder, lists=8)
    got = ivf.search_index(asked, folder, 7, probes=8, list_rows=9, query_bytes=300, score_cells=40)
    assert found(got) == brute(points[::20], points, 7)


def test_small_scored_parts_make_no_more_cells(spark, folder, monkeypatch):
    points = clustered(400)
    stored, asked = frame(spark, "vec_id", points), frame(spark, "query_id", points[::10])
    ivf.build_index(stored, folder, lists=8)
    sizes, whole = [], ivf.best_in_cells
    monkeypatch.setattr(ivf, "best_in_cells", lambda grid, *rest: sizes.append(grid.count()) or whole(grid, *rest))
    small = dict(list_rows=9, query_bytes=300)
    want = brute(points[::10], points, 7)
    assert found(ivf.search_index(asked, folder, 7, probes=8, **small)) == want
    assert found(ivf.search_index(asked, folder, 7, probes=8, cell_rows=20, cell_bytes=600, **small)) == want
    assert sizes[0] == 400 + 40 * 8 and sizes[1] > sizes[0]


def test_queries_with_too_few_neighbours_are_answered_exactly(spark, folder):
    points = clustered(90)
    ivf.build_index(frame(spark, "vec_id", points), folder, lists=10)
    asked = frame(spark, "query_id", points[:5])
    assert found(ivf.search_index(asked, folder, 60, probes=1)) == brute(points[:5], points, 60)
    assert ivf.search_index(asked, folder, 200).count() == 5 * 90


def test_tables_without_vectors_and_rows_without_ids(spark, folder):
    some = spark.createDataFrame([("a", [1.0, 0.0]), (None, [1.0, 0.0]), ("b", None), ("c", [0.0, 2.0])],
                                 "vec_id string, embedding array<double>")
    ivf.build_index(some, f"{folder}/some")
    ivf.build_index(some.limit(0), f"{folder}/none")
    asked = spark.createDataFrame([("q", [0.0, 1.0]), ("r", None)], "query_id string, embedding array<double>")
    assert [tuple(r) for r in ivf.search_index(asked, f"{folder}/some", 1).collect()] == [("q", "c", 1.0, 1)]
    assert ivf.search_index(asked, f"{folder}/none").count() == 0
    assert ivf.search_index(asked.limit(0), f"{folder}/some").count() == 0


# --- ledger ---------------------------------------------------------------------------------------------------


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "key string")


@pytest.mark.parametrize("few", [0, 100])
def test_known_keys_of_earlier_batches(spark, folder, few):
    names = [f"k{i}" for i in range(40)]
    for batch in range(4):
        ledger.add_keys(keys(spark, [*names[batch * 10 : batch * 10 + 10], None, f"k{batch * 10}"]), folder, batch)
    ledger.add_keys(keys(spark, []), folder, 4)
    ask = lambda asked, before: sorted(r.key for r in ledger.known_keys(keys(spark, asked), folder, before, few).collect())
    assert ask(["k3", "k3", "k12", "k35", "new", None], 5) == ["k12", "k3", "k35"]
    assert ask(["k3", "k12", "k35"], 1) == ["k3"]  # batch 1 run again doesn't find its own keys
    assert ask(["k3"], 0) == [] and ask([], 5) == []
    ledger.add_keys(keys(spark, ["k12"]), folder, 1)  # a repeated batch replaces its folder
    assert ask(["k12", "k13"], 5) == ["k12"]
    assert ledger.compact_ledger(spark, folder, keep=1, at_least=2) == 4
    assert ask(["k3", "k12", "k13", "k35"], 5) == ["k12", "k3", "k35"]


def test_few_keys_reach_the_scan_as_literals(spark, folder):
    ledger.add_keys(keys(spark, ["a", "b", "c"]), folder, 0)
    plan = ledger.known_keys(keys(spark, ["a", "x"]), folder, 1)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(key" in plan and "PartitionFilters: [bucket" in plan


def message(i, **payload):
    return ("k", json.dumps(payload) if payload else "{broken", "product-events", 0, i, T0 + timedelta(minutes=i))


@pytest.mark.parametrize("kept", [False, True])
def test_copies_long_after_the_state_has_gone(spark, folder, kept):
    good = dict(customer_id="c1", event_type="login", timestamp="2024-01-01T10:00:00Z")
    batches = [
        [message(1, event_id="e1", **good), message(2), message(3, **good)],
        [message(4, event_id="e2", **dict(good, customer_id="")), message(5, event_id="e3", **good)],
        [message(6, event_id="e1", **good), message(2), message(7, event_id="e2", **good), message(8, **good)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schemas.MESSAGE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = readers.read_event_stream(spark, f"{folder}/in", kind="files")
        for query in layers.split_sinks(stream, folder, f"{folder}/cp", as_of="2024-02-01", available_now=True,
                                        dedup_delay="1 millisecond", ledger=kept):
            query.awaitTermination()
        time.sleep(0.1)
    silver = sorted(str(r.event_id) for r in spark.read.parquet(f"{folder}/silver").collect())
    dead = sorted(str(r.event_id) for r in spark.read.parquet(f"{folder}/dlq").collect())
    # Without the ledger the copy of e1 and the message sent again count twice; e2 was bad first and is good now.
    again = [] if kept else ["e1"]
    assert silver == ["None", "None", "e1", *again, "e2", "e3"]
    assert dead == ["None"] * (1 if kept else 2) + ["e2"]


def test_state_of_a_ledger_lies_on_disk_and_batches_are_cached_in_small_pieces(spark, folder, monkeypatch):
    pieces, write = [], layers._write_batch
    size = "spark.sql.inMemoryColumnarStorage.batchSize"

    def noted(rows, path, *given):
        if not path.endswith("bronze"):
            pieces.append(int(rows.sparkSession.conf.get(size)))
        write(rows, path, *given)

    monkeypatch.setattr(layers, "_write_batch", noted)
    spark.createDataFrame([message(1, event_id="e1")], schemas.MESSAGE).write.parquet(f"{folder}/in")
    before = [spark.conf.get(n, None) for n in STATE_ON_DISK]
    stream = readers.read_event_stream(spark, f"{folder}/in", kind="files")
    for query in layers.split_sinks(stream, folder, f"{folder}/cp", available_now=True, ledger=True):
        query.awaitTermination()
    assert glob.glob(f"{folder}/cp/checked/state/0/0/*.zip") and not glob.glob(f"{folder}/cp/checked/state/0/0/*.delta")
    assert pieces and max(pieces) <= 1000
    assert [spark.conf.get(n, None) for n in STATE_ON_DISK] == before  # other streams keep their kind of state


# --- bitmaps --------------------------------------------------------------------------------------------------


def orders(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, day string").select("customer_id", F.to_date("day").alias("order_date"))


def number():
    return F.substring("customer_id", 2, 20).try_cast("long")


def test_retention_from_bitmaps_of_several_deliveries(spark):
    rng = np.random.default_rng(3)
    rows = [(f"C{int(c) * 9000}", f"2024-{m:02d}-{d:02d}") for c, m, d in
            zip(rng.integers(0, 30, 300), rng.integers(1, 8, 300), rng.integers(1, 28, 300))]  # customers in several buckets
    rows += [("C7", "2023-11-30")] * 50 + [("C8", "2024-12-01")]
    all_orders = orders(spark, rows)
    parts = [retention.activity_bitmaps(orders(spark, p), number()) for p in (rows[:100], rows[50:], rows[:1])]
    bitmaps = retention.united(parts[0].union(parts[1]).union(parts[2]))
    assert bitmaps.select("bucket").distinct().count() > 3
    got, want = retention.customer_retention(bitmaps), marts.customer_retention(all_orders)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_bitmaps_of_rows_without_a_customer_a_date_or_a_number(spark):
    rows = orders(spark, [(None, "2024-01-01"), ("C1", None), ("C1", "2024-01-05")])
    assert [r.retained_customers for r in retention.customer_retention(retention.activity_bitmaps(rows, number())).collect()] == [1]
    assert retention.customer_retention(retention.activity_bitmaps(rows.limit(0), number())).count() == 0
    with pytest.raises(Exception, match="no number for customer Cx"):
        retention.activity_bitmaps(orders(spark, [("Cx", "2024-01-01")]), number()).collect()
