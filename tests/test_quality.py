"""Rules, suites and table tests on hand-written rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketry.operators import quality

SILVER = (
    "event_id string, customer_id string, event_type string, session_id string, event_timestamp timestamp, "
    "device string, region string, total_amount double, dq_passed boolean"
)
T0 = datetime(2024, 1, 1)


def good(spark):
    return spark.createDataFrame(
        [(f"e{i}", f"C{i}", "LOGIN", "s", T0, "Mobile", "r", 10.0 * i, True) for i in range(3)], SILVER
    )


def bad(spark):
    return spark.createDataFrame(
        [("e1", None, "LOGIN", "s", T0, "Mobile", "r", 5.0, True), ("e1", "C1", "DANCE", "s", T0, "Fridge", "r", -1.0, True)],
        SILVER,
    )


def by_name(results, key="rule_name"):
    return {r[key]: r for r in results.collect()}


def test_suite_passes_and_fails(spark):
    assert len(quality.SILVER_SUITE["expectations"]) == 12
    passing = quality.run_suite(good(spark), quality.SILVER_SUITE)
    summary = quality.suite_summary(passing, "s").first()
    assert (summary.total, summary.passed, summary.success) == (12, 12, True)
    failing = quality.run_suite(bad(spark), quality.SILVER_SUITE)
    failed = {r.position: r.bad_rows for r in failing.collect() if not r.passed}
    assert failed == {1: 1, 8: 1, 9: 1, 10: 1, 11: 1}
    verdict = quality.suite_summary(failing, "s")
    assert not verdict.first().success
    with pytest.raises(quality.SuiteFailed):
        quality.gate(verdict)
    quality.gate(quality.suite_summary(passing, "s"))


def test_suite_without_columns(spark):
    results = by_name(quality.run_suite(good(spark).select("event_id", "event_type"), quality.SILVER_SUITE), "position")
    assert not results[1].passed and not results[5].passed and not results[10].passed
    assert results[2].passed and results[11].passed and not results[7].passed and results[7].bad_rows == 7


def test_in_set_counts_nulls_in_the_suite_but_not_in_the_rules(spark):
    df = good(spark).withColumn("event_type", F.lit(None).cast("string")).withColumn("order_id", F.lit("o"))
    suite = by_name(quality.run_suite(df, quality.SILVER_SUITE), "position")
    assert suite[9].bad_rows == 3
    rules = by_name(quality.run_rules(df, quality.standard_rules("2024-02-01"), "t", "2024-02-01"))
    assert rules["valid_event_types"].failed_records == 0 and rules["no_null_event_type"].failed_records == 3


def test_unique_counts_copies_and_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,)], "event_id string")
    suite = {"expectations": [{"expectation_type": "expect_column_values_to_be_unique",
                               "kwargs": {"column": "event_id"}}]}
    assert quality.run_suite(df, suite).first().bad_rows == 3


def test_between_reads_text_and_allows_outliers(spark):
    df = spark.createDataFrame([("1",), ("2",), ("x",), ("99",), (None,)], "v string")

    def run(mostly):
        suite = quality.load_suite(json.dumps({"expectations": [
            {"expectation_type": "expect_column_values_to_be_between",
             "kwargs": {"column": "v", "min_value": 0, "max_value": 10, "mostly": mostly}}]}))
        return quality.run_suite(df, suite).first()

    assert run(0.6).passed and not run(0.9).passed and run(0.6).bad_rows == 1


def test_rules_on_an_empty_table_and_at_the_threshold(spark):
    empty = quality.run_rules(
        good(spark).limit(0).withColumn("order_id", F.lit("o")), quality.standard_rules("2024-02-01"), "t", "2024-02-01")
    assert all(r.passed and r.failure_rate == 0 and r.total_records == 0 for r in empty.collect())
    df = spark.range(1000)
    at = [quality.Rule("edge", F.col("id") < 1, None, "warning", 0.001),
          quality.Rule("over", F.col("id") < 2, None, "warning", 0.001)]
    got = by_name(quality.run_rules(df, at, "t", "2024-02-01"))
    assert got["edge"].passed and not got["over"].passed
    assert [r.rule_name for r in quality.dq_alerts(quality.run_rules(df, at, "t", "2024-02-01"), 0.001).collect()] == ["over"]
    summary = quality.rule_summary(quality.run_rules(df, at, "t", "2024-02-01")).first()
    assert (summary.total_rules, summary.passed, summary.failed, summary.pass_rate) == (2, 1, 1, 0.5)


def test_all_row_rules_share_one_scan(spark):
    results = quality.run_rules(
        bad(spark).withColumn("order_id", F.lit("o")), quality.standard_rules("2024-02-01"), "t", "2024-02-01")
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2  # one for the nine row rules, one for the repeated keys


def test_table_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert quality.not_null_violations(df, "k").count() == 2
    assert [tuple(r) for r in quality.unique_violations(df, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.accepted_values_violations(df, "v", ["a", "b"]).collect()] == [("c", 2)]
