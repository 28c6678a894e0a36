"""Data-quality rules, expectation suites and table tests.

All row rules of a table are counted in one aggregate, whatever their number. Rules about sets of rows (repeated
keys) bring a grouped aggregate of their own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions import Moment, as_moment
from basketry.operators.dedup import duplicate_row_count
from basketry.vocabulary import EVENT_TYPES, SILVER_DEVICES


@dataclass(frozen=True)
class Rule:
    """``failing`` marks bad rows; ``set_check`` instead maps a table to (total_records, failed_records)."""

    name: str
    failing: Column | None = None
    set_check: Callable[[DataFrame], DataFrame] | None = None
    severity: str = "error"
    threshold: float = 0.0


def standard_rules(as_of: Moment) -> list[Rule]:
    """The rules of the cleaned events. Names, severities and tolerances."""
    kind, amount, customer = F.col("event_type"), F.col("total_amount"), F.col("customer_id")
    bought = kind == "PURCHASE"
    return [
        Rule("no_null_customer_id", customer.isNull()),
        Rule("no_null_event_type", kind.isNull()),
        Rule("no_null_timestamp", F.col("event_timestamp").isNull()),
        Rule("valid_event_types", ~kind.isin(EVENT_TYPES)),
        Rule("no_negative_amounts", amount < 0),
        Rule("no_future_timestamps", F.col("event_timestamp") > as_moment(as_of), None, "warning", 0.001),
        Rule("duplicate_events", None, duplicate_row_count, "warning"),
        Rule("valid_customer_id_format", ~customer.rlike(r"^C\d+$"), None, "warning", 0.001),
        Rule("purchase_has_order_id", bought & F.col("order_id").isNull()),
        Rule("purchase_has_amount", bought & (amount.isNull() | (amount <= 0))),
    ]


def run_rules(df: DataFrame, rules: Sequence[Rule], table: str, as_of: Moment) -> DataFrame:
    """One result row per rule."""
    by_row = [r for r in rules if r.failing is not None]
    parts = []
    if by_row:
        counted = df.agg(
            F.count("*").alias("total_records"), *[F.count_if(r.failing).alias(f"f{i}") for i, r in enumerate(by_row)]
        )
        rows = F.array(
            *[F.struct(F.lit(r.name).alias("rule_name"), F.col(f"f{i}").alias("failed_records"))
              for i, r in enumerate(by_row)]
        )
        parts.append(counted.select("total_records", F.inline(rows)))
    for rule in rules:
        if rule.set_check is not None:
            parts.append(
                rule.set_check(df).select(
                    "total_records", F.lit(rule.name).alias("rule_name"), "failed_records"
                )
            )
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    severity, limit = F, F
    for r in rules:
        severity = severity.when(F.col("rule_name") == r.name, r.severity)
        limit = limit.when(F.col("rule_name") == r.name, F.lit(float(r.threshold)))
    rate = F.coalesce(F.try_divide("failed_records", "total_records"), F.lit(0.0))
    return results.select(
        "rule_name",
        F.lit(table).alias("table_name"),
        "total_records",
        "failed_records",
        F.round(rate, 6).alias("failure_rate"),
        (rate <= limit).alias("passed"),
        severity.alias("severity"),
        as_moment(as_of).alias("checked_at"),
    )


def rule_summary(results: DataFrame) -> DataFrame:
    passed, total = F.count_if("passed"), F.count("*")
    return results.agg(
        total.alias("total_rules"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.coalesce(F.try_divide(passed, total), F.lit(0.0)).alias("pass_rate"),
    )


def load_suite(text: str) -> dict:
    """A suite from its JSON text."""
    suite = json.loads(text)
    if not isinstance(suite.get("expectations"), list):
        raise ValueError("a suite needs a list of expectations")
    return suite


#: The silver expectation suite; its fixed values are in the file.
SILVER_SUITE = load_suite((Path(__file__).parents[1] / "silver_suite.json").read_text(encoding="utf-8"))


def _expectation(exp: dict, columns: list[str]) -> tuple[dict[str, Column], Callable[[dict[str, Column]], tuple]]:
    """Aggregates an expectation needs, and how to get (bad rows, passed) from their results."""
    kind, args = exp["expectation_type"], exp.get("kwargs", {})
    name = args.get("column")
    never, fine = (F.lit(0), F.lit(False)), (F.lit(0), F.lit(True))
    here = name in columns
    if kind == "expect_column_to_exist":
        return {}, lambda _: fine if here else never
    if kind == "expect_table_columns_to_match_set":
        absent = [c for c in args.get("column_set", []) if c not in columns]
        extra = [c for c in columns if c not in args["column_set"]] if args.get("exact_match") else []
        return {}, lambda _: (F.lit(len(absent) + len(extra)), F.lit(not absent and not extra))
    if kind == "expect_table_row_count_to_be_between":
        low, high = args.get("min_value", 0), args.get("max_value")
        inside = lambda n: (n >= low) & (F.lit(True) if high is None else n <= high)
        return {}, lambda got: (F.lit(0), inside(got["rows"]))
    if kind == "expect_column_values_to_be_between":
        if not here:
            return {}, lambda _: fine
        number = F.col(name).try_cast("double")
        number = F.when(~F.isnan(number), number)
        outside = F.lit(False)
        if args.get("min_value") is not None:
            outside = outside | (number < args["min_value"])
        if args.get("max_value") is not None:
            outside = outside | (number > args["max_value"])
        share = 1 - args.get("mostly", 1.0)
        rate = lambda got: F.coalesce(F.try_divide(got["bad"], got["seen"]), F.lit(0.0))
        return {"bad": F.count_if(outside), "seen": F.count(number)}, lambda got: (
            got["bad"], rate(got) <= F.lit(share)
        )
    if not here:
        return {}, lambda _: never
    value = F.col(name)
    if kind == "expect_column_values_to_not_be_null":
        return {"bad": F.count_if(value.isNull())}, lambda got: (got["bad"], got["bad"] == 0)
    if kind == "expect_column_values_to_be_in_set":
        invalid = F.coalesce(~value.isin(args["value_set"]), F.lit(True))
        return {"bad": F.count_if(invalid)}, lambda got: (got["bad"], got["bad"] == 0)
    raise ValueError(f"unknown expectation {kind}")


def _copies(df: DataFrame, name: str) -> DataFrame:
    """Rows beyond the first of each value; nulls are copies of each other."""
    return df.groupBy(name).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("bad"))


def run_suite(df: DataFrame, suite: dict) -> DataFrame:
    """One row per expectation: position, type, column, severity, bad rows and verdict."""
    columns = df.columns
    aggregates, plans, unique = {}, [], []
    for i, exp in enumerate(suite["expectations"], 1):
        meta, args = exp.get("meta", {}), exp.get("kwargs", {})
        head = [
            F.lit(i).alias("position"),
            F.lit(exp["expectation_type"]).alias("expectation"),
            F.lit(args.get("column")).cast("string").alias("column_name"),
            F.lit(meta.get("severity", "info")).alias("severity"),
        ]
        if exp["expectation_type"] == "expect_column_values_to_be_unique" and args["column"] in columns:
            bad = F.col("bad")
            unique.append(_copies(df, args["column"]).select(
                *head, bad.cast("bigint").alias("bad_rows"), (bad == 0).alias("passed")))
            continue
        if exp["expectation_type"] == "expect_column_values_to_be_unique":
            needs, verdict = {}, lambda _: (F.lit(0), F.lit(False))
        else:
            needs, verdict = _expectation(exp, columns)
        got = {key: F.col(f"e{i}_{key}") for key in needs}
        aggregates.update({f"e{i}_{key}": agg for key, agg in needs.items()})
        bad, passed = verdict({**got, "rows": F.col("rows")})
        plans.append(F.struct(*head, bad.cast("bigint").alias("bad_rows"), passed.alias("passed")))
    parts = list(unique)
    if plans:
        counted = df.agg(F.count("*").alias("rows"), *[agg.alias(name) for name, agg in aggregates.items()])
        parts.insert(0, counted.select(F.inline(F.array(*plans))))
    if not parts:
        raise ValueError("a suite needs at least one expectation")
    results = parts[0]
    for part in parts[1:]:
        results = results.unionByName(part)
    return results


def suite_summary(results: DataFrame, name: str) -> DataFrame:
    """Totals and overall success: every critical expectation holds."""
    passed, total = F.count_if("passed"), F.count("*")
    return results.agg(
        F.lit(name).alias("suite"),
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.coalesce(F.try_divide(passed, total), F.lit(0.0)).alias("pass_rate"),
        (F.count_if((F.col("severity") == "critical") & ~F.col("passed")) == 0).alias("success"),
    )


class SuiteFailed(RuntimeError):
    """A critical expectation does not hold."""


def gate(summary: DataFrame) -> None:
    """Raise unless the (one-row) summary reports success."""
    row = summary.first()
    if not row["success"]:
        raise SuiteFailed(f"{row['failed']} of {row['total']} expectations failed in {row['suite']}")


# --- table tests: each gives the violating rows or values -----------------------------------------------------


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_violations(df: DataFrame, *columns: str) -> DataFrame:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    counted = df.filter(present).groupBy(*columns).agg(F.count("*").alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def accepted_values_violations(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    counted = df.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))
    return counted.filter(~F.col("value_field").isin(list(values)))


def orders_without_positive_amount(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("total_amount") <= 0).select("order_id", "customer_id", "total_amount")


def revenue_rows_with_nulls(monthly: DataFrame) -> DataFrame:
    keys = ["order_year", "order_month", "region", "gross_revenue"]
    bad = F.lit(False)
    for c in keys:
        bad = bad | F.col(c).isNull()
    return monthly.filter(bad).select(*keys)


def scores_out_of_range(ltv: DataFrame) -> DataFrame:
    return ltv.filter((F.col("ltv_score") < 0) | (F.col("ltv_score") > 100))


def negative_revenue(monthly: DataFrame) -> DataFrame:
    return monthly.filter(F.col("gross_revenue") < 0)


def bad_rows(failing: Column) -> Column:
    """How many rows fail, as an aggregate for ``table_tests``."""
    return F.count_if(failing)


def bad_values(column: str, values: Sequence[str]) -> Column:
    """How many distinct values are not among ``values``, as an aggregate for ``table_tests``."""
    return F.count_distinct(F.when(~F.col(column).isin(list(values)), F.col(column)))


def table_tests(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """One row per test with the number of violations, all from one pass over the table."""
    counted = df.agg(*[count.cast("bigint").alias(f"t{i}") for i, count in enumerate(tests.values())])
    rows = F.array(*[F.struct(F.lit(name).alias("test"), F.col(f"t{i}").alias("violations")) for i, name in enumerate(tests)])
    return counted.select(F.inline(rows)).withColumn("passed", F.col("violations") == 0)


def violation_counts(tests: dict[str, DataFrame]) -> DataFrame:
    """One row per test with the number of violations, for tests that need a plan of their own."""
    counted = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("test"), "violations")
               for name, df in tests.items()]
    results = counted[0]
    for part in counted[1:]:
        results = results.unionByName(part)
    return results.withColumn("passed", F.col("violations") == 0)


def dq_alerts(results: DataFrame, rate: float = 0.01) -> DataFrame:
    return results.filter(F.col("failure_rate") > rate)
