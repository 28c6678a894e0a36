"""Cleaning of event rows, the same column rules for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import Moment, as_moment, canonical_device, event_calendar, parse_event_time
from basketry.operators.dedup import dedup_batch

UNSIGNED = ("total_amount", "price", "refund_amount")


def _tidy(name: str) -> F.Column:
    return F.upper(F.trim(name))


def parse_payload(messages: DataFrame, schema) -> DataFrame:
    """Broker rows to event rows; broken JSON gives null fields, and where it came from is kept."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("broker_timestamp"),
    ).select("data.*", "topic", "partition", "offset", "broker_timestamp")


def clean_stream(events: DataFrame, processed_at: Moment | None = None) -> DataFrame:
    """Normalised copy of every event; no row is dropped.

    The amount as it arrived stays in ``raw_total_amount`` so that quality flags can see its sign.
    """
    now = F.current_timestamp() if processed_at is None else as_moment(processed_at)
    moment = F.col("event_timestamp")
    return (
        events.withColumns(
            {
                "event_timestamp": parse_event_time(F.col("timestamp")),
                "customer_id": _tidy("customer_id"),
                "event_type": _tidy("event_type"),
                "device": canonical_device(F.col("device")),
                "region": F.initcap(F.trim("region")),
                "raw_total_amount": F.col("total_amount"),
                "total_amount": F.abs("total_amount"),
                "price": F.abs("price"),
                "processing_timestamp": now,
                "processing_date": F.to_date(now),
            }
        )
        .withColumns(event_calendar(moment))
    )


def quality_flags(events: DataFrame, as_of: Moment | None = None) -> DataFrame:
    """Flags per row and the verdict. A future timestamp is flagged but does not fail a row."""
    now = F.current_timestamp() if as_of is None else as_moment(as_of)
    signed = F.col("raw_total_amount" if "raw_total_amount" in events.columns else "total_amount")
    flagged = events.withColumns(
        {
            "dq_missing_customer_id": F.col("customer_id").isNull() | (F.col("customer_id") == ""),
            "dq_missing_event_type": F.col("event_type").isNull(),
            "dq_invalid_timestamp": F.col("event_timestamp").isNull(),
            "dq_negative_amount": F.coalesce(signed < 0, F.lit(False)),
            "dq_future_timestamp": F.coalesce(F.col("event_timestamp") > now, F.lit(False)),
        }
    )
    failed = (
        F.col("dq_missing_customer_id")
        | F.col("dq_missing_event_type")
        | F.col("dq_invalid_timestamp")
        | F.col("dq_negative_amount")
    )
    return flagged.withColumn("dq_passed", ~failed).drop("raw_total_amount")


REQUIRED = ("customer_id", "event_type", "timestamp")


def clean_batch(events: DataFrame, processed_at: Moment) -> DataFrame:
    """Backfill cleaning: incomplete and undated rows out, then one row per event id (the earliest), normalised text,
    unsigned amounts. Times are parsed before copies are compared, so a broken copy never displaces a good one. Rows
    without an id are no copies of each other and stay.
    """
    moment = F.col("event_timestamp")
    complete = events.dropna(subset=list(REQUIRED))
    dated = complete.withColumn("event_timestamp", parse_event_time(F.col("timestamp"))).filter(moment.isNotNull())
    unique = dedup_batch(dated, "event_id", ["event_timestamp", "timestamp"])
    named = {
        "customer_id": _tidy("customer_id"),
        "event_type": _tidy("event_type"),
        "device": canonical_device(F.col("device")),
        "region": F.initcap(F.trim("region")),
    }
    unsigned = {c: F.abs(c) for c in UNSIGNED if c in events.columns}
    return (
        unique.withColumns({**named, **unsigned})
        .withColumns(
            {
                "event_date": F.to_date(moment),
                "event_year": F.year(moment),
                "event_month": F.month(moment),
                "event_hour": F.hour(moment),
                "processing_timestamp": as_moment(processed_at),
                "dq_passed": F.lit(True),
                "dq_issues": F.lit(""),
            }
        )
    )


def cleaning_report(events: DataFrame) -> DataFrame:
    """Rows in, out and removed by reason for ``clean_batch``, from one grouped pass over the input.

    An id none of whose complete rows has a time is undated once, its further rows are copies. Rows without an id count
    one by one.
    """
    complete = F.lit(True)
    for c in REQUIRED:
        complete = complete & F.col(c).isNotNull()
    dated = parse_event_time(F.col("timestamp")).isNotNull()
    per_id = (
        events.withColumn("_complete", complete)
        .groupBy("event_id")
        .agg(
            F.count("*").alias("n"),
            F.count_if("_complete").alias("complete"),
            F.count_if(F.col("_complete") & dated).alias("dated"),
        )
    )
    named, some = F.col("event_id").isNotNull(), F.col("complete") > 0
    kept = F.when(named, (F.col("dated") > 0).cast("long")).otherwise(F.col("dated"))
    undated = F.when(named, (some & (F.col("dated") == 0)).cast("long")).otherwise(F.col("complete") - F.col("dated"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return per_id.agg(
        zero(F.sum("n")).alias("rows_in"),
        zero(F.sum(F.col("n") - F.col("complete"))).alias("incomplete"),
        zero(F.sum(F.when(named, F.greatest(F.col("complete") - 1, F.lit(0))))).alias("copies"),
        zero(F.sum(undated)).alias("undated"),
        zero(F.sum(kept)).alias("rows_out"),
    ).withColumns(
        {"removed": F.col("rows_in") - F.col("rows_out"), "is_empty": F.col("rows_out") == 0}
    )


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Nulls of the named columns replaced; names the table lacks are added with their default."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()}
    )
