"""Sessions by inactivity as a stream: state per open session, written once it can't grow any more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.plans.warehouse import finish_sessions, session_aggregates
from basketry.session import state_partitions


def sessions(events: DataFrame, gap_seconds: int = 1800, watermark: str = "1 hour") -> DataFrame:
    """Sessions of a batch or a stream; a new one starts after more than ``gap_seconds`` without an event.

    Rows may come in any order within ``watermark``: a row that lies between two open sessions joins them. In a stream a
    session is final, and comes out, when the watermark has passed its last event by the gap. Rows without a customer or
    a time belong to no session. The session id is the customer and the first moment, which no later row can change.
    """
    named = events.filter(F.col("customer_id").isNotNull() & F.col("event_timestamp").isNotNull())
    if named.isStreaming:
        named = named.withWatermark("event_timestamp", watermark)
    window = F.session_window("event_timestamp", f"{gap_seconds} seconds")
    merged = named.groupBy("customer_id", window.alias("w")).agg(*session_aggregates()).drop("w")
    started = F.unix_micros("session_start").cast("string")
    return finish_sessions(merged).withColumn("session_id", F.concat_ws("-", "customer_id", started))


def write_sessions(
    events: DataFrame, path: str, checkpoint: str, *, gap_seconds: int = 1800, watermark: str = "1 hour",
    available_now: bool = False, partitions: int | None = None,
) -> StreamingQuery:
    """Appends finished sessions to Parquet files at ``path``."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    with state_partitions(events.sparkSession, partitions):
        return (
            sessions(events, gap_seconds, watermark)
            .writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**trigger)
            .start()
        )
