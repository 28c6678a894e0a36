"""Stream from broker messages to bronze, silver and dead letters."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry import schemas
from basketry.functions import Moment, event_calendar, parse_event_time
from basketry.operators.cleaning import clean_stream, parse_payload, quality_flags
from basketry.operators.dedup import dedup_stream
from basketry.plans.warehouse import topic_of
from basketry.session import setting, state_on_disk, state_partitions
from basketry.streaming.ledger import add_keys, known_keys

#: Rows in one piece of a cached batch. What doesn't fit in memory goes to disk through a Java object stream, which holds on
#: to the last hundred pieces in the heap of every task (``spark.serializer.objectStreamReset``).
CACHED_ROWS = 500

BRONZE_PARTITIONS = ["kafka_topic", "year", "month", "day"]
SILVER_PARTITIONS = ["event_type", "year", "month", "day"]


def bronze_rows(parsed: DataFrame) -> DataFrame:
    """Events as they came, with the partition columns of the bronze layer."""
    calendar = event_calendar(F.coalesce(parse_event_time(F.col("timestamp")), F.col("broker_timestamp")))
    return parsed.withColumns(
        {
            "kafka_topic": F.coalesce("topic", "kafka_topic", topic_of(F.upper(F.trim("event_type")))),
            **{c: calendar[c] for c in ("year", "month", "day")},
        }
    )


def silver_rows(parsed: DataFrame, as_of: Moment | None = None) -> DataFrame:
    """Cleaned and flagged events, good and bad."""
    return quality_flags(clean_stream(parsed, as_of), as_of)


def _append(df: DataFrame, path: str, checkpoint: str, partitions: list[str], every: str, now: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if now else {"processingTime": every}
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.outputMode("append").trigger(**trigger).start()


def write_bronze(
    parsed: DataFrame, path: str, checkpoint: str, by_hour: bool = False, available_now: bool = False
) -> StreamingQuery:
    rows, partitions = bronze_rows(parsed), list(BRONZE_PARTITIONS)
    if by_hour:
        moment = F.coalesce(parse_event_time(F.col("timestamp")), F.col("broker_timestamp"))
        rows, partitions = rows.withColumn("hour", F.hour(moment)), [*partitions, "hour"]
    return _append(rows, path, checkpoint, partitions, "30 seconds", available_now)


def write_silver(flagged: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return _append(
        flagged.filter("dq_passed"), path, checkpoint, SILVER_PARTITIONS, "30 seconds", available_now
    )


def write_dlq(flagged: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return _append(flagged.filter(~F.col("dq_passed")), path, checkpoint, [], "60 seconds", available_now)


def write_console(df: DataFrame, rows: int = 5) -> StreamingQuery:
    return (
        df.writeStream.format("console")
        .option("truncate", "false")
        .option("numRows", rows)
        .trigger(processingTime="10 seconds")
        .outputMode("append")
        .start()
    )


def _write_batch(rows: DataFrame, path: str, batch_id: int, partitions: list[str]) -> None:
    """Idempotent write: a repeated batch replaces its own folder.

    Rebalancing by the folder columns gives each folder few files, and adaptive execution splits a hot folder. A stream
    plans without adaptive execution; this write is a plain batch.
    """
    with setting(rows.sparkSession, "spark.sql.adaptive.enabled", "true"):
        (
            rows.hint("rebalance", *partitions)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*partitions)
            .parquet(f"{path}/batch={batch_id}")
        )


def split_sinks(
    messages: DataFrame, base: str, checkpoint: str, *, dedup_delay: str = "24 hours",
    as_of: Moment | None = None, available_now: bool = False, every: str = "30 seconds",
    spread: int = 8, partitions: int | None = None, ledger: bool = False,
) -> list[StreamingQuery]:
    """Bronze, silver and dead letters from broker messages. Every message ends in silver, in dead letters, or is a copy.

    Bronze holds every message as it came, copies included, so its query keeps no state. Silver and dead letters
    share one query, one deduplication state and one cached batch. All three are written in batch folders, which
    ``compaction`` merges. A passing event with an id is a copy if the same id
    passed within ``dedup_delay`` before, by the engine's own clock: event and broker times may be missing, absurd or,
    in a replay, out of order, and no row is too late. Failing events and events without an id are compared by their
    place in the broker only, so a bad copy never hides a good one. ``spread`` is the number of tasks that share the
    copies of one hot event id.

    With ``ledger`` the keys of all rows taken up are stored as well (``streaming.ledger``, folder ``ledger``), and a row
    whose key an earlier micro-batch stored is a copy however long ago that was. The state then only has to cover what
    comes at the same time, so a short ``dedup_delay`` will do. That may be a whole delivery, and the keys of the one
    before it, so this state lies on disk: memory holds a bounded part of it, however many keys come at once.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    parsed = parse_payload(messages, schemas.PAYLOAD)
    shares = F.pmod("offset", F.lit(spread)) if spread > 1 else None
    event = F.when(F.col("dq_passed"), F.concat(F.lit("event "), F.col("event_id")))
    message = F.concat(F.lit("message "), F.concat_ws(":", "topic", "partition"), F.lit(":"), F.col("offset"))
    key = F.coalesce(event, message)
    unique = dedup_stream(silver_rows(parsed, as_of), key, time=None, delay=dedup_delay, spread=shares)

    def unseen(kept: DataFrame, batch_id: int) -> DataFrame:
        known = known_keys(kept.select(key.alias("key")), f"{base}/ledger", batch_id).withColumnRenamed("key", "_key")
        return kept.withColumn("_key", key).join(known, "_key", "left_anti").drop("_key")

    def write(batch: DataFrame, batch_id: int) -> None:
        with setting(batch.sparkSession, "spark.sql.inMemoryColumnarStorage.batchSize", str(CACHED_ROWS)):
            write_cached(batch, batch_id)

    def write_cached(batch: DataFrame, batch_id: int) -> None:
        kept, good = batch.persist(), F.col("dq_passed")
        rows = unseen(kept, batch_id).persist() if ledger else kept
        try:
            # The first write runs every partition, so the state of a batch without rows is committed as well.
            _write_batch(rows.filter(good), f"{base}/silver", batch_id, SILVER_PARTITIONS)
            _write_batch(rows.filter(~good), f"{base}/dlq", batch_id, [])
            if ledger:
                add_keys(rows.select(key.alias("key")), f"{base}/ledger", batch_id)
        finally:
            rows.unpersist()
            kept.unpersist()

    def keep(batch: DataFrame, batch_id: int) -> None:
        _write_batch(bronze_rows(batch), f"{base}/bronze", batch_id, BRONZE_PARTITIONS)

    def start(rows: DataFrame, sink, name: str) -> StreamingQuery:
        writer = rows.writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint}/{name}")
        return writer.trigger(**trigger).start()

    spark = messages.sparkSession
    with state_partitions(spark, partitions), state_on_disk(spark) if ledger else nullcontext():
        return [start(parsed, keep, "bronze"), start(unique, write, "checked")]
