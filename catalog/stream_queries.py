"""Window metrics as batch and as stream, and the layered stream. Streams read the event file as a source."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry import schemas
from basketry import testbed as tb
from basketry.operators import cleaning
from basketry.session import state_partitions
from basketry.sources import readers
from basketry.streaming import layers, windows
from catalog.common import EVENTS_CTE, Catalog, cents, exact_ratio, time_text
from catalog.quality_queries import DIRTY_CTE, FLAGS_SQL
from catalog.warehouse_queries import fresh_folder

CATALOG = Catalog()
add = CATALOG.add

M = "CAST({} AS DECIMAL(15,2))"
SLOT = "time_bucket(INTERVAL {0}, event_timestamp, TIMESTAMP '2000-01-01')"


def closed(sql: str, source: str, minutes: int, hours: str) -> str:
    """Windows the watermark has passed: the newest time of ``source`` less the delay."""
    return f"""{sql} WHERE w + INTERVAL {hours} <= (SELECT max(event_timestamp) FROM {source})
      - INTERVAL {minutes} MINUTE"""


HOURLY = f"""WITH {EVENTS_CTE}, src AS (SELECT * FROM ev WHERE event_type = 'PURCHASE' AND total_amount IS NOT NULL),
a AS (
  SELECT {SLOT.format('1 HOUR')} AS w, region, sum({M.format('total_amount')}) AS s, count(event_id) AS order_count,
         max(total_amount) AS max_order_value, min(total_amount) AS min_order_value FROM src GROUP BY 1, 2)
SELECT region, s::DOUBLE AS total_revenue, order_count,
       {exact_ratio(cents('s'), 'order_count', 4, in_cents=True)} AS avg_order_value, max_order_value,
       min_order_value, {time_text('w')} AS window_start, {time_text('w + INTERVAL 1 HOUR')} AS window_end FROM a"""

REGIONAL = f"""WITH {EVENTS_CTE}, src AS (SELECT * FROM ev WHERE event_type = 'PURCHASE'),
a AS (
  SELECT {SLOT.format('5 MINUTE')} AS w, region, country, sum({M.format('total_amount')})::DOUBLE AS revenue,
         count(order_id) AS orders, count(DISTINCT customer_id) AS unique_customers FROM src GROUP BY 1, 2, 3)
SELECT region, country, revenue, orders, unique_customers, {time_text('w')} AS window_start FROM a"""

VIEWED = f"""WITH {EVENTS_CTE}, src AS (
  SELECT * FROM ev WHERE event_type = 'PRODUCT_VIEW' AND product_id IS NOT NULL),
hops AS (
  SELECT *, {SLOT.format('15 MINUTE')} - i * INTERVAL 15 MINUTE AS w FROM src, (SELECT unnest([0, 1, 2, 3]) AS i)),
a AS (
  SELECT w, product_id, product_name, category, count(event_id) AS view_count, sum({M.format('price')}) AS s,
         count(price) AS priced, count(DISTINCT customer_id) AS unique_viewers FROM hops GROUP BY 1, 2, 3, 4)
SELECT product_id, product_name, category, view_count,
       {exact_ratio(cents('s'), 'priced', 4, in_cents=True)} AS avg_price, unique_viewers,
       {time_text('w')} AS window_start FROM a"""

FUNNEL = f"""WITH {EVENTS_CTE}, src AS (SELECT * FROM ev),
a AS (
  SELECT {SLOT.format('1 HOUR')} AS w, region, count(*) FILTER (event_type = 'PRODUCT_VIEW') AS views,
         count(*) FILTER (event_type = 'ADD_TO_CART') AS cart_adds,
         count(*) FILTER (event_type = 'PURCHASE') AS purchases FROM src GROUP BY 1, 2)
SELECT region, views, cart_adds, purchases, coalesce(cart_adds / nullif(views, 0), 0) AS view_to_cart_rate,
       coalesce(purchases / nullif(cart_adds, 0), 0) AS cart_to_purchase_rate,
       coalesce(purchases / nullif(views, 0), 0) AS overall_conversion_rate, {time_text('w')} AS window_start FROM a"""

ACTIVE = f"""WITH {EVENTS_CTE}, src AS (SELECT * FROM ev),
a AS (
  SELECT {SLOT.format('5 MINUTE')} AS w, device, region, count(DISTINCT customer_id) AS active_users,
         count(event_id) AS total_events, count(DISTINCT session_id) AS active_sessions FROM src GROUP BY 1, 2, 3)
SELECT device, region, active_users, total_events, active_sessions, {time_text('w')} AS window_start FROM a"""

METRICS = {
    "revenue_per_hour": (windows.revenue_per_hour, HOURLY, 60, "1 HOUR"),
    "revenue_per_region": (windows.revenue_per_region, REGIONAL, 10, "5 MINUTE"),
    "top_products": (windows.most_viewed_products, VIEWED, 60, "1 HOUR"),
    "conversion_rate": (windows.conversion_rate, FUNNEL, 60, "1 HOUR"),
    "active_users": (windows.active_users, ACTIVE, 10, "5 MINUTE"),
}


def state_size(spark, sf_dir) -> int:
    """State partitions: a setting of the deployment, as they can't change while a checkpoint lives; else all its cores."""
    return int(spark.conf.get("spark.basketry.state.partitions", str(max(8, spark.sparkContext.defaultParallelism))))


def finish(queries) -> None:
    for query in queries:
        query.awaitTermination()


def _shown(df, name):
    return df.withColumn("avg_price", F.round("avg_price", 6)) if name == "top_products" else df


def _register(name, metric, sql, minutes, hours):
    @add(f"{name}_batch", sql)
    def _(spark, sf_dir):
        return _shown(metric(tb.events(spark, sf_dir)), name)

    @add(f"{name}_stream", closed(sql, "src", minutes, hours))
    def _(spark, sf_dir):
        folder = fresh_folder(spark)
        finish(
            windows.run_aggregations(
                tb.event_stream(spark, sf_dir), f"{folder}/out", f"{folder}/checkpoint", available_now=True,
                metrics={name: metric}, partitions=state_size(spark, sf_dir),
            )
        )
        return _shown(spark.read.parquet(f"{folder}/out/{name}"), name)


for _name, _parts in METRICS.items():
    _register(_name, *_parts)


def layered(spark, sf_dir) -> str:
    """Untidy events as messages through the layered stream; returns the folder of the layers."""
    folder = fresh_folder(spark)
    messages = tb.messages_from(tb.untidy_from(tb.event_stream(spark, sf_dir, state_size(spark, sf_dir))))
    finish(
        layers.split_sinks(
            messages, folder, f"{folder}/checkpoint", as_of="2024-01-30 00:00:00", available_now=True,
            partitions=state_size(spark, sf_dir),
        )
    )
    return folder


ROWS = f"""event_id, customer_id, event_type, device, region, total_amount, price,
       {time_text('event_timestamp')} AS event_timestamp, dq_negative_amount, dq_future_timestamp"""
PASSED = "NOT (dq_missing_customer_id OR dq_missing_event_type OR dq_invalid_timestamp OR dq_negative_amount)"


def _layer_rows(df):
    return df.select(
        "event_id", "customer_id", "event_type", "device", "region", "total_amount", "price", "event_timestamp",
        "dq_negative_amount", "dq_future_timestamp",
    )


@add("stream_silver", f"WITH {DIRTY_CTE}, {FLAGS_SQL} SELECT DISTINCT {ROWS} FROM flags WHERE {PASSED}")
def _(spark, sf_dir):
    return _layer_rows(readers.read_layer(spark, f"{layered(spark, sf_dir)}/silver"))


@add("stream_dead_letters", f"WITH {DIRTY_CTE}, {FLAGS_SQL} SELECT DISTINCT {ROWS} FROM flags WHERE NOT {PASSED}")
def _(spark, sf_dir):
    return _layer_rows(readers.read_layer(spark, f"{layered(spark, sf_dir)}/dlq"))


@add("stream_bronze", f"""WITH {DIRTY_CTE}
SELECT year(t) AS year, month(t) AS month, day(t) AS day, count(*) AS messages FROM (
  SELECT coalesce(c.event_timestamp, e.event_timestamp) AS t FROM cleaned c JOIN ev e USING (event_id))
GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    bronze = readers.read_layer(spark, f"{layered(spark, sf_dir)}/bronze")
    return bronze.groupBy("year", "month", "day").agg(F.count("*").alias("messages"))


ARRIVALS = f"""{DIRTY_CTE}, {FLAGS_SQL},
arrived AS (SELECT flags.*, e.event_timestamp AS sent, {PASSED} AS good FROM flags JOIN ev e USING (event_id))"""


def _accounts(spark, folder):
    """Per day of arrival: messages in bronze, silver and dead letters, and the copies, which are what is left."""
    layer = lambda name: spark.read.parquet(f"{folder}/{name}").select(
        F.date_format("broker_timestamp", "yyyy-MM-dd").alias("day"), F.lit(name).alias("layer"))
    rows = layer("bronze").union(layer("silver")).union(layer("dlq"))
    counts = [F.count_if(F.col("layer") == n).alias(n) for n in ("bronze", "silver", "dlq")]
    return rows.groupBy("day").agg(*counts).withColumn("copies", F.col("bronze") - F.col("silver") - F.col("dlq"))


@add("stream_accounting", f"""WITH {ARRIVALS}
SELECT strftime(sent, '%Y-%m-%d') AS day, count(*) AS bronze, count(DISTINCT event_id) FILTER (good) AS silver,
       count(DISTINCT event_id) FILTER (NOT good) AS dlq,
       count(*) - count(DISTINCT event_id) FILTER (good) - count(DISTINCT event_id) FILTER (NOT good) AS copies
FROM arrived GROUP BY 1""")
def _(spark, sf_dir):
    return _accounts(spark, layered(spark, sf_dir))


@add("stream_ledger", CATALOG.oracles["stream_accounting"])
def _(spark, sf_dir):
    """Three deliveries, the copies in the last, when the state of a millisecond has long forgotten what they are copies of."""
    folder = fresh_folder(spark)
    rows = tb.untidy_events(spark, sf_dir, state_size(spark, sf_dir))
    n = F.substring("event_id", 2, 20).cast("long")
    for part in ((n % 2 == 0) & (F.col("copy_no") == 1), (n % 2 == 1) & (F.col("copy_no") == 1), F.col("copy_no") == 2):
        tb.messages_from(rows.filter(part)).write.mode("append").parquet(f"{folder}/in")
        stream = readers.read_event_stream(spark, f"{folder}/in", kind="files", max_files=1_000_000)
        finish(layers.split_sinks(stream, folder, f"{folder}/checkpoint", as_of="2024-01-30 00:00:00", available_now=True,
                                  partitions=state_size(spark, sf_dir), dedup_delay="1 millisecond", ledger=True))
    return _accounts(spark, folder)


REPLAYED = f"""WITH {ARRIVALS},
r AS (
  SELECT sent, n, copy_no, event_id,
         CASE WHEN n % 83 = 0 THEN FALSE WHEN n % 7 = 0 AND copy_no = 1 THEN FALSE ELSE good END AS good,
         n % 83 = 0 AS broken, n % 89 = 0 AS no_id FROM arrived)
SELECT strftime(sent, '%Y-%m-%d') AS day, count(*) AS bronze,
       count(*) FILTER (good AND no_id) + count(DISTINCT event_id) FILTER (good AND NOT no_id) AS silver,
       count(*) FILTER (NOT good) AS dlq,
       count(*) FILTER (good AND NOT no_id) - count(DISTINCT event_id) FILTER (good AND NOT no_id) AS copies
FROM r GROUP BY 1"""


@add("stream_replay", REPLAYED)
def _(spark, sf_dir):
    """Old messages last: three deliveries, the newest events first, each a micro-batch of its own. Some are broken,
    some have no id, and of events sent twice the first copy is bad."""
    folder = fresh_folder(spark)
    rows = tb.untidy_events(spark, sf_dir, state_size(spark, sf_dir))
    rows = rows.withColumn("n", F.substring("event_id", 2, 20).cast("long"))
    bad = (F.col("n") % 7 == 0) & (F.col("copy_no") == 1)
    rows = rows.withColumns({
        "customer_id": F.when(~bad, F.col("customer_id")), "event_id": F.when(F.col("n") % 89 != 0, F.col("event_id"))})
    body = [c for c in rows.columns if c not in ("n", "copy_no", "sent_at")]
    messages = rows.select(
        F.lit("k").cast("binary").alias("key"),
        F.when(F.col("n") % 83 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(*body))).cast("binary").alias("value"),
        F.lit("product-events").alias("topic"), F.lit(0).alias("partition"),
        (F.col("n") * 2 + F.col("copy_no")).alias("offset"), F.col("sent_at").alias("timestamp"))
    days = [("2024-01-21", "9999-01-01"), ("2024-01-11", "2024-01-21"), ("0001-01-01", "2024-01-11")]
    for first, last in days:
        part = messages.filter((F.col("timestamp") >= first) & (F.col("timestamp") < last))
        part.write.mode("append").parquet(f"{folder}/in")
        stream = readers.read_event_stream(spark, f"{folder}/in", kind="files", max_files=1_000_000)
        finish(layers.split_sinks(stream, folder, f"{folder}/checkpoint", as_of="2024-01-30 00:00:00", available_now=True,
                                  partitions=state_size(spark, sf_dir)))
    return _accounts(spark, folder)


def _single_sink(spark, sf_dir, write):
    """Flagged events of the message stream through one sink; no row is a copy here."""
    folder = fresh_folder(spark)
    arriving = tb.untidy_from(tb.event_stream(spark, sf_dir, state_size(spark, sf_dir)))
    parsed = cleaning.parse_payload(tb.messages_from(arriving), schemas.PAYLOAD)
    flagged = layers.silver_rows(parsed, "2024-01-30 00:00:00")
    finish([write(flagged, f"{folder}/out", f"{folder}/checkpoint", available_now=True)])
    return readers.read_layer(spark, f"{folder}/out").groupBy("event_id", "customer_id", "dq_negative_amount").agg(
        F.count("*").alias("copies"))


@add("sink_silver", f"""WITH {DIRTY_CTE}, {FLAGS_SQL}
SELECT event_id, customer_id, dq_negative_amount, count(*) AS copies FROM flags WHERE {PASSED} GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    return _single_sink(spark, sf_dir, layers.write_silver)


@add("sink_dead_letters", f"""WITH {DIRTY_CTE}, {FLAGS_SQL}
SELECT event_id, customer_id, dq_negative_amount, count(*) AS copies FROM flags WHERE NOT {PASSED} GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    return _single_sink(spark, sf_dir, layers.write_dlq)


LATE_FROM = "2024-01-21 00:00:00"


@add("late_events", closed(HOURLY.replace("AND total_amount IS NOT NULL", f"AND event_timestamp >= TIMESTAMP '{LATE_FROM}'"),
                           "src", 60, "1 HOUR"))
def _(spark, sf_dir):
    """Newer events first, older ones in a second micro-batch: the watermark has passed them, so they count nowhere."""
    folder = fresh_folder(spark)
    events = tb.events(spark, sf_dir)
    for part in (F.col("event_timestamp") >= LATE_FROM, F.col("event_timestamp") < LATE_FROM):
        events.filter(part).write.mode("append").parquet(f"{folder}/in")
        stream = readers.read_layer_stream(spark, f"{folder}/in", events.schema)
        finish(windows.run_aggregations(
            stream, f"{folder}/out", f"{folder}/checkpoint", available_now=True,
            metrics={"revenue_per_hour": windows.revenue_per_hour}, partitions=state_size(spark, sf_dir)))
    return spark.read.parquet(f"{folder}/out/revenue_per_hour")


@add("stream_new_files", f"""WITH {EVENTS_CTE}
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM ev GROUP BY 1""")
def _(spark, sf_dir):
    """Two runs with one checkpoint: the second finds nothing new."""
    folder = fresh_folder(spark)
    source = tb.table(spark, sf_dir, "events")
    for _run in range(2):
        fresh = readers.read_new_files(spark, f"{sf_dir}/events*.parquet", source.schema)
        finish(
            [
                tb.events_from(fresh).writeStream.format("parquet").option("path", f"{folder}/out")
                .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
            ]
        )
    loaded = spark.read.parquet(f"{folder}/out")
    return loaded.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


@add("dedup_stream", f"WITH {EVENTS_CTE} SELECT event_id, session_id, product_id FROM ev")
def _(spark, sf_dir):
    from basketry.operators.dedup import dedup_stream

    folder = fresh_folder(spark)
    rows = tb.untidy_from(tb.event_stream(spark, sf_dir))
    unique = dedup_stream(rows, time="sent_at", spread=F.col("copy_no"))
    with state_partitions(spark, state_size(spark, sf_dir)):
        finish(
            [
                unique.writeStream.format("parquet").option("path", f"{folder}/out")
                .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
            ]
        )
    return spark.read.parquet(f"{folder}/out").select("event_id", "session_id", "product_id")
