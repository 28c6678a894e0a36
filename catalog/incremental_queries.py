"""State, sketches, panes, buckets, deliveries and points in time: results kept up to date instead of made anew."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from basketry import testbed as tb
from basketry.operators import asof, sketches
from basketry.plans import features, incremental, marts, retention, staging, warehouse
from basketry.sinks import buckets
from basketry.sources import readers
from basketry.streaming import panes, sessions
from catalog import mart_queries, stream_queries, warehouse_queries
from catalog.common import EV_NOW, EV_START, EVENTS_CTE, Catalog, cents, day_text, exact_ratio, time_text
from catalog.feature_queries import ALL_CTE, DAY_US
from catalog.warehouse_queries import GAP_CTE, fresh_folder

CATALOG = Catalog()
add = CATALOG.add

# --- sessions -------------------------------------------------------------------------------------------------

SESSIONS_SQL = warehouse_queries._sessions_sql("gapped", "sid").replace(
    "sid AS session_id", "min(customer_id) || '-' || epoch_us(min(event_timestamp)) AS session_id")
STREAM_DAYS = 12


@add("sessions_batch", f"WITH {EVENTS_CTE}, {GAP_CTE} {SESSIONS_SQL}")
def _(spark, sf_dir):
    return sessions.sessions(tb.events(spark, sf_dir))


@add("sessions_stream", f"""WITH {EVENTS_CTE}, {GAP_CTE} {SESSIONS_SQL}
HAVING max(event_timestamp) + INTERVAL 30 MINUTE <= (SELECT max(event_timestamp) FROM ev) - INTERVAL {STREAM_DAYS} DAY""")
def _(spark, sf_dir):
    """Three micro-batches; every third event comes one batch late, into and between open sessions."""
    folder = fresh_folder(spark)
    events = tb.events(spark, sf_dir)
    decade = F.least(F.floor((F.dayofmonth("event_timestamp") - 1) / 10), F.lit(2))
    late = (F.substring("event_id", 2, 20).cast("long") % 3 == 0) & (decade < 2)
    dealt = events.withColumn("arrival", decade + late.cast("int"))
    for number in range(3):
        dealt.filter(F.col("arrival") == number).drop("arrival").write.mode("append").parquet(f"{folder}/in")
        stream = readers.read_layer_stream(spark, f"{folder}/in", events.schema)
        sessions.write_sessions(
            stream, f"{folder}/out", f"{folder}/checkpoint", watermark=f"{STREAM_DAYS} days", available_now=True,
            partitions=stream_queries.state_size(spark, sf_dir)).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


# --- sketches -------------------------------------------------------------------------------------------------

COUNTED = ["customer_id", "session_id"]


def _users_sketched(grain: str):
    @add(f"users_by_{grain}_sketched", f"""WITH {EVENTS_CTE}
SELECT {time_text(f"date_trunc('{grain}', event_timestamp)")} AS window_start, region, count(*) AS events,
       count(DISTINCT customer_id) AS users, count(DISTINCT session_id) AS sessions, TRUE AS within_3_percent
FROM ev GROUP BY 1, 2""")
    def _(spark, sf_dir):
        """Sketches per five minutes and device, stored, united, and held against exact counts."""
        folder, events = fresh_folder(spark), tb.events(spark, sf_dir)
        made = sketches.distinct_sketches(events, ["device", "region"], COUNTED)
        made.withColumn("day", F.to_date("window_start")).write.partitionBy("day").parquet(folder)
        near = sketches.estimated(sketches.united(spark.read.parquet(folder), ["region"], COUNTED, grain), COUNTED)
        exact = events.groupBy(F.date_trunc(grain, "event_timestamp").alias("window_start"), "region").agg(
            F.countDistinct("customer_id").alias("users"), F.countDistinct("session_id").alias("sessions"))
        close = lambda found, true: F.abs(F.col(found) - F.col(true)) <= 0.03 * F.col(true)
        return near.join(exact, ["window_start", "region"], "full").select(
            "window_start", "region", "events", "users", "sessions",
            (close("customer_id_count", "users") & close("session_id_count", "sessions")).alias("within_3_percent"))


for _grain in ("hour", "day", "month"):
    _users_sketched(_grain)

SKETCHED = ["monetary", "recency_days", "product_view_count"]
SHARES = [0.01, 0.25, 0.5, 0.75, 0.99]


@add("quantiles_sketched", f"WITH {ALL_CTE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {p}::DOUBLE AS probability, count(*) AS n, TRUE AS rank_within_1_percent FROM lab"
    for c in SKETCHED for p in SHARES))
def _(spark, sf_dir):
    """Sketches of sixteen parts of the customers, merged; the rank of each quantile is counted."""
    rows = tb.combined_features(spark, sf_dir).select("customer_id", *[F.col(c).cast("double").alias(c) for c in SKETCHED])
    parts = rows.withColumn("part", F.pmod(F.xxhash64("customer_id"), F.lit(16)))
    folder = fresh_folder(spark)
    sketches.quantile_sketches(parts, SKETCHED, ["part"]).write.parquet(folder)
    found = sketches.merged_quantiles(spark.read.parquet(folder), SKETCHED, SHARES)
    values = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("x")) for c in SKETCHED])))
    ranked = values.join(found, "feature").groupBy("feature", "probability").agg(
        F.count("*").alias("n"), (F.count_if(F.col("x") < F.col("value")) / F.count("*")).alias("below"),
        (F.count_if(F.col("x") <= F.col("value")) / F.count("*")).alias("up_to"))
    error = F.greatest(F.col("below") - F.col("probability"), F.col("probability") - F.col("up_to"))
    return ranked.select("feature", "probability", "n", (error <= 0.01).alias("rank_within_1_percent"))


# --- sliding windows by panes ---------------------------------------------------------------------------------


@add("top_products_panes", stream_queries.VIEWED)
def _(spark, sf_dir):
    return stream_queries._shown(panes.most_viewed_products(tb.events(spark, sf_dir)), "top_products")


# --- stored tables that take updates --------------------------------------------------------------------------


@add("stored_upsert_buckets", warehouse_queries.CATALOG.oracles["upsert_customers"])
def _(spark, sf_dir):
    """A bucketed table of customer totals, and the new totals in two deliveries."""
    folder = f"{fresh_folder(spark)}/customers"
    old, new = warehouse_queries.split(spark, sf_dir)
    buckets.upsert_buckets(warehouse_queries.order_totals(old), folder, ["customer_id"], 16)
    first = F.substring("customer_id", 2, 10).cast("long") % 2 == 0
    for part in (first, ~first):
        buckets.upsert_buckets(warehouse_queries.order_totals(new).filter(part), folder, ["customer_id"],
                               update_cols=["total_orders", "total_spend"])
    return buckets.read_buckets(spark, folder)


def delivered(spark, sf_dir) -> str:
    """Three deliveries of orders: a first with wrong amounts and dates, then new and late ones, then corrections."""
    folder = fresh_folder(spark)
    orders = mart_queries.orders(spark, sf_dir)
    n = F.col("order_id").cast("long")
    early = (F.col("order_date") < "1997-01-01") & (n % 3 != 0)
    wrong = early & ((n % 5 == 0) | (n % 7 == 0))
    day = F.when(n % 7 == 0, F.date_sub("order_date", 40)).otherwise(F.col("order_date"))
    more = F.when(n % 5 == 0, 10).otherwise(0)
    kind = lambda c: orders.schema[c].dataType
    first = orders.filter(early).withColumns({
        "order_date": day, "order_year": F.year(day).cast(kind("order_year")), "order_month": F.month(day).cast(kind("order_month")),
        **{c: (F.col(c) + more).cast(kind(c)) for c in ("total_amount", "net_amount")}})
    for part in (first, orders.filter(~early), orders.filter(wrong)):
        incremental.deliver_orders(part, folder, 16)
    return folder


@add("monthly_revenue_incremental", mart_queries.CATALOG.oracles["monthly_revenue_report"])
def _(spark, sf_dir):
    return marts.revenue_trend(incremental.monthly_mart(spark, delivered(spark, sf_dir)), "detail")


@add("customer_retention_bitmaps", mart_queries.CATALOG.oracles["customer_retention"])
def _(spark, sf_dir):
    """Bitmaps of three deliveries, the last of which repeats orders of the others, stored and united."""
    folder = fresh_folder(spark)
    orders = mart_queries.orders(spark, sf_dir)
    n = F.col("order_id").cast("long")
    for part in (n % 3 != 0, n % 3 == 0, n % 5 == 0):
        made = retention.activity_bitmaps(orders.filter(part), F.substring("customer_id", 2, 20).cast("long"))
        made.write.mode("append").parquet(folder)
    return retention.customer_retention(retention.united(spark.read.parquet(folder)))


# --- points in time -------------------------------------------------------------------------------------------

WEEKS = [str(date(2024, 1, 5) + timedelta(days=7 * k)) for k in range(8)]
BOUGHT = "FILTER (event_type = 'PURCHASE' AND total_amount > 0)"


@add("features_at_eight_weeks", f"""WITH {EVENTS_CTE}, w AS (SELECT unnest({WEEKS})::TIMESTAMP AS d),
g AS (
  SELECT customer_id, d, count(order_id) {BOUGHT} AS frequency, sum(CAST(total_amount AS DECIMAL(15,2))) {BOUGHT} AS spend,
         max(event_timestamp) {BOUGHT} AS l, min(event_timestamp) {BOUGHT} AS f,
         max(CAST(total_amount AS DECIMAL(15,2))) {BOUGHT} AS top, min(CAST(total_amount AS DECIMAL(15,2))) {BOUGHT} AS low,
         {", ".join(f"count(*) FILTER (event_type = '{t}') AS {c}" for c, t in (
             ("product_view_count", "PRODUCT_VIEW"), ("search_count", "SEARCH"), ("cart_add_count", "ADD_TO_CART"),
             ("purchase_count", "PURCHASE"), ("login_count", "LOGIN")))},
         max(event_timestamp) FILTER (event_type = 'LOGIN') AS last_login
  FROM ev JOIN w ON event_timestamp < d GROUP BY 1, 2),
x AS (SELECT *, coalesce((epoch_us(l) - epoch_us(f)) // {DAY_US}, 0)::BIGINT AS days FROM g)
SELECT customer_id, {day_text('d')} AS snapshot_date, 'point_in_time' AS feature_set, frequency, spend::DOUBLE AS monetary,
       {time_text('l')} AS last_purchase_date, {time_text('f')} AS first_purchase_date, top::DOUBLE AS max_purchase_value,
       low::DOUBLE AS min_purchase_value, {exact_ratio(cents('spend'), 'frequency', 4, in_cents=True)} AS avg_purchase_value,
       coalesce((epoch_us(d) - epoch_us(l)) // {DAY_US}, 9999)::BIGINT AS recency_days, days AS customer_lifespan_days,
       round_even(CASE WHEN days > 0 THEN frequency / (days / 30) ELSE frequency END, 4) AS monthly_orders,
       product_view_count, search_count, cart_add_count, purchase_count, login_count, {time_text('last_login')} AS last_login_date,
       round_even(CASE WHEN cart_add_count = 0 THEN 0.0 ELSE greatest(0.0, least(1.0,
         (cart_add_count - purchase_count) / cart_add_count)) END, 4) AS cart_abandonment_rate,
       coalesce((epoch_us(d) - epoch_us(last_login)) // {DAY_US}, 9999)::BIGINT AS days_since_last_login FROM x""")
def _(spark, sf_dir):
    events = tb.events(spark, sf_dir)
    at = features.features_at(warehouse.fact_orders(events), events, WEEKS)
    return at.withColumn("avg_purchase_value", F.round("avg_purchase_value", 6))


@add("last_view_before_purchase", f"""WITH {EVENTS_CTE},
v AS (
  SELECT customer_id, event_timestamp AS viewed_at, product_id AS viewed_product, event_id AS view_id FROM ev
  WHERE event_type = 'PRODUCT_VIEW'
  QUALIFY row_number() OVER (PARTITION BY customer_id, event_timestamp ORDER BY product_id DESC, event_id DESC) = 1)
SELECT p.event_id, p.customer_id, {time_text('viewed_at')} AS viewed_at, viewed_product, view_id
FROM (SELECT * FROM ev WHERE event_type = 'PURCHASE') p
ASOF LEFT JOIN v ON p.customer_id = v.customer_id AND p.event_timestamp >= v.viewed_at""")
def _(spark, sf_dir):
    events = tb.events(spark, sf_dir)
    bought = events.filter("event_type = 'PURCHASE'").select("event_id", "customer_id", "event_timestamp")
    views = events.filter("event_type = 'PRODUCT_VIEW'").select(
        "customer_id", F.col("event_timestamp").alias("viewed_at"), F.col("product_id").alias("viewed_product"),
        F.col("event_id").alias("view_id"))
    found = asof.asof_join(
        bought, views, "customer_id", "event_timestamp", "viewed_at", ["viewed_at", "viewed_product", "view_id"])
    return found.drop("event_timestamp")


# --- payloads parsed once -------------------------------------------------------------------------------------


@add("stg_events_variant", mart_queries.CATALOG.oracles["stg_events"].replace(
    "\nFROM ev WHERE", ", product_id AS payload_product, payment_method AS payload_payment, FALSE AS payload_broken\nFROM ev WHERE"))
def _(spark, sf_dir):
    folder = fresh_folder(spark)
    staging.with_variant(tb.raw_events(spark, sf_dir)).write.parquet(folder)
    staged = staging.stg_events_variant(spark.read.parquet(folder), EV_NOW, EV_START)
    return staged.withColumns({
        "payload_product": F.try_variant_get("fields", "$.product_id", "string"),
        "payload_payment": F.try_variant_get("fields", "$.payment_method", "string")}).drop("fields")
