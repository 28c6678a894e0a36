"""Customer features for the store, the label and the train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions import Moment, as_day, as_moment, clip01, count_when, elapsed_days
from basketry.operators.ordering import with_row_number
from basketry.vocabulary import CHURN_AFTER_DAYS, NEVER_DAYS


def rfm_features(orders: DataFrame, as_of: Moment) -> DataFrame:
    """Recency, frequency, monetary value and order rhythm per customer."""
    amount, moment = F.col("total_amount"), F.col("event_timestamp")
    bought = orders.filter(amount > 0).groupBy("customer_id").agg(
        F.count("order_id").cast("int").alias("frequency"),
        F.sum(amount).alias("monetary"),
        F.max(moment).alias("last_purchase_date"),
        F.min(moment).alias("first_purchase_date"),
        F.max(amount).alias("max_purchase_value"),
        F.min(amount).alias("min_purchase_value"),
        F.avg(amount).alias("avg_purchase_value"),
    )
    return _with_rhythm(bought, as_of)


def _with_rhythm(bought: DataFrame, as_of: Moment) -> DataFrame:
    """Recency, lifespan and orders per month, as of a moment or a column of moments."""
    last, lifespan = F.col("last_purchase_date"), F.col("customer_lifespan_days")
    return (
        bought.withColumns(
            {
                "recency_days": F.coalesce(elapsed_days(as_moment(as_of), last), F.lit(NEVER_DAYS)),
                "customer_lifespan_days": F.coalesce(elapsed_days(last, F.col("first_purchase_date")), F.lit(0)),
            }
        )
        .withColumn(
            "monthly_orders",
            F.bround(
                F.when(lifespan > 0, F.col("frequency") / (lifespan / 30)).otherwise(F.col("frequency")), 4
            ),
        )
    )


def rfm_snapshot(orders: DataFrame, as_of: Moment) -> DataFrame:
    """The smaller feature set of the daily snapshot, tagged for the store."""
    wanted = ["recency_days", "frequency", "monetary", "avg_purchase_value", "max_purchase_value", "min_purchase_value"]
    return rfm_features(orders, as_of).select(
        "customer_id", as_day(as_of).alias("snapshot_date"), F.lit("rfm").alias("feature_set"), *wanted
    )


def behavioral_features(events: DataFrame, as_of: Moment) -> DataFrame:
    """Counts by event type, abandonment rate and days since the last login per customer."""
    kind = F.col("event_type")
    counted = events.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        count_when(kind == "PRODUCT_VIEW").alias("product_view_count"),
        count_when(kind == "SEARCH").alias("search_count"),
        count_when(kind == "ADD_TO_CART").alias("cart_add_count"),
        count_when(kind == "PURCHASE").alias("purchase_count"),
        count_when(kind == "LOGIN").alias("login_count"),
        F.max(F.when(kind == "LOGIN", F.col("event_timestamp"))).alias("last_login_date"),
    )
    return _with_rates(counted, as_of)


def _with_rates(counted: DataFrame, as_of: Moment) -> DataFrame:
    """Abandonment rate and days since the last login, as of a moment or a column of moments."""
    lost = F.try_divide(F.col("cart_add_count") - F.col("purchase_count"), F.col("cart_add_count"))
    return counted.withColumns(
        {
            "cart_abandonment_rate": F.bround(clip01(F.coalesce(lost, F.lit(0.0))), 4),
            "days_since_last_login": F.coalesce(
                elapsed_days(as_moment(as_of), F.col("last_login_date")), F.lit(NEVER_DAYS)
            ),
        }
    )


PIVOTED_TYPES = ["PRODUCT_VIEW", "SEARCH", "ADD_TO_CART", "PURCHASE", "LOGIN", "LOGOUT", "REFUND"]


def behavioral_pivot(events: DataFrame, as_of: Moment) -> DataFrame:
    """Event counts per customer pivoted wide; the abandonment rate divides by 1 when there is no cart."""
    wide = (
        events.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .pivot("event_type", PIVOTED_TYPES)
        .agg(F.count(F.lit(1)))
        .fillna(0, subset=PIVOTED_TYPES)
    )
    carts = F.col("ADD_TO_CART")
    rate = (carts - F.col("PURCHASE")) / F.when(carts == 0, 1).otherwise(carts)
    return wide.withColumns(
        {
            "cart_abandonment_rate": clip01(rate),
            "snapshot_date": as_day(as_of),
            "feature_set": F.lit("behavioral"),
        }
    )


def session_features(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("customer_id").agg(F.avg("session_duration_s").alias("avg_session_duration"))


def combined_features(
    rfm: DataFrame, behavioral: DataFrame, sessions: DataFrame, as_of: Moment, never_as_zero: bool = False
) -> DataFrame:
    """All features of all customers (rows without a customer are left out).

    Missing numbers become 0; missing days-since columns become the never value unless ``never_as_zero``. Each part has
    one row per customer, so the parts are laid one below the other and meet in one aggregate, one shuffle for all.
    """
    parts = [p.filter(F.col("customer_id").isNotNull()) for p in (rfm, behavioral, sessions)]
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    wide = rows.groupBy("customer_id").agg(*[F.max(c).alias(c) for c in rows.columns if c != "customer_id"])
    numeric = [
        f.name for f in wide.schema.fields
        if f.dataType.typeName() in ("integer", "long", "double", "decimal")
    ]
    never = [] if never_as_zero else ["recency_days", "days_since_last_login"]
    filled = {
        c: F.coalesce(F.col(c), F.lit(NEVER_DAYS if c in never else 0)).cast(wide.schema[c].dataType)
        for c in numeric
    }
    return wide.withColumns(
        {**filled, "snapshot_date": as_day(as_of), "feature_set": F.lit("combined_v2")}
    )


def latest_features(store: DataFrame, columns: Sequence[str], latest_only: bool = True) -> DataFrame:
    """Largest value per customer, over the newest snapshot or over all of them."""
    if latest_only:
        newest = store.agg(F.max("snapshot_date")).scalar()
        store = store.filter(F.col("snapshot_date") == newest)
    return store.groupBy("customer_id").agg(*[F.max(c).alias(c) for c in columns])


def label_churn(features: DataFrame, days: int = CHURN_AFTER_DAYS) -> DataFrame:
    recency = F.coalesce(F.col("recency_days"), F.lit(0))
    return features.withColumn("is_churned", (recency > days).cast("int"))


def shuffle_key(key: str, seed: int) -> F.Column:
    """A repeatable pseudo-random order of the rows."""
    return F.md5(F.concat_ws(":", F.col(key), F.lit(str(seed))))


def stratified_split(
    df: DataFrame, label: str = "is_churned", test_share: float = 0.2, seed: int = 42, key: str = "customer_id"
) -> DataFrame:
    """``df`` with ``is_test``: exactly round(share * n) rows of every label, chosen by hashed key.

    Only (label, hash, key) is ordered globally; one cut per label comes back and marks the rows in a map step. The cuts
    are sent to the rows: a join that shuffles by label would put all rows into as many tasks as there are labels.
    """
    marked = df.withColumn("_hash", shuffle_key(key, seed))
    placed = with_row_number(
        marked.select(label, "_hash", key), [F.col("_hash"), F.col(key)], [label], total="_total"
    )
    cuts = (
        placed.filter(F.col("row_number") == F.round(F.col("_total") * test_share))
        .groupBy(label)
        .agg(F.max(F.struct("_hash", key)).alias("_cut"))
    )
    inside = F.struct(F.col("_hash"), F.col(key)) <= F.col("_cut")
    return (
        marked.join(F.broadcast(cuts), label, "left")
        .withColumn("is_test", F.coalesce(inside, F.lit(False)))
        .drop("_hash", "_cut")
        .select(*df.columns, "is_test")
    )


def stratified_folds(
    df: DataFrame, folds: int = 5, label: str = "is_churned", seed: int = 42, key: str = "customer_id"
) -> DataFrame:
    """``df`` with ``fold``: every label spread evenly over 0 .. folds-1."""
    marked = df.withColumn("_hash", shuffle_key(key, seed))
    placed = with_row_number(marked, [F.col("_hash"), F.col(key)], [label])
    return placed.withColumn("fold", ((F.col("row_number") - 1) % folds).cast("int")).drop("_hash", "row_number")


def training_gate(df: DataFrame, minimum: int = 100) -> bool:
    """Whether there are at least ``minimum`` rows; reads no more than that many."""
    return df.limit(minimum).count() >= minimum


def most_frequent(df: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """Per ``key`` the most frequent value of each column (of equally frequent ones the smallest), under its new name.

    Values are counted as rows of their own, so a key with very many different values is no large row. A column without
    a value gives null, a key without any has no row.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in names])
    counted = df.select(key, F.inline(pairs)).filter(F.col("value").isNotNull()).groupBy(key, "name", "value").agg(
        F.count("*").alias("n"))
    # The best of each name: the highest count, and of equal counts the smallest value.
    top = counted.groupBy(key, "name").agg(F.max("n").alias("n"))
    best = counted.join(top, [key, "name", "n"]).groupBy(key, "name").agg(F.min("value").alias("value"))
    return best.groupBy(key).agg(*[F.max(F.when(F.col("name") == c, F.col("value"))).alias(n) for c, n in names.items()])


def extended_features(events: DataFrame, as_of: Moment) -> DataFrame:
    """Sessions, preferred category and device, days since the last purchase, search and refund ratios."""
    kind = F.col("event_type")
    named = events.filter(F.col("customer_id").isNotNull())
    preferred = most_frequent(named, "customer_id", {"category": "preferred_category", "device": "preferred_device"})
    counted = named.groupBy("customer_id").agg(
        F.countDistinct("session_id").alias("session_count"),
        F.max(F.when(kind == "PURCHASE", F.col("event_timestamp"))).alias("last_purchase_date"),
        count_when(kind == "SEARCH").alias("searches"),
        count_when(kind == "PRODUCT_VIEW").alias("views"),
        count_when(kind == "REFUND").alias("refunds"),
        count_when(kind == "PURCHASE").alias("purchases"),
    )
    return counted.join(preferred, "customer_id", "left").select(
        "customer_id",
        "session_count",
        "preferred_category",
        "preferred_device",
        F.coalesce(elapsed_days(as_moment(as_of), F.col("last_purchase_date")), F.lit(NEVER_DAYS)).alias(
            "days_since_last_purchase"
        ),
        F.try_divide("searches", "views").alias("search_to_view_ratio"),
        F.try_divide("refunds", "purchases").alias("refund_rate"),
    )


def features_at(orders: DataFrame, events: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Order and behaviour features of every customer as they were at each of ``dates``, from rows before that moment.

    Every row counts once, in the first date after it; running totals over the dates of a customer then give all
    snapshots. So any number of dates costs one pass and one shuffle of the rows. A customer appears from the first
    date on that has a row of theirs before it. Rows without a customer or a time, or after the last date, stay out.
    """
    days = sorted(set(dates))
    moments = F.array(*[as_moment(d) for d in days])
    bought = orders.filter(F.col("total_amount") > 0).select(
        "customer_id", "event_timestamp", F.lit("ORDER").alias("kind"), "order_id", "total_amount")
    done = events.select("customer_id", "event_timestamp", F.col("event_type").alias("kind"))
    rows = bought.unionByName(done, allowMissingColumns=True).filter(
        F.col("customer_id").isNotNull() & F.col("event_timestamp").isNotNull())
    place = F.size(F.filter(moments, lambda d: d <= F.col("event_timestamp")))
    rows = rows.withColumn("place", place).filter(F.col("place") < len(days))

    kind, amount, moment = F.col("kind"), F.col("total_amount"), F.col("event_timestamp")
    ordered = kind == "ORDER"
    counts = {"product_view_count": "PRODUCT_VIEW", "search_count": "SEARCH", "cart_add_count": "ADD_TO_CART",
              "purchase_count": "PURCHASE", "login_count": "LOGIN"}
    sums = ["frequency", "monetary", *counts]
    highs = ["last_purchase_date", "max_purchase_value", "last_login_date"]
    lows = ["first_purchase_date", "min_purchase_value"]
    delta = rows.groupBy("customer_id", "place").agg(
        F.count("order_id").alias("frequency"), F.sum(amount).alias("monetary"),
        F.max(F.when(ordered, moment)).alias("last_purchase_date"), F.min(F.when(ordered, moment)).alias("first_purchase_date"),
        F.max(amount).alias("max_purchase_value"), F.min(amount).alias("min_purchase_value"),
        *[count_when(kind == name).alias(c) for c, name in counts.items()],
        F.max(F.when(kind == "LOGIN", moment)).alias("last_login_date"))
    order = Window.partitionBy("customer_id").orderBy("place")  # one row per date at most
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = delta.select(
        "customer_id", "place", (F.coalesce(F.lead("place").over(order), F.lit(len(days))) - 1).alias("until"),
        *[F.sum(c).over(so_far).alias(c) for c in sums], *[F.max(c).over(so_far).alias(c) for c in highs],
        *[F.min(c).over(so_far).alias(c) for c in lows])
    at = running.withColumn("place", F.explode(F.sequence("place", "until"))).drop("until")
    at = at.withColumns({
        "_at": F.get(moments, F.col("place")), "frequency": F.col("frequency").cast("int"),
        "avg_purchase_value": F.try_divide("monetary", "frequency")})
    at = _with_rates(_with_rhythm(at, F.col("_at")), F.col("_at"))
    return at.withColumns({"snapshot_date": F.to_date("_at"), "feature_set": F.lit("point_in_time")}).drop("_at", "place")
