"""Sliding windows from panes: every event is counted once, in the pane as long as the slide, and panes make windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["product_id", "product_name", "category"]


def most_viewed_products(events: DataFrame, pane_minutes: int = 15, panes: int = 4) -> DataFrame:
    """``windows.most_viewed_products`` of a batch, in windows of ``panes`` panes that start at every pane.

    A viewer counts for a window in the first pane of the window that saw them. A view after a pause of p panes is that
    first view for the p windows, ``panes`` at most, which the view before doesn't reach; so viewers add up from numbers
    per pane, without sets. The windows per product and viewer, and per product, see one row per pane at most.
    """
    seconds = 60 * pane_minutes
    price = F.col("price").cast("decimal(15,2)")
    viewed = events.filter((F.col("event_type") == "PRODUCT_VIEW") & F.col("product_id").isNotNull())
    viewed = viewed.filter(F.col("event_timestamp").isNotNull())
    pane = F.floor(F.unix_seconds("event_timestamp") / seconds).alias("pane")

    def reached(order) -> F.Column:
        """How many windows have this pane, and none before it in ``order``."""
        return F.least(F.coalesce(F.col("pane") - F.lag("pane").over(order), F.lit(panes)), F.lit(panes))

    per_user = viewed.groupBy(*KEYS, "customer_id", pane).agg(
        F.count("event_id").alias("views"), F.sum(price).alias("prices"), F.count(price).alias("priced"))
    per_user = per_user.withColumn("first_in", reached(Window.partitionBy(*KEYS, "customer_id").orderBy("pane")))
    known = F.col("customer_id").isNotNull()
    per_pane = per_user.groupBy(*KEYS, "pane").agg(
        F.sum("views").alias("views"),
        F.coalesce(F.sum("prices"), F.lit(0)).cast("decimal(38,2)").alias("prices"),
        F.sum("priced").alias("priced"),
        # Viewers by how many panes before this one the window begins.
        F.array(*[F.count_if(known & (F.col("first_in") > back)) for back in range(panes)]).alias("viewers"),
    )
    order = Window.partitionBy(*KEYS).orderBy("pane")
    ahead = F.collect_list(F.struct("pane", "views", "prices", "priced", "viewers")).over(order.rangeBetween(0, panes - 1))
    opened = per_pane.withColumns({"ahead": ahead, "reach": reached(order)})
    opened = opened.select(*KEYS, "ahead", F.explode(F.sequence(F.col("pane") - F.col("reach") + 1, F.col("pane"))).alias("begin"))
    inside = F.filter("ahead", lambda p: p["pane"] < F.col("begin") + panes)

    def total(value, kind: str) -> F.Column:
        return F.aggregate(inside, F.lit(0).cast(kind), lambda so_far, p: (so_far + value(p)).cast(kind))

    summed = opened.select(
        *KEYS,
        total(lambda p: p["views"], "long").alias("view_count"),
        total(lambda p: p["prices"], "decimal(38,2)").alias("prices"),
        total(lambda p: p["priced"], "long").alias("priced"),
        total(lambda p: F.get(p["viewers"], (p["pane"] - F.col("begin")).cast("int")), "long").alias("unique_viewers"),
        F.timestamp_seconds(F.col("begin") * seconds).alias("window_start"),
    )
    return summed.withColumn("avg_price", F.try_divide("prices", "priced")).drop("prices", "priced")
