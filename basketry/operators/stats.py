"""Exploratory statistics of numeric columns. Quantiles are exact and interpolated linearly."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions import band_up_to
from basketry.operators.ordering import with_row_number, with_running_totals
from basketry.session import settle
from basketry.vocabulary import RFM_BANDS, RFM_LAST


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``feature`` and ``value`` as double, nulls left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.inline(pairs)).filter(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """One row per feature with ``q0``, ``q1`` ... for the given probabilities.

    Rows shrink to distinct values with counts first; the running count over the global order then tells which
    values sit at the two positions around each quantile.
    """
    counted = melt(df, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    placed = with_running_totals(counted, [F.col("value")], {"upto": "n"}, ["feature"], {"total": "n"})
    picks, finish = [], []
    for i, p in enumerate(probabilities):
        spot = (F.col("total") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            covers = (index < F.col("upto")) & (index >= F.col("upto") - F.col("n"))
            picks.append(F.max(F.when(covers, F.col("value"))).alias(f"{side}{i}"))
        picks.append(F.max(spot - F.floor(spot)).alias(f"w{i}"))
        low, high, weight = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"w{i}")
        finish.append((low + (high - low) * weight).alias(f"q{i}"))
    return placed.groupBy("feature").agg(*picks).select("feature", *finish)


def describe(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum per column."""
    value = F.col("value")
    basic = melt(df, columns).groupBy("feature").agg(
        F.count("*").alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    rounded = lambda c, name: F.round(c, digits).alias(name)
    return basic.join(quartiles, "feature").select(
        "feature", "count", rounded("mean", "mean"), rounded("std", "std"), rounded("min", "min"),
        rounded("q0", "p25"), rounded("q1", "p50"), rounded("q2", "p75"), rounded("max", "max"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Pearson correlation of every pair, both orders and the diagonal, from one aggregate."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pairs = list(combinations_with_replacement(columns, 2))

    def pearson(a: str, b: str) -> F.Column:
        # Both deviations over the rows where both values exist; null when either is constant.
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))

    counted = doubles.agg(*[pearson(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        r = F.round(f"r{i}", digits).alias("correlation")
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("column_x"), F.lit(y).alias("column_y"), r))
    return counted.select(F.inline(F.array(*cells)))


def clipped_histogram(
    df: DataFrame, columns: Sequence[str], label: str, bins: int = 40, clip_at: float = 0.99
) -> DataFrame:
    """Density histogram per column and label, values clipped at a quantile of the whole column.

    Bins span the clipped range of each (column, label) group; a single-valued group gets a range of width one.
    """
    top = exact_quantiles(df, columns, [clip_at]).withColumnRenamed("q0", "top")
    # One row per column of the table, so the broadcast is bounded by the schema.
    clipped = settle(
        melt(df, columns, [label])
        .join(F.broadcast(top), "feature")
        .select("feature", F.col(label).alias("label"), F.least("value", "top").alias("value"))
        .groupBy("feature", "label", "value")
        .agg(F.count("*").alias("n"))
    )
    edges = clipped.groupBy("feature", "label").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("total")
    )
    flat = F.col("low") == F.col("high")
    edges = edges.select(
        "feature", "label", "total",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )
    width = (F.col("high") - F.col("low")) / bins
    place = F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(bins - 1))
    return (
        clipped.join(edges, ["feature", "label"])
        .groupBy("feature", "label", place.alias("bin"))
        .agg(F.sum("n").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"),
             F.first("total").alias("total"))
        .select(
            "feature", "label", "bin", "n",
            F.round(F.col("low") + F.col("bin") * width, 6).alias("bin_start"),
            F.round(F.col("n") / (F.col("total") * width), 6).alias("density"),
        )
    )


def quintile(position, total) -> F.Column:
    """Quintile of a 1-based position among ``total`` rows, as equal-count cutting of ranks gives it."""
    share = F.when(total > 1, F.ceil(F.lit(5) * (position - 1) / (total - 1))).otherwise(1)
    return F.greatest(F.lit(1), share).cast("int")


def _quintile_cuts(df: DataFrame, columns: list[str], key: str) -> dict[str, list]:
    """Per column the (value, key) pairs that end quintiles 1 to 4: four rows each, whatever the table.

    The columns are laid one below the other and sorted together, by column.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    wide = "double" if any(k.typeName() == "double" for k in kinds.values()) else "decimal(38,6)"
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast(wide).alias("v"), F.col(key).alias("k")) for c in columns]
    long = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    placed = with_row_number(long, [F.col("v"), F.col("k")], by=["column"], total="total")
    ends = []
    for q in range(1, 5):
        at = F.floor(F.lit(q) * (F.col("total") - 1) / 5) + 1
        ends.append(F.max(F.when(F.col("row_number") == at, F.struct("v", "k"))).alias(f"c{q}"))
    return {r["column"]: [r[f"c{q}"] for q in range(1, 5)] for r in placed.groupBy("column").agg(*ends).collect()}


def rfm_quintiles(
    features: DataFrame, key: str = "customer_id", stale_is_high: bool = False
) -> DataFrame:
    """Scores 1-5 for recency, frequency and monetary value, their sum and the segment.

    Ties rank by key. A recent customer scores 5; ``stale_is_high`` keeps the opposite scale.
    """
    scores = {}
    kinds = features.schema
    names = {"r_score": "recency_days", "f_score": "frequency", "m_score": "monetary"}
    every = _quintile_cuts(features, list(names.values()), key)
    for score, column in names.items():
        rank = F.lit(1)
        for cut in every.get(column, []):
            if cut is not None:
                edge = F.struct(F.lit(cut["v"]).cast(kinds[column].dataType).alias("v"),
                                F.lit(cut["k"]).cast(kinds[key].dataType).alias("k"))
                rank = rank + (F.struct(F.col(column).alias("v"), F.col(key).alias("k")) > edge).cast("int")
        scores[score] = rank if score != "r_score" or stale_is_high else F.lit(6) - rank
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return (
        features.withColumns(scores)
        .withColumn("rfm_score", total)
        .withColumn("rfm_segment", band_up_to(F.col("rfm_score"), RFM_BANDS, RFM_LAST))
    )


def segment_summary(scored: DataFrame) -> DataFrame:
    """Customers, churn rate, mean spend and mean recency per segment."""
    return scored.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("count"),
        F.bround(F.avg(F.col("is_churned").cast("double")), 2).alias("churn_rate"),
        F.bround(F.avg("monetary"), 2).alias("avg_spend"),
        F.bround(F.avg("recency_days"), 2).alias("avg_recency"),
    )
