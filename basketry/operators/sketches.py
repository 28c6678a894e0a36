"""Mergeable sketches: approximate distinct counts and quantiles that are stored once and united at any grain.

Exact counterparts are ``streaming.windows`` and ``operators.stats``; a sketch is the choice where the ids of an open
window, or the sort of a whole table, cost too much.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of the registers of a distinct count: a standard error of about 0.8 %.
PRECISION = 14
#: Size of a quantile sketch: a rank error of about 0.4 %.
QUANTILE_SIZE = 800


def distinct_sketches(
    events: DataFrame, keys: Sequence[str], columns: Sequence[str], window: str = "5 minutes", watermark: str = "10 minutes",
    precision: int = PRECISION,
) -> DataFrame:
    """Per window and ``keys``: the number of ``events`` and a sketch of the distinct values of each of ``columns``.

    Works on batches and streams. State and storage are bounded by the sketch, whatever the number of values.
    """
    if events.isStreaming:
        events = events.withWatermark("event_timestamp", watermark)
    made = events.groupBy(F.window("event_timestamp", window).alias("w"), *keys).agg(
        F.count("*").alias("events"), *[F.hll_sketch_agg(c, precision).alias(f"{c}_sketch") for c in columns])
    return made.withColumn("window_start", F.col("w.start")).drop("w")


def united(sketched: DataFrame, keys: Sequence[str], columns: Sequence[str], grain: str) -> DataFrame:
    """Sketches of windows as one per ``grain`` (``hour``, ``day``, ``month``) and ``keys``, which may be fewer."""
    return sketched.groupBy(F.date_trunc(grain, "window_start").alias("window_start"), *keys).agg(
        F.sum("events").alias("events"), *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns])


def estimated(sketched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct counts that the sketches of ``columns`` stand for, as ``<column>_count``."""
    return sketched.withColumns({f"{c}_count": F.hll_sketch_estimate(f"{c}_sketch") for c in columns}).drop(
        *[f"{c}_sketch" for c in columns])


def quantile_sketches(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), size: int = QUANTILE_SIZE) -> DataFrame:
    """One quantile sketch per column (nulls left out) and ``keys``."""
    return df.groupBy(*keys).agg(
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"{c}_sketch") for c in columns])


def merged_quantiles(sketched: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """All sketches of a column as one, and its quantiles: ``feature, probability, value``."""
    whole = sketched.agg(*[F.kll_merge_agg_double(f"{c}_sketch").alias(c) for c in columns])
    parts = [
        F.struct(F.lit(c).alias("feature"), F.lit(p).alias("probability"),
                 F.kll_sketch_get_quantile_double(F.col(c), F.lit(p)).alias("value"))
        for c in columns for p in probabilities
    ]
    return whole.select(F.inline(F.array(*parts)))
