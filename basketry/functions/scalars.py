"""Column expressions. All run inside the JVM; none needs Python workers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "Moment",
    "as_moment",
    "as_day",
    "parse_event_time",
    "canonical_device",
    "event_calendar",
    "money",
    "ratio",
    "clip01",
    "band_up_to",
    "tier_from",
    "elapsed_days",
    "count_when",
    "sum_when",
    "unit",
    "dot",
]

Moment = str | date | datetime | Column


def as_moment(value: Moment) -> Column:
    return (value if isinstance(value, Column) else F.lit(str(value))).cast("timestamp")


def as_day(value: Moment) -> Column:
    return as_moment(value).cast("date")


def parse_event_time(text: Column) -> Column:
    """ISO text with or without fraction and zone; anything else becomes null."""
    trimmed = F.trim(text)
    return F.coalesce(
        F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][XXX]")),
        F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][XXX]")),
    )


def canonical_device(device: Column) -> Column:
    name = F.lower(F.trim(device))
    return (
        F.when(name.isin("mobile", "app"), "Mobile")
        .when(name == "desktop", "Desktop")
        .when(name == "tablet", "Tablet")
        .otherwise("Unknown")
    )


def event_calendar(moment: Column) -> dict[str, Column]:
    return {
        "event_date": F.to_date(moment),
        "event_hour": F.hour(moment),
        "year": F.year(moment),
        "month": F.month(moment),
        "day": F.dayofmonth(moment),
    }


def money(amount: Column, precision: int = 15) -> Column:
    return amount.cast(f"decimal({precision},2)")


def ratio(part: Column, whole: Column, digits: int, scale: int = 1) -> Column:
    """``part / whole * scale`` in decimal arithmetic, null where ``whole`` is 0 or null."""
    exact = (part * F.lit(scale)).cast("decimal(24,6)")
    return F.round(F.try_divide(exact, whole.cast("decimal(20,6)")), digits)


def clip01(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def band_up_to(value: Column, bands: Sequence[tuple[float, str]], last: str) -> Column:
    """Label by right-closed bands; values past the last edge take ``last``."""
    label = F
    for edge, name in bands:
        label = label.when(value <= edge, name)
    return label.otherwise(last)


def tier_from(value: Column, tiers: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Label by lower edges, highest first; null and small values take ``lowest``."""
    label = F
    for edge, name in tiers:
        label = label.when(value >= edge, name)
    return label.otherwise(lowest)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, rounded towards the past."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    per_day = F.lit(86_400_000_000)
    return ((micros - F.pmod(micros, per_day)) / per_day).cast("int")


def count_when(condition: Column) -> Column:
    return F.count_if(condition)


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(
        F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda total, term: total + term,
    )


def unit(vector: Column) -> Column:
    """Vector scaled to length one; a zero vector stays zero."""
    scaled = F.transform(
        # The one-element array binds the length once per vector instead of once per element.
        F.array(F.sqrt(dot(vector, vector))),
        lambda n: F.transform(vector, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))),
    )
    return scaled[0]
