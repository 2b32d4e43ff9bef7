"""Label expressions: sentiment and event normalisation, fingerprints, one-hots, bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom import constants as K
from tickerloom.functions.parse import lookup


def normalise_sentiment(label: Column) -> Column:
    low = F.lower(F.coalesce(label, F.lit("")))
    rough = (
        F.when(low.contains("pos"), "positive")
        .when(low.contains("neg") | low.contains("nég"), "negative")
        .otherwise("neutral")
    )
    return F.coalesce(lookup(K.SENTIMENT_ALIASES, F.trim(low)), rough)


def normalise_event_type(label: Column) -> Column:
    """A known type as is, else the first alias contained, else ``other``."""
    low = F.trim(F.lower(F.coalesce(label, F.lit(""))))
    out = F.when(low.isin(K.EVENT_TYPES), low)
    for alias, event_type in K.EVENT_ALIASES.items():
        out = out.when(low.contains(alias), event_type)
    return out.otherwise("other")


def iso_week(day: Column) -> Column:
    """YYYY-Www of the ISO calendar."""
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def fingerprint(event_type: Column, tickers: Column, event_date: Column, published: Column) -> Column:
    """16 hex digits naming an event: type, sorted distinct tickers, ISO week.

    ``event_date`` is text; an absent or invalid date falls back to the publication time.
    ``other`` gives "".
    """
    day = F.coalesce(F.try_to_date(F.substring(event_date, 1, 10), "yyyy-MM-dd"), F.to_date(published))
    names = F.array_join(F.array_sort(F.array_distinct(F.coalesce(tickers, F.array().cast("array<string>")))), "|")
    raw = F.concat_ws("::", event_type, names, iso_week(day))
    return F.when(event_type == "other", "").otherwise(F.substring(F.sha2(raw, 256), 1, 16))


def one_hot(value: Column, domain: Sequence[str], prefix: str) -> list[Column]:
    return [F.coalesce(value == v, F.lit(False)).cast("int").alias(f"{prefix}{v}") for v in domain]


def polarity(label: Column) -> Column:
    return F.coalesce(lookup(K.POLARITY, label), F.lit(0.0))


def sentiment_band(score: Column, cut: float = 0.05) -> Column:
    return (
        F.when(score > cut, "positive").when(score < -cut, "negative").otherwise("neutral")
    )


def completeness_band(share: Column) -> Column:
    return F.when(share >= 0.9, "high").when(share >= 0.5, "medium").otherwise("low")


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(high)), F.lit(low)))


def null_if_negative(value: Column) -> Column:
    return F.when(value >= 0, value)
