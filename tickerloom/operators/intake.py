"""Cleaning jobs: company master, exchange rates, price history, archived pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom import constants as K
from tickerloom.functions import parse as P
from tickerloom.functions.html import element_text, page_title, published_time
from tickerloom.functions.labels import null_if_negative
from tickerloom.functions.text import first_filled, strip_index_prefix
from tickerloom.operators.entities import assign_details
from tickerloom.operators.keyed import first_per_key
from tickerloom.sources.sinks import split_valid

RESEARCH_COLUMNS = ["description", "ceo", "founded", "headquarters", "revenue", "employees", "stock_exchange"]


def build_companies(
    base: DataFrame, details: DataFrame, registry: DataFrame, research: DataFrame,
    base_order: str = "ord", detail_order: str = "detail_ord",
) -> DataFrame:
    """Company master from four sources.

    Details attach by name containment; the registry supplies the seat and, where the detail
    has no sector, its own sector without the index prefix; research columns attach by ticker.
    """
    chosen = assign_details(base, details, base_order, detail_order)
    detail = chosen.join(details, detail_order).select(
        "ticker", F.col("sector").alias("_dsector"), F.col("parent").alias("parent")
    )
    office = registry.groupBy("ticker").agg(
        F.max("siege_social").alias("siege_social"), F.max("secteur").alias("_rsector")
    )
    extra = first_per_key(research, "ticker", F.asc("ticker")).select("ticker", *RESEARCH_COLUMNS)
    joined = (
        base.select("ticker", "company_name").join(detail, "ticker", "left")
        .join(office, "ticker", "left").join(extra, "ticker", "left")
    )
    return joined.select(
        "ticker", "company_name",
        F.coalesce(first_filled(F.col("_dsector")), strip_index_prefix(F.col("_rsector"))).alias("sector"),
        "parent", "description", "ceo",
        P.to_number(F.col("founded")).cast("int").alias("founded"), "headquarters", "revenue",
        P.to_number(F.col("employees")).cast("int").alias("employees"), "stock_exchange", "siege_social",
    )


def currency_code(description: Column) -> Column:
    """Code of a known description, else the description itself."""
    text = F.trim(description)
    return P.lookup(K.CURRENCY_CODES, text, text)


def clean_fx_rates(
    raw: DataFrame, date: str = "date", devise: str = "devise", pays: str = "pays",
    buy: str = "buy", sell: str = "sell",
) -> tuple[DataFrame, DataFrame]:
    """(rates, rejects): day-first dates, currency codes, units, comma decimals."""
    parsed = raw.select(
        F.try_to_date(F.col(date), "dd/MM/yyyy").alias("rate_date"),
        F.nullif(currency_code(F.coalesce(F.col(devise), F.lit(""))), F.lit("")).alias("currency"),
        F.nullif(F.trim(F.col(pays)), F.lit("")).alias("country"),
        P.parse_unit(F.col(devise)).alias("unit"),
        P.parse_rate(F.col(buy)).alias("buy_rate"),
        P.parse_rate(F.col(sell)).alias("sell_rate"),
    )
    return split_valid(parsed, {
        "invalid date": F.col("rate_date").isNotNull(),
        "missing currency": F.col("currency").isNotNull(),
    })


def clean_price_history(raw: DataFrame) -> DataFrame:
    """Localized price text to numbers; day-first dates; negative values become NULL."""
    cleaned = raw.select(
        "ticker",
        P.parse_day(F.col("date"), "dd/MM/yyyy", "yyyy-MM-dd").alias("date"),
        *[null_if_negative(P.parse_price_local(F.col(c))).alias(c) for c in ("close", "open", "high", "low")],
        null_if_negative(P.parse_volume_local(F.col("volume"))).alias("volume"),
        P.parse_quote(F.col("change_pct")).alias("change_pct"),
    )
    return cleaned.where("date IS NOT NULL")


def page_articles(
    captures: DataFrame, pages: DataFrame, selector: str, as_of: Column, key: str = "url"
) -> DataFrame:
    """Articles from archived pages: title (else the URL), body text, publication time.

    Pages without text are left out.
    """
    read = captures.join(pages.select(key, "html"), key)
    shaped = read.select(
        key,
        F.coalesce(page_title(F.col("html")), F.col(key)).alias("title"),
        element_text(F.col("html"), selector).alias("full_text"),
        P.resolve_published(
            F.coalesce("original_published_date", published_time(F.col("html"))), F.col("capture_timestamp"), as_of
        ).alias("published_at"),
    )
    return shaped.where(F.coalesce("full_text", F.lit("")) != "")


def valid_analyses(analyses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Range and domain checks of scored records."""
    return split_valid(analyses, {
        "sentiment": F.col("sentiment").isin("positive", "negative", "neutral"),
        "score": F.col("score").between(-1.0, 1.0),
        "confidence": F.col("confidence").between(0.0, 1.0),
        "event_type": F.col("event_type").isin(K.EVENT_TYPES),
    })
