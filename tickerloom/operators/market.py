"""Price-side analytics: wide matrices, calendars, event study, backtests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from tickerloom import constants as K
from tickerloom.operators.keyed import top_per_key
from tickerloom.operators.stats import correlation_pairs, ratio

# Series with one row per trading day are bounded by the calendar; only those are windowed
# without a partition key.
def day_order() -> WindowSpec:
    return W.orderBy("date")


def wide_closes(commodities: DataFrame, keys: Sequence[str], close: str = "close") -> DataFrame:
    """One row per date, one column per asset."""
    return commodities.groupBy("date").pivot("asset_key", list(keys)).agg(F.max(close))


def wide_returns(wide: DataFrame) -> DataFrame:
    """Row-to-row change of every column as ``<name>_ret``; rows without any value are dropped."""
    names = [c for c in wide.columns if c != "date"]
    change = wide.select("date", *[
        (F.try_divide(F.col(c), F.lag(c).over(day_order())) - 1).alias(f"{c}_ret") for c in names
    ])
    return change.dropna(how="all", subset=[f"{c}_ret" for c in names])


def return_correlations(commodities: DataFrame, keys: Sequence[str], top: int = 15) -> DataFrame:
    """Strongest absolute return correlations between assets; pairs of 30 rows or fewer come last, without r."""
    returns = wide_returns(wide_closes(commodities, keys))
    plain = returns.withColumnsRenamed({f"{k}_ret": k for k in keys})
    pairs = correlation_pairs(plain, list(keys), min_rows=31)
    return pairs.orderBy(F.round(F.abs("r"), 9).desc_nulls_last(), "left", "right").limit(top)


def asset_summary(assets: DataFrame, quotes: DataFrame) -> DataFrame:
    """First and last date and row count of every configured asset, OK or MISSING."""
    have = quotes.groupBy("asset_key").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("rows")
    )
    return assets.join(have, "asset_key", "left").select(
        *assets.columns, "first_date", "last_date", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.when(F.col("rows").isNull(), "MISSING").otherwise("OK").alias("status"),
    )


# --- trading calendar --------------------------------------------------------------------

def event_day(published: Column, zone: str = K.MARKET_ZONE, close: str = K.MARKET_CLOSE) -> Column:
    """Local publication day; after the close it is the next day."""
    local = F.from_utc_timestamp(published, zone)
    late = F.date_format(local, "HH:mm:ss") > f"{close}:00"
    return F.date_add(F.to_date(local), late.cast("int"))


def session_map(prices: DataFrame) -> DataFrame:
    """(ticker, day, session): every calendar day up to the last session, with the next session.

    Each session covers the days since the one before, which turns the forward as-of join into
    an equi-join whose size is tickers times calendar days.
    """
    sessions = prices.select("ticker", F.col("date").alias("session")).distinct()
    before = F.lag("session").over(W.partitionBy("ticker").orderBy("session"))
    spans = sessions.withColumn("_from", F.coalesce(F.date_add(before, 1), F.col("session")))
    return spans.select("ticker", "session", F.explode(F.sequence("_from", "session")).alias("day"))


def next_session(events: DataFrame, day: str, prices: DataFrame, out: str = "session") -> DataFrame:
    """First trading day of the ticker on or after ``day``; NULL after its last one."""
    known = session_map(prices).select("ticker", F.col("day").alias(day), F.col("session").alias("_at"))
    opening = prices.groupBy("ticker").agg(F.min("date").alias("_open"))
    joined = events.join(known, ["ticker", day], "left").join(opening, "ticker", "left")
    return joined.withColumn(
        out, F.coalesce("_at", F.when(F.col(day) < F.col("_open"), F.col("_open")))
    ).drop("_at", "_open")


def trading_index(prices: DataFrame) -> DataFrame:
    return prices.withColumn("idx", F.row_number().over(W.partitionBy("ticker").orderBy("date")))


def rows_around(events: DataFrame, session: str, series: DataFrame, before: int = 1, after: int = 3) -> DataFrame:
    """Long form of the event window: one row per event and trading-day offset."""
    indexed = trading_index(series)
    at = events.join(
        indexed.select("ticker", F.col("date").alias(session), F.col("idx").alias("_i")), ["ticker", session]
    )
    spread = at.withColumn("offset", F.explode(F.sequence(F.lit(-before), F.lit(after))))
    around = indexed.withColumnRenamed("date", "offset_date")
    return spread.withColumn("idx", F.col("_i") + F.col("offset")).join(around, ["ticker", "idx"]).drop("_i", "idx")


def abnormal_returns(returns: DataFrame, far: int = 120, near: int = 60, before: int = 1, after: int = 3) -> DataFrame:
    """Adds expected (median of the estimation window), ar, car, liquid and ar_sigma.

    The cumulative value over the event window belongs to the (ticker, day) row, so events only
    need one equi-join to read it.  ``car`` is NULL unless the whole window has a value.
    """
    w = W.partitionBy("ticker").orderBy("date")
    span = w.rowsBetween(-before, after)
    width = before + after + 1
    expected = F.percentile("daily_return", F.lit(0.5)).over(w.rowsBetween(-far, -near))
    with_ar = returns.withColumn("expected", expected).withColumn("ar", F.col("daily_return") - F.col("expected"))
    return with_ar.select(
        "*",
        F.when(F.count("ar").over(span) == width, F.sum("ar").over(span)).alias("car"),
        (F.coalesce(F.min(F.coalesce("volume", F.lit(0.0))).over(span), F.lit(0.0)) > 0).alias("liquid"),
        F.stddev_samp("ar").over(W.partitionBy("ticker")).alias("ar_sigma"),
    )


def event_study(
    events: DataFrame, prices: DataFrame, day: str, sigma: str = "stock", cut: float = 1.5,
    far: int = 120, near: int = 60,
) -> DataFrame:
    """Events with session, car and significance; windows with a day without trades are left out.

    ``sigma="stock"`` compares with the stock's own abnormal returns, ``"events"`` with the
    spread of car over all events.
    """
    from tickerloom.operators.daily import add_returns

    series = abnormal_returns(add_returns(prices), far, near).select(
        "ticker", F.col("date").alias("session"), "car", "liquid", "ar_sigma"
    )
    placed = next_session(events, day, prices).where("session IS NOT NULL")
    study = placed.join(series, ["ticker", "session"]).where("liquid AND car IS NOT NULL").drop("liquid")
    if sigma == "events":
        scale = study.agg(F.stddev_samp("car")).scalar()
        return study.withColumn("significant", F.abs("car") > F.lit(cut) * scale)
    return study.withColumn("significant", F.abs("car") > F.lit(cut) * F.col("ar_sigma"))


# --- backtest ----------------------------------------------------------------------------

def backtest(predictions: DataFrame) -> DataFrame:
    """Equal-weight daily means of the long/flat rule and of holding everything, with curves."""
    daily = predictions.groupBy("date").agg(
        F.avg(F.col("next_day_return") * F.col("pred_direction")).alias("strategy"),
        F.avg("next_day_return").alias("bh"),
        F.sum("pred_direction").alias("n_pos"),
        F.count("pred_direction").alias("n_total"),
    )
    return daily.select(
        "*", cumulative("strategy").alias("cum_strategy"), cumulative("bh").alias("cum_bh")
    )


def cumulative(column: str, *by: str) -> Column:
    """Running product of 1 + r; a missing day leaves the curve where it was."""
    w = (W.partitionBy(*by).orderBy("date") if by else day_order()).rowsBetween(W.unboundedPreceding, 0)
    return F.product(1 + F.coalesce(F.col(column), F.lit(0.0))).over(w)


def drawdown(df: DataFrame, curve: str, out: str = "drawdown", by: Sequence[str] = ()) -> DataFrame:
    """(curve - running maximum) / running maximum."""
    w = (W.partitionBy(*by).orderBy("date") if by else day_order()).rowsBetween(W.unboundedPreceding, 0)
    peak = F.max(curve).over(w)
    return df.withColumn(out, F.try_divide(F.col(curve) - peak, peak))


def long_series(daily: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(series, date, r) rows from a daily frame with one return column per series."""
    return daily.unpivot(["date"], list(columns), "series", "r")


def performance(series: DataFrame, risk_free: float = 0.0, periods: int = K.TRADING_DAYS) -> DataFrame:
    """Per series: total and annualised return, volatility, win rate, Sharpe, drawdown, Calmar."""
    curve = series.withColumn("_cum", cumulative("r", "series"))
    measured = drawdown(curve, "_cum", "_dd", ["series"])
    base = measured.groupBy("series").agg(
        (F.product(1 + F.coalesce(F.col("r"), F.lit(0.0))) - 1).alias("total_return"),
        F.avg("r").alias("_mean"), F.stddev_samp("r").alias("_std"), F.count("r").alias("n_days"),
        F.avg((F.coalesce(F.col("r"), F.lit(0.0)) > 0).cast("int")).alias("win_rate"),
        F.min("_dd").alias("max_drawdown"),
    )
    yearly = F.pow(1 + F.col("total_return"), F.lit(float(periods)) / F.col("n_days")) - 1
    return base.select(
        "series", "total_return", yearly.alias("annual_return"),
        (F.col("_std") * F.sqrt(F.lit(periods))).alias("annualised_vol"),
        ratio((F.col("_mean") - risk_free / periods) * F.sqrt(F.lit(periods)), F.col("_std")).alias("sharpe"),
        "max_drawdown", "win_rate",
        F.try_divide(yearly, F.abs("max_drawdown")).alias("calmar"),
    )


def signal_quality(predictions: DataFrame) -> DataFrame:
    """Per ticker: rows, predicted and actual up rate, accuracy, compounded return."""
    earned = F.coalesce(F.col("next_day_return") * F.col("pred_direction"), F.lit(0.0))
    return predictions.groupBy("ticker").agg(
        F.count("*").alias("n"),
        F.avg("pred_direction").alias("pred_up_rate"),
        F.avg("direction").alias("actual_up_rate"),
        F.avg((F.col("pred_direction") == F.col("direction")).cast("int")).alias("accuracy"),
        (F.product(1 + earned) - 1).alias("total_return"),
    )


def strategy_returns(
    predictions: DataFrame, score: str, picks: int = 1, above: float | None = None, at_least: float | None = None
) -> DataFrame:
    """Daily mean return of the best ``picks`` rows by ``score``; 0 on days without a position."""
    fit = predictions
    if above is not None:
        fit = fit.where(F.col(score) > above)
    if at_least is not None:
        fit = fit.where(F.col(score) >= at_least)
    chosen = top_per_key(fit, "date", picks, F.desc(score), F.asc("ticker"))
    earned = chosen.groupBy("date").agg(F.avg("next_day_return").alias("r"), F.count("*").alias("n_pos"))
    return predictions.select("date").distinct().join(earned, "date", "left").fillna(0, ["r", "n_pos"])


def three_strategies(predictions: DataFrame, p_up: str = "p_up", pred_return: str = "pred_return") -> DataFrame:
    """(series, date, r) of: best probability from 0.55, best return above 0.5 %, top three."""
    rules = {
        "S1": strategy_returns(predictions, p_up, at_least=0.55),
        "S2": strategy_returns(predictions, pred_return, above=0.005),
        "S3": strategy_returns(predictions, p_up, picks=3),
    }
    frames = [df.select(F.lit(name).alias("series"), "date", "r", "n_pos") for name, df in rules.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def monthly_returns(daily: DataFrame, column: str) -> DataFrame:
    """Year rows, month columns m01..m12, compounded returns."""
    months = [f"m{m:02d}" for m in range(1, 13)]
    keyed = daily.select(
        F.year("date").alias("year"), F.format_string("m%02d", F.month("date")).alias("month"), F.col(column).alias("r")
    )
    compounded = F.product(1 + F.coalesce(F.col("r"), F.lit(0.0))) - 1
    return keyed.groupBy("year").pivot("month", months).agg(compounded)
