"""Market-news tables laid over the TPC-H-like test tables.

Every table is derived by Spark from the given parquet files, so it grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.constants import EVENT_TYPES, MODEL_FEATURES, TYPE_FLAGS
from tickerloom.functions.parse import storage_path
from tickerloom.functions.text import TextRules
from tickerloom.operators import daily as D
from tickerloom.operators import learn as L
from tickerloom.operators.harvest import run_record
from tickerloom.plans.gold import enriched_rows
from tickerloom.session import dealt_in, tuned, work_folder

# Rules for article titles that are order priorities ("4-NOT SPECIFIED").
ORDER_RULES = TextRules(
    families={"ma": [r"\burgent\b"], "earnings": [r"\bhigh\b"], "management": [r"\bmedium\b"], "legal": [r"\blow\b"]},
    negation=(r"\bnot\b",), speculation=(r"\bspecified\b",),
    positive=("urgent", "high"), negative=("low",),
)

# Rules for the invented prose of `documents`.
PROSE_RULES = TextRules(
    families={
        "ma": [r"\bthat\b", r"\bdes\b"], "earnings": [r"\bund\b", r"\bder\b"],
        "management": [r"\bque\b"], "legal": [r"\bwith\b", r"\bpara\b"],
    },
    negation=(r"\bthe\b.{0,25}\bof\b",), speculation=(r"\bfrom\b",),
    positive=("tion", "eau"), negative=("ment", "ung", "the"),
)


ROWS_PER_PART = 100_000   # lines of a part: its wide rows fit in a task's memory, in each of a stage's sorts

# Where a session has stored the gold tables of a folder: (application, folder, its files, table) -> path.
_STORED: dict[tuple[str, str, int, str], str] = {}


class Warehouse:
    """Tables of one scale-factor folder: lazily built, the gold ones stored once per session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tuned(spark), folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _files(self) -> int:
        """Digest of the names, sizes and times of the folder's files: other input is stored anew."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(self.folder)
        return files.agg(F.bit_xor(F.xxhash64("path", "modificationTime", "length"))).first()[0] or 0

    def once_in(self, name: str, write: Callable[[str], object]) -> str:
        """The folder of what ``write(folder)`` stores, written by the first query that needs it."""
        at = (self.spark.sparkContext.applicationId, self.folder, self._files, name)
        if at not in _STORED:
            path = work_folder(self.spark, name)
            with dealt_in(self.spark, self.ticker_parts):
                write(path)
            _STORED[at] = path
        return _STORED[at]

    def _once(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` written to the shared folder by the first query that needs them."""
        return self.spark.read.schema(rows.schema).parquet(self.once_in(name, rows.write.parquet))

    @cached_property
    def documents(self) -> DataFrame:
        """Long texts, always spread by doc_id: a file with a single row group is one task however
        long its texts are, and the work on a text outweighs its one shuffle."""
        return self.table("documents").repartition("doc_id")

    # --- silver ----------------------------------------------------------------------

    @cached_property
    def companies(self) -> DataFrame:
        s, n, r = self.table("supplier"), self.table("nation"), self.table("region")
        return (
            s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(
                F.col("s_suppkey").cast("string").alias("ticker"), F.col("s_name").alias("company_name"),
                F.col("n_name").alias("sector"), F.col("r_name").alias("parent"),
            )
        )

    @cached_property
    def articles(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.table("orders").select(
            F.concat(F.lit("o"), key.cast("string")).alias("url"),
            F.col("o_orderpriority").alias("title"),
            F.lit(None).cast("string").alias("full_text"),
            F.col("o_orderdate").cast("timestamp").alias("published_at"),
            F.col("o_orderpriority").alias("feed_url"),
            F.when(F.col("o_orderstatus") == "F", "positive").when(F.col("o_orderstatus") == "O", "negative").alias("sentiment"),
            F.when(F.col("o_orderstatus") != "P", (key % 201 - 100).cast("double") / 100).alias("score"),
            F.when(F.col("o_orderstatus") != "P", (key % 101).cast("double") / 100).alias("confidence"),
        )

    @cached_property
    def mentions(self) -> DataFrame:
        return self.table("lineitem").select(
            F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("article_url"),
            F.col("l_suppkey").cast("string").alias("ticker"),
        ).repartition("article_url").distinct()   # dealt as the joins on the article need them

    @cached_property
    def ticker_parts(self) -> int:
        """Parts that rows dealt by ticker come in, the same on both sides of a join.

        A number that grows with the lines, which prices and (article, ticker) rows come from: adaptive
        execution would join small compressed blocks into one part per core, whose wide rows then spill.
        """
        lines = self.table("lineitem").count()   # from the files' footers
        return max(self.spark.sparkContext.defaultParallelism, -(-lines // ROWS_PER_PART))

    def _price_days(self, *dealt: str | int) -> DataFrame:
        order = F.struct("_order", "_price")
        lines = self.table("lineitem").select(
            F.col("l_suppkey").cast("string").alias("ticker"), F.to_date("l_shipdate").alias("date"),
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("_order"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("_price"), "l_quantity",
        )
        return (lines.repartition(*dealt) if dealt else lines).groupBy("ticker", "date").agg(
            # min/max over (order, price) pairs: plain aggregates
            F.min(order).getField("_price").alias("open"),
            F.max("_price").alias("high"), F.min("_price").alias("low"),
            F.max(order).getField("_price").alias("close"),
            F.sum("l_quantity").alias("volume"),
        )

    @cached_property
    def base_prices(self) -> DataFrame:
        return self._price_days()

    @cached_property
    def ticker_prices(self) -> DataFrame:
        """The same, dealt by ticker from the start for windows over days: lines move once."""
        return self._price_days(self.ticker_parts, "ticker")

    @cached_property
    def prices(self) -> DataFrame:
        w = W.partitionBy("ticker").orderBy("date")
        change = (F.try_divide(F.col("close"), F.lag("close").over(w)) - 1) * 100
        return self.ticker_prices.withColumn("change_pct", change)

    @cached_property
    def article_events(self) -> DataFrame:
        types = F.array(*[F.lit(t) for t in EVENT_TYPES])
        event_type = F.element_at(types, (F.col("o_orderkey") % len(EVENT_TYPES) + 1).cast("int"))
        week = F.to_date(F.date_trunc("week", "o_orderdate")).cast("string")
        return self.table("orders").select(
            F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("article_url"),
            event_type.alias("event_type"), F.to_date("o_orderdate").alias("event_date"),
            F.concat_ws("::", event_type, week).alias("fingerprint"),
            F.col("o_orderdate").cast("timestamp").alias("analyzed_at"),
        ).where("event_type <> 'other'")

    @cached_property
    def events(self) -> DataFrame:
        return self.article_events.groupBy("fingerprint").agg(
            F.min("event_type").alias("event_type"), F.min("event_date").alias("event_date"),
            F.min("analyzed_at").alias("first_seen"), F.count("*").alias("article_count"),
        )

    @cached_property
    def event_companies(self) -> DataFrame:
        return self.article_events.select("article_url", F.col("fingerprint").alias("event_fingerprint")).join(
            self.mentions, "article_url"
        ).select("event_fingerprint", "ticker").repartition("event_fingerprint").distinct()

    @cached_property
    def commodities(self) -> DataFrame:
        price = F.col("l_extendedprice") / F.col("l_quantity")
        part = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        return self.table("lineitem").join(part, "l_partkey").groupBy(
            F.col("p_brand").alias("asset_key"), F.to_date("l_shipdate").alias("date")
        ).agg(F.avg(price).alias("close")).select(
            "asset_key", "date", F.col("asset_key").alias("name"), F.lit("commodity").alias("category"), "close"
        )

    @cached_property
    def feeds(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderpriority").alias("url")).distinct().select(
            "url", F.concat(F.lit("Feed "), F.col("url")).alias("name"), F.lit("fr").alias("language")
        )

    @cached_property
    def log(self) -> DataFrame:
        kind = F.col("event_type")
        name = F.concat(F.lit("p"), (F.col("user_id") % 5).cast("string"))
        return self.table("events").select(
            F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), name.alias("pipeline_name"),
            F.concat_ws("-", name, F.to_date("ts").cast("string"), (F.hour("ts") % 4).cast("string")).alias("run_id"),
            F.when(kind == "error", "error").when(kind == "signup", "warning").otherwise("info").alias("level"),
            kind.alias("metric_name"), F.col("value").alias("metric_value"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        return run_record(self.log)

    # --- prose -----------------------------------------------------------------------

    @cached_property
    def doc_articles(self) -> DataFrame:
        labels = self.table("labels")
        status = (
            F.when(F.col("toxic") == 1, "neutral").when(F.col("quality") == 1, "positive")
            .when(F.col("quality") == 0, "negative")
        )
        start = F.lit("2024-01-01 00:00:00").cast("timestamp")
        return self.documents.join(labels, "doc_id", "left").select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("url"),
            F.col("source").alias("title"), F.col("text").alias("full_text"),
            (start + F.make_dt_interval(hours=F.col("doc_id").cast("int"))).alias("published_at"),
            F.col("lang").alias("language"), F.col("source").alias("feed_url"),
            status.alias("sentiment"), (F.col("quality") - F.col("toxic")).cast("double").alias("score"),
            F.when(F.col("quality").isNotNull(), 1.0).alias("confidence"),
        )

    @cached_property
    def doc_companies(self) -> DataFrame:
        return self.table("benchmark").select(
            F.concat(F.lit("B"), F.col("item_id").cast("string")).alias("ticker"),
            F.regexp_extract("text", r"^(\S+\s+\S+\s+\S+)", 1).alias("company_name"),
            F.concat(F.lit("MASI "), F.regexp_extract("text", r"(\S+\s+\S+\s+\S+\s+\S+)\s*$", 1)).alias("sector"),
            F.col("item_id").alias("ord"),
        )

    @cached_property
    def doc_mentions(self) -> DataFrame:
        return self.table("labels").where("toxic = 1").select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("article_url"),
            F.concat(F.lit("B"), (F.col("doc_id") % 40).cast("string")).alias("ticker"),
        )

    @cached_property
    def doc_events(self) -> DataFrame:
        types = F.array(*[F.lit(t) for t in EVENT_TYPES])
        return self.table("labels").select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("article_url"),
            F.element_at(types, (F.col("doc_id") % len(EVENT_TYPES) + 1).cast("int")).alias("event_type"),
        )

    @cached_property
    def captures(self) -> DataFrame:
        page = F.col("page_id")
        day = F.date_add(F.lit("2021-01-01").cast("date"), (page % 900).cast("int"))
        stamp = F.concat(F.date_format(day, "yyyyMMdd"), F.lpad((page % 24).cast("string"), 2, "0"), F.lit("3015"))
        digest = F.md5("html")
        return self.table("pages").select(
            "url", stamp.alias("capture_timestamp"),
            F.when(page % 4 == 0, F.date_sub(day, 3).cast("timestamp")).alias("original_published_date"),
            F.when(page % 3 != 0, storage_path(stamp, digest)).alias("raw_html_path"),
            digest.alias("digest"), F.when(page % 10 == 9, 404).otherwise(200).alias("status"),
            F.lit("text/html").alias("mimetype"), F.length("html").cast("long").alias("length"),
            F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("domain"), page.alias("page_id"),
        )

    # --- gold ------------------------------------------------------------------------

    @cached_property
    def enriched(self) -> DataFrame:
        return self._once("enriched", enriched_rows(
            self.articles, self.companies, self.mentions, self.article_events, ORDER_RULES
        ))

    @cached_property
    def daily(self) -> DataFrame:
        """News features per ticker and day.  Neither they nor their trailing means are stored: enriched
        rows dealt by ticker are fewer bytes than days, and all that follows stays where they lie."""
        return D.daily_features(self.enriched, parts=self.ticker_parts)

    @cached_property
    def features(self) -> DataFrame:
        return D.rolled_features(self.daily)

    @cached_property
    def signals(self) -> DataFrame:
        return D.build_daily_signals(self.features, self.prices)

    @cached_property
    def labelled(self) -> DataFrame:
        """Signals of the days whose next day is known."""
        return D.build_daily_signals(self.features, self.prices, drop_unlabelled=True)

    @cached_property
    def company_dim(self) -> DataFrame:
        return D.build_company_dim(self.companies, self.enriched)

    @cached_property
    def event_tables(self) -> tuple[DataFrame, DataFrame]:
        from tickerloom.sources.silver import event_extract

        return D.event_tables(event_extract(self.events, self.event_companies))

    @cached_property
    def commodity_daily(self) -> DataFrame:
        return D.commodity_features(self.commodities)

    # --- models ----------------------------------------------------------------------

    @cached_property
    def news_days(self) -> DataFrame:
        """Labelled days with news: what models learn from and are tested on, with the columns they use."""
        features = D.rolled_features(self.daily.drop(*TYPE_FLAGS), ())
        labelled = D.build_daily_signals(features, self.ticker_prices, drop_unlabelled=True).where("news_count > 0")
        return self._once("news-days", labelled.select("ticker", "date", "daily_return", "next_day_return", "direction", "positive_count", "negative_count", *MODEL_FEATURES))

    def _predicted(self, model: str, rows: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """Test predictions of a model, fitted before the cut-off date, as stored under its name."""
        def write(folder: str) -> None:
            train, test = L.time_split(self.news_days)
            L.store_predictions(folder, model, rows(train, test))

        return L.stored_predictions(self.spark, self.once_in(f"predictions-{model}", write), model)

    @cached_property
    def predictions(self) -> DataFrame:
        """Stored test predictions of the one-factor sentiment model."""
        return self._predicted("sentiment", lambda train, test: L.predict_by_sentiment(test, L.fit_sentiment(train)))

    @cached_property
    def forest_predictions(self) -> DataFrame:
        """Stored test predictions of the two forests."""
        return self._predicted("forest", L.forest_predictions)
