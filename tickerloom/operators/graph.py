"""News graph as node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.text import normalized_name, strip_index_prefix
from tickerloom.operators.paging import PAGE_ITEMS, paged_list
from tickerloom.sources.upsert import upsert


def merge_nodes(nodes: DataFrame, found: DataFrame, key: str, create_only: tuple[str, ...] = (), newest: tuple[Column, ...] = ()) -> DataFrame:
    """Node merge: new keys are created, known ones updated except ``create_only`` columns."""
    changed = [c for c in nodes.columns if c != key and c not in create_only]
    return upsert(nodes, found, [key], overwrite=changed, newest=newest)


def edges(
    candidates: DataFrame, left: str, left_nodes: DataFrame, left_key: str,
    right: str, right_nodes: DataFrame, right_key: str,
) -> DataFrame:
    """Distinct edges whose two end nodes both exist."""
    return (
        candidates.select(left, right).dropna().distinct()
        .join(left_nodes.select(F.col(left_key).alias(left)), left, "left_semi")
        .join(right_nodes.select(F.col(right_key).alias(right)), right, "left_semi")
        .select(left, right)
    )


def sector_nodes(companies: DataFrame, sector: str = "sector") -> DataFrame:
    return companies.select(strip_index_prefix(F.col(sector)).alias("name")).dropna().distinct()


def company_sector_edges(companies: DataFrame, ticker: str = "ticker", sector: str = "sector") -> DataFrame:
    pairs = companies.select(F.trim(F.col(ticker)).alias("ticker"), strip_index_prefix(F.col(sector)).alias("sector"))
    return pairs.where("ticker <> ''").dropna().distinct()


def analysis_edges(analyses: DataFrame) -> dict[str, DataFrame]:
    """Edge candidates of analysed articles, from their ticker and people lists."""
    people = analyses.select(
        "article_url", "mentioned_tickers", F.explode("mentioned_people").alias("p")
    ).withColumn("normalized_name", normalized_name(F.col("p.name"))).where("normalized_name <> ''")
    tickers = analyses.select("article_url", "event_fingerprint", F.explode("mentioned_tickers").alias("ticker"))
    return {
        "mentions": tickers.select("article_url", "ticker").distinct(),
        "covers": analyses.where("event_fingerprint <> ''").select("article_url", "event_fingerprint").distinct(),
        "involves": tickers.where("event_fingerprint <> ''").select("event_fingerprint", "ticker").distinct(),
        "mentions_person": people.select("article_url", "normalized_name").distinct(),
        "associated_with": people.select("normalized_name", F.explode("mentioned_tickers").alias("ticker")).distinct(),
    }


def event_counters(covers: DataFrame, analysed_at: str, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Per fingerprint: distinct articles, raw analyses, first time seen."""
    return covers.where(F.col("fingerprint") != "").groupBy("fingerprint").agg(
        F.countDistinct("article_url").alias("article_count"),
        F.count("*").alias("analysis_count"),
        F.min(analysed_at).alias("first_seen"),
        *[F.min(a).alias(a) for a in attributes],
    )


def one_hop(edge: DataFrame, left: str, nodes: DataFrame, node_key: str, columns: list[str]) -> DataFrame:
    """Edge table with properties of its left node."""
    props = nodes.select(F.col(node_key).alias(left), *columns)
    return edge.join(props, left)


def neighbour_summary(
    nodes: DataFrame, key: str, counted: DataFrame, counted_node: str, collected: DataFrame, collected_node: str,
    count_name: str, list_name: str, page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """Distinct neighbours of one kind counted, of another kind listed in pages of ``page_items``.

    A row per node and page, one at least.  The two edge tables are aggregated before they meet, so
    their product never exists.
    """
    counts = counted.groupBy(key).agg(F.countDistinct(counted_node).alias(count_name))
    lists = paged_list(collected, key, collected_node, page_items).select(key, "page", F.col("items").alias(list_name))
    return (
        nodes.join(counts, key, "left").join(lists, key, "left")
        .fillna(0, [count_name, "page"])
        .withColumn(list_name, F.coalesce(list_name, F.array().cast("array<string>")))
    )


def set_property(nodes: DataFrame, key: str, values: DataFrame, column: str) -> DataFrame:
    """Batch update of one property by key; nodes without a new value keep theirs."""
    keep = nodes if column in nodes.columns else nodes.withColumn(column, F.lit(None).cast(values.schema[column].dataType))
    return upsert(keep, values.join(nodes.select(key), key, "left_semi"), [key], overwrite=[column])


def property_coverage(nodes: DataFrame, column: str) -> DataFrame:
    return nodes.agg(F.count("*").alias("total"), F.count(column).alias("with_value"))


def missing_property(nodes: DataFrame, column: str) -> DataFrame:
    return nodes.where(F.col(column).isNull())


def articles_naming_both(mentions: DataFrame, first: str, second: str) -> DataFrame:
    """Articles that mention both companies."""
    a = mentions.where(F.col("ticker") == first).select("article_url").distinct()
    b = mentions.where(F.col("ticker") == second).select("article_url")
    return a.join(b, "article_url", "left_semi")


def co_mention_partners(mentions: DataFrame, ticker: str) -> DataFrame:
    """How many articles each other company shares with one company.

    Only the asked company's articles are expanded, never all pairs of an article.
    """
    own = mentions.where(F.col("ticker") == ticker).select("article_url")
    return (
        mentions.where(F.col("ticker") != ticker).join(own, "article_url", "left_semi")
        .groupBy("ticker").agg(F.countDistinct("article_url").alias("articles"))
    )
