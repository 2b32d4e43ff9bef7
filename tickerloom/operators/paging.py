"""Lists of any length in pages: no row holds more than a page of members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.operators.quantiles import ranked_values

PAGE_ITEMS = 1_000


def paged_list(rows: DataFrame, key: str, item: str, size: int = PAGE_ITEMS) -> DataFrame:
    """(key, page, items, total): the distinct items of every key in order, at most ``size`` to a page.

    Pages are numbered from 0.  The place of an item comes from a sample sort, so a key may have any
    number of items.  NULL keys and items are left out.
    """
    ranks = ranked_values(rows.select(key, item).distinct(), item, [key])
    page = F.floor(F.col("before") / size).cast("int").alias("page")
    return ranks.groupBy(key, page).agg(F.array_sort(F.collect_list(item)).alias("items"), F.max("total").alias("total"))


def listed(pages: DataFrame, key: str, separator: str = ", ") -> DataFrame:
    """(key, text): all pages of a key as one text, for the few keys that someone looks at."""
    whole: Column = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page", "items"))), lambda p: p["items"]))
    return pages.groupBy(key).agg(F.array_join(whole, separator).alias("text"))
