"""Registry of named queries with the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.plans.check_views import VIEWS
from tickerloom.sources.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Values that end in exactly half a unit would round by engine; a small shift settles them.
TIE_SHIFT = 0.00317


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name, body in VIEWS.items():
        if name not in seen and re.search(rf"\b{name}\b", sql):
            _needed(body, seen)
            if name not in seen:
                seen.append(name)
    return seen


def with_views(sql: str) -> str:
    names = _needed(sql, [])
    if not names:
        return sql
    views = "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names)
    own = sql.lstrip()
    return f"{views},\n{own[5:]}" if own.startswith("WITH ") else f"{views}\n{sql}"


def query(name: str, sql: str | None = None, rounded: str = "", digits: int = 6):
    """Register ``fn(warehouse) -> DataFrame``.

    ``rounded`` names the floating columns; both sides round them to ``digits`` so that the
    order of additions does not show.
    """
    columns = rounded.split()

    def add(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _rounded(fn(Warehouse(spark, folder)), columns, digits)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(_rounded_sql(sql, columns, digits))
        return fn

    return add


def _rounded(df: DataFrame, columns: Sequence[str], digits: int) -> DataFrame:
    def one(c: str):
        shifted = F.col(c).cast("double") + F.lit(TIE_SHIFT * 10.0**-digits)
        scaled = shifted * F.lit(10.0**digits)
        whole = F.rint(scaled)
        # off the halves, and in range, this is what ``round`` gives without its way over decimal text
        plain = (F.abs(scaled) < 1e9) & (F.abs(F.abs(scaled - whole) - 0.5) > 1e-6)
        value = F.when(plain, whole / F.lit(10.0**digits)).otherwise(F.round(shifted, digits))
        return value + F.lit(0.0)   # no negative zero

    return df.withColumns({c: one(c) for c in columns}) if columns else df


def _rounded_sql(sql: str, columns: Sequence[str], digits: int) -> str:
    if not columns:
        return sql
    def one(c: str) -> str:
        value = f"round(CAST(\"{c}\" AS DOUBLE) + {TIE_SHIFT * 10.0**-digits!r}::DOUBLE, {digits})"
        return f"CASE WHEN {value} = 0 THEN 0.0::DOUBLE ELSE {value} END AS \"{c}\""

    return f"SELECT * REPLACE ({', '.join(map(one, columns))}) FROM ({sql}) AS q"
