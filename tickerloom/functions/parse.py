"""Parsing expressions: numbers, dates, paths, codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(mapping: Mapping[str, object], key: Column, default: Column | None = None) -> Column:
    """Map a code through a literal table; a missing code gives ``default`` (or NULL)."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), key)
    return F.coalesce(found, default) if default is not None else found


def to_number(text: Column) -> Column:
    """Double for plain decimal notation, else NULL (no type suffixes, no NaN)."""
    text = F.trim(text)
    plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(plain, text.try_cast("double"))


def _scaled(text: Column) -> Column:
    factor = F.when(text.endswith("K"), 1_000.0).when(text.endswith("M"), 1_000_000.0)
    body = F.regexp_replace(text, "[KM]$", "")
    return to_number(body) * F.coalesce(factor, F.lit(1.0))


def parse_volume(text: Column) -> Column:
    """"1,234", "2.5K", "1.2M" to a double."""
    return _scaled(F.trim(F.regexp_replace(text, ",", "")))


def parse_volume_local(text: Column) -> Column:
    """Same for notation with "." thousands and "," decimals."""
    return _scaled(local_decimal(text))


def local_decimal(text: Column) -> Column:
    return F.replace(F.replace(F.trim(text), F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def parse_price_local(text: Column) -> Column:
    return to_number(local_decimal(text))


def parse_quote(text: Column) -> Column:
    """Drop blanks and "%", comma decimals to a double."""
    return to_number(F.replace(F.regexp_replace(text, r"[\s\p{Z}%]", ""), F.lit(","), F.lit(".")))


def parse_rate(text: Column) -> Column:
    return to_number(F.replace(text, F.lit(","), F.lit(".")))


def parse_unit(text: Column) -> Column:
    """Leading number of a description ("100 YENS" gives 100)."""
    return to_number(F.regexp_extract(text, r"^\s*(\S+)", 1)).cast("int")


def parse_day(text: Column, *formats: str) -> Column:
    """First format that parses, else NULL."""
    return F.coalesce(*[F.try_to_date(text, f) for f in (formats or ("yyyy-MM-dd",))])


def parse_iso(text: Column) -> Column:
    """ISO-like time stamps (zone, ``Z``, blank separator, date only) to a UTC timestamp.

    A missing zone means UTC, which the session time zone supplies.
    """
    text = F.trim(text)
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    zone = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    dated = F.when(F.length(text) > 10, zone).otherwise(text)
    return F.when(text.rlike(shape), dated.try_cast("timestamp"))


def capture_time(stamp: Column) -> Column:
    """First 14 digits of a capture stamp as a timestamp."""
    return F.try_to_timestamp(F.substring(stamp, 1, 14), F.lit("yyyyMMddHHmmss"))


def resolve_published(published: Column, stamp: Column, as_of: Column) -> Column:
    return F.coalesce(published, capture_time(stamp), as_of)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def year_of_text(text: Column) -> Column:
    """Year of DD/MM/YYYY or YYYY-MM-DD, else "unknown"."""
    slashed = F.when(
        (F.length(text) >= 10) & text.contains("/"),
        F.nullif(F.regexp_extract(text, r"^[^/]*/[^/]*/([^/]{4})$", 1), F.lit("")),
    )
    dashed = F.when((F.length(text) >= 4) & text.contains("-"), F.substring(text, 1, 4))
    return F.coalesce(slashed, dashed, F.lit("unknown"))


def storage_path(stamp: Column, digest: Column) -> Column:
    """raw/YYYY/MM/<digest>.html.gz with defaults for short stamps."""
    stamp = F.coalesce(stamp, F.lit(""))
    year = F.when(F.length(stamp) >= 4, F.substring(stamp, 1, 4)).otherwise("unknown")
    month = F.when(F.length(stamp) >= 6, F.substring(stamp, 5, 2)).otherwise("00")
    name = F.concat(F.coalesce(F.nullif(digest, F.lit("")), F.lit("nodigest")), F.lit(".html.gz"))
    return F.concat_ws("/", F.lit("raw"), year, month, name)


def last_path_segment(url: Column) -> Column:
    path = F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "/+$", "")
    return F.coalesce(F.nullif(F.element_at(F.split(path, "/"), -1), F.lit("")), F.lit("file"))
