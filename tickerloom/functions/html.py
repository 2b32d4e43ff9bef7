"""Page expressions: title, publication date, text of one element."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.constants import DATE_META_TAGS
from tickerloom.functions.parse import parse_iso
from tickerloom.functions.text import _unescape_batch, trim_space


def _decoded(text: Column) -> Column:
    coded = F.when(text.contains("&"), text)
    return F.when(coded.isNotNull(), _unescape_batch(coded)).otherwise(text)


def page_title(html: Column) -> Column:
    """Text of ``<title>``, else the ``og:title`` meta tag, else NULL."""
    title = trim_space(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1))
    shared = F.element_at(F.concat(_meta_contents(html, "property", "og:title"), F.array(F.lit(""))), 1)
    return _decoded(F.coalesce(F.nullif(title, F.lit("")), F.nullif(F.trim(shared), F.lit(""))))


def _meta_contents(html: Column, attribute: str, value: str) -> Column:
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*>"), F.lit(0))
    plain = re.escape(value)
    wanted = rf"(?i)\b{attribute}\s*=\s*(?:\"{plain}\"|'{plain}'|{plain}(?=[\s/>]))"
    content = r"(?i)\bcontent\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
    hits = F.filter(tags, lambda t: t.rlike(wanted))
    return F.transform(hits, lambda t: F.regexp_replace(F.regexp_extract(t, content, 1), r"^[\"']|[\"']$", ""))


def _first_time(candidates: Column) -> Column:
    parsed = F.filter(F.transform(candidates, parse_iso), lambda t: t.isNotNull())
    return F.try_element_at(parsed, F.lit(1))


def json_ld_dates(html: Column) -> Column:
    """datePublished, else dateCreated, of every linked-data object (single or in a list)."""
    blocks = F.regexp_extract_all(
        html, F.lit(r"(?is)<script\b[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), F.lit(1)
    )
    schema = "array<struct<datePublished:string,dateCreated:string>>"
    objects = F.flatten(F.transform(blocks, lambda b: F.coalesce(F.from_json(b, schema), F.array().cast(schema))))
    return F.transform(
        objects,
        lambda o: F.coalesce(F.nullif(o["datePublished"], F.lit("")), o["dateCreated"]),
    )


def published_time(html: Column) -> Column:
    """Meta tags in order of trust, then linked data, then ``<time datetime>``."""
    times = F.regexp_extract_all(
        html, F.lit(r"(?i)<time\b[^>]*\bdatetime\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1)
    )
    chain = [_first_time(_meta_contents(html, a, v)) for a, v in DATE_META_TAGS]
    return F.coalesce(*chain, _first_time(json_ld_dates(html)), _first_time(times))


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _ElementText(HTMLParser):
    """Collects the text pieces of the first element that fits ``tag.class``."""

    def __init__(self, tag: str, css_class: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class = tag, css_class
        self.open_tags: list[str] = []
        self.pieces: list[str] = []
        self.done = False

    def handle_starttag(self, tag, attrs):
        if self.done or tag in _VOID:
            return
        classes = (dict(attrs).get("class") or "").split()
        fits = (not self.tag or tag == self.tag) and (not self.css_class or self.css_class in classes)
        if self.open_tags or fits:
            self.open_tags.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open_tags:
            while self.open_tags.pop() != tag:
                pass
            self.done = not self.open_tags

    def handle_data(self, data):
        if self.open_tags and not self.done and self.open_tags[-1] not in ("script", "style"):
            if data.strip():
                self.pieces.append(data.strip())


def element_text(html: Column, selector: str) -> Column:
    """Visible text of the first element matching ``tag``, ``.class`` or ``tag.class``."""
    tag, _, css_class = selector.partition(".")

    @F.pandas_udf(T.StringType())
    def extract(pages: pd.Series) -> pd.Series:
        def one(page):
            if page is None:
                return None
            parser = _ElementText(tag, css_class)
            parser.feed(page)
            return "\n".join(parser.pieces)

        return pages.map(one)

    return extract(html)
