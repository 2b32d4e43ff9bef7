"""Spans found in texts: the table scanners return, digests of it, and masking."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
FOUND = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def ordered(found: Iterable[tuple[str, int, int]], kinds: Sequence[str]) -> list[dict]:
    """Spans by start, then by the order of ``kinds``, then by end."""
    rank = {k: n for n, k in enumerate(kinds)}
    rows = sorted(set(found), key=lambda s: (s[1], rank[s[0]], s[2]))
    return [{"kind": k, "start": a, "end": b} for k, a, b in rows]


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, base: Sequence[str]) -> DataFrame:
    """One row per row of ``found``: counts of the base kinds, the hash of their spans, all spans."""
    spans = F.col("spans")
    own = F.filter(spans, lambda s: s["kind"].isin(*base))

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, base), F.sha2(joined(own), 256).alias("base_sha256"), joined(spans).alias("spans"))


def masked(text: str, spans: Iterable[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, lo, hi in sorted(spans, key=lambda s: (s[1], -s[2])):
        if lo >= at:
            out += [text[at:lo], f"[{kind}]"]
        at = max(at, hi)
    return "".join([*out, text[at:]])
