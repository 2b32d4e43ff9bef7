"""Personal data by anchor expansion.

One Aho-Corasick pass over a whole text finds anchors: at-signs, digits beside digits or dots, plus
signs before digits, URL schemes and identifier cues.  A deterministic parser at each anchor expands
it to its boundaries and validates it.  Text without anchors costs that one pass.

Kinds ``email ip card phone`` are the base rules: the leftmost non-overlapping matches of their
patterns, failing ones dropped.  ``url iban account`` are added by schemes and cues.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.spans import FOUND, SPAN_TYPE, ordered

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account")

DIGITS = "0123456789"
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
SCHEMES = ("http://", "https://", "ftp://")
CUES = {"iban": ("iban", "Iban", "IBAN"), "account": ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT")}

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[A-Za-z0-9](?:[^\s<>\"'`{}|\\^\[\]]*[^\s<>\"'`{}|\\^\[\].,;:!?)])?")
_IBAN = re.compile(r"[\x20:#=]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\x20?(?:number|num|no)\b\.?)?[\x20:#=]{1,3}([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])")


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    tree = ahocorasick.Automaton()
    found: dict[str, list[str]] = {}
    for a in DIGITS:
        found.setdefault(f"+{a}", []).append("phone")
        for b in DIGITS:
            found.setdefault(f"{a}.{b}", []).append("ip")
            for between in ("", " ", "-"):
                found.setdefault(a + between + b, []).append("card")
    found["@"] = ["email"]
    for scheme in SCHEMES:
        found[scheme] = ["url"]
    for kind, cues in CUES.items():
        for cue in cues:
            found[cue] = [kind]
    for anchor, kinds in found.items():
        tree.add_word(anchor, (len(anchor), kinds[0]))
    tree.make_automaton()
    return tree


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def iban_holds(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _byte_sized(number: str) -> bool:
    number = number.lstrip("0")
    return len(number) < 3 or (len(number) == 3 and number <= "255")


def find(text: str) -> list[dict]:
    """Spans of a whole text, offsets in code points; an empty text has none."""
    out: list[tuple[str, int, int]] = []
    email_from = ip_from = card_from = url_from = 0
    for last, (width, kind) in _anchors().iter(text):
        at = last - width + 1
        if kind == "card":
            if at >= card_from:
                m = _CHAIN.match(text, at)
                card_from = m.end()
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", at, m.end()))
        elif kind == "email":
            lo = at
            while lo > email_from and text[lo - 1] in LOCAL:
                lo -= 1
            if lo < at and (m := _DOMAIN.match(text, last + 1)):
                out.append(("email", lo, m.end()))
                email_from = m.end()
            else:
                email_from = max(email_from, at)   # no later match begins before this sign
        elif kind == "ip":
            if at >= ip_from:
                while at > ip_from and text[at - 1] in DIGITS:
                    at -= 1
                m = _DOTTED.match(text, at)
                ip_from = m.end()
                parts = m.group().split(".")
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k: k + 4]
                    end = at + sum(map(len, four)) + 3
                    if all(map(_byte_sized, four)):
                        out.append(("ip", at, end))
                    at = end + 1
        elif kind == "phone":
            if (m := _PHONE.match(text, at)) and 10 <= sum(c in DIGITS for c in m.group()) <= 15:
                out.append(("phone", at, m.end()))
        elif kind == "url":
            if at >= url_from and (m := _URL.match(text, last + 1)):
                out.append(("url", at, m.end()))
                url_from = m.end()
        elif kind == "iban":
            if (m := _IBAN.match(text, last + 1)) and iban_holds(m.group(1)):
                out.append(("iban", m.start(1), m.end(1)))
        elif m := _ACCOUNT.match(text, last + 1):
            out.append(("account", m.start(1), m.end(1)))
    return ordered(out, KINDS)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row of ``docs(doc_id, text)``.

    Null and empty texts have no spans; rows without doc_id and repeated rows come as they are;
    other columns of ``docs`` are not read; a text of any length is read whole, by one task; an empty
    table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find(t.as_py()) if t.is_valid else [] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPAN_TYPE)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)
