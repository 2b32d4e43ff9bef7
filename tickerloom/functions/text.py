"""Text expressions: folding, tokens, pattern flags, lexicon sentiment, tag stripping."""

from __future__ import annotations

import html as html_lib
import re
import unicodedata
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom import constants as K

# Unicode white space, as a character-class body.
SPACE = r"\s\p{Z}\x1c-\x1f\x85"


@dataclass(frozen=True)
class TextRules:
    """Word lists used by the enrichment; the defaults are the fixed values."""

    families: dict[str, list[str]] = field(default_factory=lambda: dict(K.EVENT_FAMILIES))
    negation: Sequence[str] = tuple(K.NEGATION)
    speculation: Sequence[str] = tuple(K.SPECULATION)
    positive: Sequence[str] = tuple(K.POSITIVE_STEMS)
    negative: Sequence[str] = tuple(K.NEGATIVE_STEMS)
    event_types: Sequence[str] = tuple(K.EVENT_TYPES)


def joined_text(*parts: Column | str) -> Column:
    """Blank-separated concatenation that treats NULL as ""."""
    cols = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]
    return F.concat_ws(" ", *cols)


def matches_any(text: Column, patterns: Iterable[str]) -> Column:
    """True when any pattern occurs, ignoring case also for accented letters.

    One alternation per call keeps the row to one regex scan.  ``U`` makes ``\\b`` and case
    folding follow Unicode, ``d`` stops ``.`` at line feeds only.
    """
    return text.rlike("(?iUd)(?:" + "|".join(patterns) + ")")


def event_flags(text: Column, rules: TextRules = TextRules()) -> dict[str, Column]:
    """0/1 columns: one per event family, plus negation and speculation."""
    flags = {f"event_{name}": matches_any(text, pats) for name, pats in rules.families.items()}
    flags["is_negated"] = matches_any(text, rules.negation)
    flags["is_speculative"] = matches_any(text, rules.speculation)
    return {name: F.coalesce(c, F.lit(False)).cast("int") for name, c in flags.items()}


def words_containing(text: Column, stems: Iterable[str]) -> Column:
    """How many white-space separated words contain any stem.

    Each match starts at a word start and stops at its first stem, so a word counts once and
    the scan stays linear even on very long unbroken strings.
    """
    stems = "|".join(re.escape(s) for s in stems)
    return F.regexp_count(text, F.lit(rf"(?<![^{SPACE}])[^{SPACE}]*?(?:{stems})"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"[^{SPACE}]+"))


def lexicon_sentiment(text: Column, rules: TextRules = TextRules()) -> Column:
    """Struct(sentiment, score, confidence) from stem counts.

    The counts are bound to a lambda variable: each is planned, and scanned, once per text.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    counts = F.struct(
        words_containing(low, rules.positive).alias("p"),
        words_containing(low, rules.negative).alias("n"),
        word_count(low).alias("w"),
    )
    return F.get(F.transform(F.array(counts), lambda c: score_counts(c["p"], c["n"], c["w"])), F.lit(0))


def score_counts(p: Column, n: Column, words: Column) -> Column:
    """Score stem counts: (p-n)/(p+n), label at +-0.1 of the unrounded score."""
    hits = p + n
    raw = (p - n) / hits
    share = F.least(hits / F.greatest(words, F.lit(1)) * 5, F.lit(1.0))
    label = (
        F.when(hits == 0, "neutral").when(raw > 0.1, "positive")
        .when(raw < -0.1, "negative").otherwise("neutral")
    )
    return F.struct(
        label.alias("sentiment"),
        F.when(hits == 0, 0.0).otherwise(F.bround(raw, 3)).alias("score"),
        F.when(hits == 0, 0.0).otherwise(F.bround(share, 3)).alias("confidence"),
    )


# --- folding and tokens ------------------------------------------------------------------

def _fold(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(c for c in decomposed if not unicodedata.combining(c)).lower()


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str, str]:
    """(from, to, the other code points that need no full decomposition), built by rule.

    Code points of the Latin, Greek and Cyrillic blocks that fold to one character become a
    ``translate`` table; combining marks fold to nothing; everything else is "hard".
    """
    source, target, drop, hard = [], [], [], []
    for code in [*range(0x80, 0x530), *range(0x1E00, 0x1F00), *range(0x2010, 0x2070)]:
        char = chr(code)
        folded = _fold(char)
        if folded == "":
            drop.append(char)
        elif len(folded) != 1:
            hard.append(code)
        elif folded != char.lower():
            source.append(char)
            target.append(folded)
    easy = "".join(map(chr, sorted({*range(0x530), *range(0x1E00, 0x1F00), *range(0x2010, 0x2070)} - {*hard})))
    return "".join(source + drop), "".join(target), easy


@F.pandas_udf(T.StringType())
def _fold_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else _fold(t))


def fold_text(text: Column) -> Column:
    """Compatibility-decompose, drop accents, lower-case.

    Ordinary Latin text stays in the JVM; only rows holding a character outside the table are
    sent through Arrow (the others pass NULL).
    """
    source, target, easy = _fold_table()
    ascii_only = F.octet_length(text) == F.length(text)   # known without a look at each character, as a pattern takes
    quick = F.when(ascii_only, F.lower(text)).otherwise(F.lower(F.translate(text, source, target)))
    hard = F.when(~ascii_only & (F.translate(text, easy, "") != ""), text)
    return F.coalesce(_fold_batch(hard), quick)


def fold_latin(text: Column) -> Column:
    """`fold_text` for text known to hold no character outside the Latin table."""
    source, target, _ = _fold_table()
    return F.lower(F.translate(text, source, target))


def tokens(text: Column, min_length: int = 1) -> Column:
    """Distinct word tokens of already folded text."""
    parts = F.array_distinct(F.split(text, r"[^\p{L}\p{N}_]+"))
    return F.filter(parts, lambda t: F.length(t) >= min_length)


def normalized_name(name: Column) -> Column:
    return F.trim(fold_text(name))


# --- markup ------------------------------------------------------------------------------

@F.pandas_udf(T.StringType())
def _unescape_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html_lib.unescape(t))


def strip_markup(text: Column) -> Column:
    """Remove tags, decode entities, trim.  Rows without ``&`` never leave the JVM."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", "")
    coded = F.when(bare.contains("&"), bare)
    return trim_space(F.when(coded.isNotNull(), _unescape_batch(coded)).otherwise(bare))


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def clean_text(text: Column) -> Column:
    """Replace tags by blanks and collapse white space."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " ")
    return F.trim(F.regexp_replace(bare, rf"[{SPACE}]+", " "))


def strip_index_prefix(sector: Column) -> Column:
    """Drop a leading "MASI " from a sector label; blank becomes NULL."""
    return blank_to_null(F.regexp_replace(sector, r"^MASI\s+", ""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def first_filled(*cols: Column) -> Column:
    """First value that is neither NULL nor blank."""
    return F.coalesce(*[blank_to_null(c) for c in cols])
