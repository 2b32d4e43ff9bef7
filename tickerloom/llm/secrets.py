"""Secret scan over a trigram inverted index.

Every rule's pattern gives a Boolean query over trigrams that any match must contain.  Texts are
indexed block by block: postings of the needed trigrams, A-Z folded, one bit per text.  A rule's
query is answered by intersecting and joining postings; only its candidates meet the pattern.  A
pattern without a mandatory trigram scans every text.

Kinds ``assign access hex`` are the base rules; the others are added.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.shared import BLOCK_BYTES, sliced, trimmed
from tickerloom.llm.spans import FOUND, SPAN_TYPE, masked, ordered

ANY = True                                # a query that every text meets
EXACT_MOST = 64                           # strings kept apart before they become a query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[re.Match], bool] = lambda m: True


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda m: len(m[2]) >= 6),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 20),
    Rule("hex", r"[0-9a-f]{24,}"),         # runs are maximal, so this is [0-9a-f]+ of 24 or more
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{24,}"),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")


def _fold(code: int) -> str | None:
    return chr(code).lower() if code < 128 else None


def _all(parts: list) -> object:
    parts = [p for p in parts if p is not ANY]
    return ANY if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _one_of(parts: list) -> object:
    return ANY if not parts or any(p is ANY for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[str]) -> object:
    """Query met by every text that holds one of ``strings``."""
    sets = {frozenset(s[k: k + 3] for k in range(len(s) - 2)) for s in strings}
    least = [g for g in sets if not any(other < g for other in sets)]      # the others say no more
    return _one_of(sorted((_all(sorted(g)) for g in least), key=repr))


def _node(kind, value) -> tuple[set[str] | None, object]:
    """Folded strings a node can match, if they are few, and the query its matches meet."""
    if kind is op.LITERAL:
        c = _fold(value)
        return ({c}, ANY) if c else (None, ANY)
    if kind is op.IN:
        chars = {_fold(v) for k, v in value if k is op.LITERAL}
        few = all(k is op.LITERAL for k, _ in value) and None not in chars and len(chars) <= 8
        return (chars if few else None), ANY
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        if all(exact is not None for exact, _ in found) and sum(len(e) for e, _ in found) <= EXACT_MOST:
            return set().union(*(e for e, _ in found)), ANY
        return None, _one_of([_of_strings(e) if e is not None else q for e, q in found])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, body = value
        exact, query = _sequence(body)
        if (least, most) == (0, 1) and exact is not None:
            return exact | {""}, ANY
        if least == 0:
            return None, ANY
        return None, _of_strings(exact) if exact is not None else query
    if kind is op.AT:
        return {""}, ANY
    return None, ANY


def _sequence(nodes) -> tuple[set[str] | None, object]:
    run, needed, whole = {""}, [], True
    for kind, value in nodes:
        exact, query = _node(kind, value)
        if exact is not None and len(run) * len(exact) <= EXACT_MOST:
            run = {a + b for a in run for b in exact}
            continue
        whole = False
        needed += [_of_strings(run), query]
        run = exact if exact is not None and len(exact) <= EXACT_MOST else {""}
        if exact is not None and run is not exact:
            needed.append(_of_strings(exact))
    return (run, ANY) if whole else (None, _all([*needed, _of_strings(run)]))


def trigram_query(pattern: str) -> object:
    """Trigrams, ``("and", ...)``, ``("or", ...)`` or ``ANY``, over texts with A-Z folded."""
    exact, query = _sequence(_parser.parse(pattern))
    return _of_strings(exact) if exact is not None else query


def _grams(query) -> set[str]:
    return {query} if isinstance(query, str) else set() if query is ANY else set().union(*map(_grams, query[1]))


class TrigramScan:
    """Patterns, their queries, and the table from a trigram's code to its postings."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = [(r.kind, re.compile(r.pattern, re.ASCII), r.keep, trigram_query(r.pattern)) for r in rules]
        self.kinds = [r.kind for r in rules]
        grams = sorted(set().union(*(_grams(q) for *_, q in self.rules)))
        self.slot = {g: n for n, g in enumerate(grams)}
        self.table = np.zeros(1 << 24, np.int16)
        for g, n in self.slot.items():
            a, b, c = g.encode()
            self.table[a << 16 | b << 8 | c] = n + 1
        self.fold = np.arange(256, dtype=np.uint32)
        self.fold[65:91] += 32

    def postings(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Bit per needed trigram and text; ``ends`` are the ends of the texts in ``data``."""
        bits = np.zeros((len(self.slot), len(ends)), bool)
        if len(data) > 2:
            x = self.fold[data]
            slots = self.table[x[:-2] << 16 | x[1:-1] << 8 | x[2:]]
            at = np.flatnonzero(slots)
            text = np.searchsorted(ends, at, "right")
            inside = at + 2 < ends[text]          # not over the border of two texts
            bits[slots[at[inside]] - 1, text[inside]] = True
        return bits

    def candidates(self, query, bits: np.ndarray) -> np.ndarray:
        if query is ANY:
            return np.ones(bits.shape[1], bool)
        if isinstance(query, str):
            return bits[self.slot[query]]
        join = np.logical_and if query[0] == "and" else np.logical_or
        return join.reduce([self.candidates(part, bits) for part in query[1]])

    def block(self, texts: Sequence[str]) -> list[list[dict]]:
        """Spans of every text, offsets in code points."""
        found: list[list] = [[] for _ in texts]
        raw = [t.encode("utf-8", "replace") for t in texts]
        ends = np.cumsum([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        bits = np.zeros((len(self.slot), len(texts)), bool)
        # whole texts, however long: pieces overlap by two bytes
        for at in range(0, len(data), BLOCK_BYTES):
            first = int(np.searchsorted(ends, at, "right"))
            piece = data[at: at + BLOCK_BYTES + 2]
            last = min(int(np.searchsorted(ends, at + len(piece), "left")), len(texts) - 1)
            bits[:, first: last + 1] |= self.postings(piece, ends[first: last + 1] - at)
        for kind, pattern, keep, query in self.rules:
            for k in np.flatnonzero(self.candidates(query, bits)):
                found[k] += [(kind, m.start(), m.end()) for m in pattern.finditer(texts[k]) if keep(m)]
        return [ordered(f, self.kinds) for f in found]


@lru_cache(maxsize=1)
def default_scan() -> TrigramScan:
    return TrigramScan(RULES)


def blocks(texts: Sequence[str], chars: int = BLOCK_BYTES) -> Iterator[list[str]]:
    """Runs of whole texts of about ``chars`` together."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row of ``docs(doc_id, text)``.

    Null and empty texts have no spans; rows without doc_id and repeated rows come as they are;
    other columns of ``docs`` are not read; a text of any length is read whole, by one task; an empty
    table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            spans = [s for part in blocks(texts) for s in default_scan().block(part)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPAN_TYPE)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FOUND)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind in brackets; rows without secrets
    and all other columns stay as they are, but ``n_chars`` follows a changed text.  Repeated rows and
    rows without doc_id are masked like any other; an empty table stays empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, out = batch.column("text").to_pylist(), []
            spans = (s for part in blocks([t or "" for t in texts]) for s in default_scan().block(part))
            for text, found in zip(texts, spans, strict=True):
                out.append(masked(text, [(s["kind"], s["start"], s["end"]) for s in found]) if found else text)
            columns = list(batch.columns)
            columns[batch.schema.names.index("text")] = pa.array(out, pa.string())
            if "n_chars" in batch.schema.names:
                at = batch.schema.names.index("n_chars")
                kept = zip(columns[at].to_pylist(), texts, out, strict=True)
                columns[at] = pa.array([n if a == b else len(b) for n, a, b in kept], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(trimmed(run), docs.schema)
