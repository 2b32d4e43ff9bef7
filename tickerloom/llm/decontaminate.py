"""Benchmark decontamination by q-gram lemma filtering.

A passage within ``e`` edits of an item of ``m`` characters shares at least ``m - q + 1 - q * e``
q-grams with it, on diagonals (text position minus item position) no more than ``2 * e`` apart.
Diagonals are covered by overlapping bands, ``4 * e + 1`` wide and ``2 * e + 1`` apart, so every such
passage lies wholly in one.  Shared q-grams are counted per text, item and band; bands that meet the
bound are verified by alignment within the band.

Texts and items are compared with letters lower-cased and white space runs as one space.  ``e`` is a
tenth of the item, less for items so short that the bound would fall below one q-gram; items of fewer
than ``q`` characters, and null ones, are not looked for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.secrets import blocks
from tickerloom.llm.shared import sliced, trimmed

Q = 8
EDIT_SHARE = 0.1
BENCHMARK_CHARS = 4 << 20               # items searched in one pass; more items, more passes
BLOCK_CHARS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 22
HITS = 1 << 19                          # shared q-grams that are held at once

_LOWER = np.array([ord(c) if len(c) == 1 else k for k, c in ((k, chr(k).lower()) for k in range(0x2000))], np.uint32)
_WHITE = np.array([chr(k).isspace() for k in range(0x3001)])

MATCHES = "doc_id long, item_id long, start long, end long, distance int"


def normalised(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts in a row, the borders of the texts, and where each one came from."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    borders = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    white = _WHITE[np.minimum(codes, len(_WHITE) - 1)] & (codes < len(_WHITE))
    kept = np.ones(len(codes), bool)
    kept[1:] = ~(white[1:] & white[:-1])
    kept[borders[:-1][borders[:-1] < len(codes)]] = True
    at = np.flatnonzero(kept)
    low = codes[at]
    low = np.where(low < len(_LOWER), _LOWER[np.minimum(low, len(_LOWER) - 1)], low)
    low[white[at]] = 32
    return low, np.searchsorted(at, borders), at


def qgrams(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` code points from every place (``Q`` is a power of two)."""
    h, width, factor = codes.astype(np.uint64) + np.uint64(1), 1, int(_BASE)
    while width < Q:
        if len(h) <= width:
            return np.empty(0, np.uint64)
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    return h


class Benchmark:
    """Items prepared for search: their q-grams sorted, with postings, and a bitmap before them."""

    def __init__(self, items: Iterable[tuple[int, str | None]]):
        self.ids, self.codes = [], []
        for item_id, text in items:
            codes = normalised([(text or "").strip()])[0]
            if len(codes) >= Q:
                self.ids.append(item_id)
                self.codes.append(codes)
        size = np.array([len(c) for c in self.codes], np.int64)
        self.size = size
        self.edits = np.minimum((size * EDIT_SHARE).astype(np.int64), (size - Q) // Q)
        self.bound = size - Q + 1 - Q * self.edits
        self.own = [qgrams(c) for c in self.codes]
        every = np.concatenate(self.own) if self.own else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(self.own)), [len(g) for g in self.own])
        place = np.concatenate([np.arange(len(g)) for g in self.own]) if self.own else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.bitmap = np.zeros(1 << _TABLE_BITS, bool)
        self.bitmap[self._slot(self.grams)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) * _BASE >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def bands(self, grams: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Text, item and band of diagonals, where an item shares enough q-grams with a text in the band
        and the next one; and the least diagonal, from which bands are counted.

        A q-gram a text repeats meets each of its places in the item, so hits can be as many as the
        product of both.  They are counted per band as they come, ``HITS`` at a time, and not kept."""
        at = np.flatnonzero(self.bitmap[self._slot(grams)])
        text = np.searchsorted(borders, at, "right") - 1
        inside = at + Q <= borders[text + 1]
        at, text = at[inside], text[inside]
        found = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
        same = self.grams[found] == grams[at]
        at, text, found = at[same], text[same], found[same]
        low = -int(self.size.max(initial=0))
        span = int(borders[-1]) - low + 3                  # bands of any width fit into it
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        total = np.cumsum(self.times[found])
        begin, held = 0, []
        while begin < len(at):
            before = int(total[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + HITS, "right")))
            times = self.times[found[begin:end]]
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            posting = np.repeat(self.first[found[begin:end]], times) + nth
            item = self.item[posting]
            diagonal = np.repeat(at[begin:end], times) - self.place[posting]
            key = (np.repeat(text[begin:end], times) * len(self.ids) + item) * span + (diagonal - low) // (2 * self.edits[item] + 1) + 1
            held.append(np.unique(np.concatenate([key, key - 1]), return_counts=True))
            begin = end
            if begin == len(at) or sum(len(k) for k, _ in held) > 4 * HITS:
                keys, of = np.unique(np.concatenate([keys, *(k for k, _ in held)]), return_inverse=True)
                counts = np.bincount(of, np.concatenate([counts, *(c for _, c in held)]), len(keys)).astype(np.int64)
                held = []
        pair, band = keys // span, keys % span - 1
        good = counts >= self.bound[pair % len(self.ids)]
        return pair[good] // len(self.ids), pair[good] % len(self.ids), band[good], low

    def search(self, texts: Sequence[str]) -> list[list[tuple[int, int, int, int]]]:
        """``(item id, start, end, edits)`` of the passages of every text, one per item and region."""
        out: list[list] = [[] for _ in texts]
        if not len(self.grams):
            return out
        codes, borders, came = normalised(texts)
        grams = qgrams(codes)
        text, item, band, low = self.bands(grams, borders)
        last: tuple[int, int, int] | None = None
        for t, k, b in zip(text.tolist(), item.tolist(), band.tolist(), strict=True):
            width, begin, end = 2 * int(self.edits[k]) + 1, int(borders[t]), int(borders[t + 1])
            first = b * width + low
            final = first + 2 * width - 1
            if last is not None and last[:2] == (t, k) and final < last[2] and not out[t][-1][3]:
                continue                                # all that begins here overlaps a passage without edits
            # a q-gram that repeats counts once, on either side
            there = grams[max(begin, first): max(min(end - Q + 1, final + int(self.size[k])), 0)]
            own = self.own[k]
            if min(np.isin(there, own).sum(), np.isin(own, there).sum()) < self.bound[k]:
                continue
            got = self._aligned(codes, begin, end, k, first, final)
            if got is None:
                continue
            lo, hi, edits = got
            if last is not None and last[:2] == (t, k) and lo < last[2]:
                before = out[t][-1]                     # the next band saw the same passage
                if edits >= before[3]:
                    continue
                out[t].pop()
            start = int(came[lo] - came[borders[t]]) if lo < hi else 0
            out[t].append((self.ids[k], start, int(came[hi - 1] - came[borders[t]]) + 1, edits))
            last = (t, k, hi)
        return out

    def _aligned(self, codes: np.ndarray, begin: int, end: int, k: int, first: int, last: int) -> tuple[int, int, int] | None:
        """Best alignment of item ``k`` on diagonals ``first`` to ``last`` of a text: its place and edits.

        Row ``i`` of the table holds, per diagonal ``d``, the edits between the item's first ``i``
        characters and a passage that ends before ``i + d``, with the diagonal the passage began on.
        """
        want, most = self.codes[k], int(self.edits[k])
        diagonals = np.arange(first, last + 1)
        far = np.int64(1 << 30)
        cost = np.where((diagonals >= begin) & (diagonals <= end), 0, far)
        # a cost and the start it came from in one number, so that minima carry the start along
        width = np.int64(1 << 20)
        start = np.arange(len(diagonals))
        state = cost * width + start
        lean = np.arange(len(diagonals)) * width
        for i, c in enumerate(want):
            at = diagonals + i
            inside = (at >= begin) & (at < end)
            match = np.zeros(len(diagonals), bool)
            match[inside] = codes[at[inside]] == c
            new = np.where(inside, state + np.where(match, 0, width), far * width)
            new[:-1] = np.minimum(new[:-1], state[1:] + width)         # a character of the item left out
            new = np.minimum.accumulate(new - lean) + lean             # characters of the text put in
            new[diagonals + i + 1 > end] = far * width
            state = new
            if state.min() >= (most + 1) * width:
                return None
        best = int(state.argmin())
        edits, began = divmod(int(state[best]), int(width))
        return None if edits > most else (int(diagonals[began]), int(diagonals[best]) + len(want), edits)


def _passes(docs: DataFrame, benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of bounded size: as many passes as blocks."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-int(chars) // BENCHMARK_CHARS))
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k) if passes > 1 else items
        yield sorted(((r.item_id, r.text) for r in part.collect()), key=lambda r: (r[0] is not None, r))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Passages of ``docs(doc_id, text)`` within the edit budget of an item of
    ``benchmark(item_id, text)``: place in code points of the whole text, and edits.

    Null and empty texts have none; every repeated row is reported; a row without doc_id keeps null.
    """
    def search(items: list[tuple[int, str]]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(items)        # at most BENCHMARK_CHARS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Benchmark(shared.value)
            for batch in sliced(batches):
                ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
                rows, at = [], 0
                for part in blocks(texts, BLOCK_CHARS):
                    for found in known.search(part):
                        rows += [(ids[at], *f) for f in found]
                        at += 1
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = [pa.int64()] * 4 + [pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "start", "end", "distance"])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(run), MATCHES)

    return reduce(DataFrame.unionByName, map(search, _passes(docs, benchmark)))


def without_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are: null and empty texts stay, repeated
    rows stay or go together, rows without doc_id like any other; without items, all rows stay."""
    kept = docs
    for items in _passes(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = Benchmark(shared.value)
            for batch in sliced(batches):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                clean = [not found for part in blocks(texts, BLOCK_CHARS) for found in known.search(part)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(trimmed(run), docs.schema)
    return kept
