"""Periodic runs of words: online sparse diagonal DP over each whole text.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are identical), at least
``MIN_WORDS`` and ``MIN_TURNS`` periods long, that no neighbouring word extends.  Words are read from
left to right.  The earlier occurrence of a word says on which diagonal (lag) it matches; the match
length of the active lag grows by one, another lag ends it, and a diagonal that ended long enough is
emitted at once.

Earlier occurrences are sparse because only those that can carry a run are looked at.  A run's diagonal
is at least 16 words long, so a word counts with the 16 words that end in it; lags over 16 are looked at
with contexts of 32 words, over 32 with 64, and so on, always a context at least as long as the lag.
Two periods that meet on so long a stretch have a common divisor as period, hence:

* inside a run, the latest earlier occurrence of a word's context is exactly one period back;
* at most one lag of each width is active at any word.

A text of ``n`` words takes ``O(n log n)`` steps whatever it repeats, one word a million times included;
a text whose 16-word contexts are all different ends after the first look.  Nothing is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.shared import mix64, sliced, word_hashes

MIN_WORDS = 24
MIN_TURNS = 3
# Contexts of the shortest lags; every diagonal of a run matches this many words at least, since
# max(MIN_WORDS - q, (MIN_TURNS - 1) * q) >= 16 for every q.
CONTEXT = 16

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _doubled(context: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``2 * width`` words ending at each word, from those of ``width`` words."""
    out = context.copy()
    out[width:] = mix64(context[:-width] * _STEP + context[width:])
    return out


def _first_contexts(words: np.ndarray) -> np.ndarray:
    width = 1
    while width < CONTEXT and width < len(words):
        words = _doubled(words, width)
        width *= 2
    return words


def _latest(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurred before, the distances to the latest such place, and all places
    whose key occurs twice or more; each in ascending order of places."""
    order = np.argsort(keys, kind="stable")
    by_key = places[order]
    same = keys[order][1:] == keys[order][:-1]
    later, lag = by_key[1:][same], (by_key[1:] - by_key[:-1])[same]
    shared = np.zeros(len(places), bool)
    shared[1:] |= same
    shared[:-1] |= same
    by_place = np.argsort(later)
    return later[by_place], lag[by_place], np.sort(by_key[shared])


def _diagonals(places: list[int], lags: list[int], width: int) -> Iterator[tuple[int, int, int]]:
    """``(start, length, period)`` of every diagonal that ends long enough.

    ``places`` ascend; at each one a context of ``width`` words equals that ``lags`` words before.
    """
    active = matched = last = 0
    for place, lag in zip(places, lags, strict=True):
        if lag == active and place == last + 1:
            matched += 1
        else:
            if active and matched + active >= max(MIN_WORDS, MIN_TURNS * active):
                yield last - matched - active + 1, matched + active, active
            active, matched = lag, width
        last = place
    if active and matched + active >= max(MIN_WORDS, MIN_TURNS * active):
        yield last - matched - active + 1, matched + active, active


def word_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a sequence of word hashes, by start, then period."""
    found: list[tuple[int, int, int]] = []
    width, shortest = CONTEXT, 0
    context, places = _first_contexts(words), np.arange(CONTEXT - 1, len(words))
    while len(places) and MIN_TURNS * (shortest + 1) <= len(words):
        later, lag, shared = _latest(places, context[places])
        fits = (lag > shortest) & (lag <= width)
        found += _diagonals(later[fits].tolist(), lag[fits].tolist(), width)
        places = shared[shared >= 2 * width - 1]      # a longer context repeats only where this one does
        context = _doubled(context, width) if len(places) else context
        shortest, width = width, 2 * width
    return sorted(found, key=lambda run: (run[0], run[2]))


def _repeating_rows(hashes: np.ndarray, offsets: np.ndarray) -> set[int]:
    """Rows of a block in which some context of ``CONTEXT`` words occurs twice."""
    counts = np.diff(offsets)
    rows = np.repeat(np.arange(len(counts)), counts)
    whole = np.flatnonzero(np.arange(len(hashes)) - offsets[rows] >= CONTEXT - 1)
    if not len(whole):
        return set()
    keys = mix64(_first_contexts(hashes)[whole] + rows[whole].astype(np.uint64) * _STEP)
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    return set(rows[whole[order[1:][same]]].tolist())


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without what any run repeats after its first period."""
    if runs:
        steps = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            steps[start + period] += 1
            steps[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row of ``docs(doc_id, text)``.

    ``runs`` are sorted by start, then period, and numbered in words from 0; ``collapsed`` is the text
    with every run cut to one period.  Words are told apart by 64-bit hashes, case included.  Null and
    empty texts have no words, no runs and an empty ``collapsed``; rows without doc_id keep null;
    repeated rows are texts of their own; other columns are left out.  One pass, no shuffle; a task
    holds one block of texts, or one text where that is longer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, texts = batch.column(0), batch.column(1)
            for first, hashes, offsets in word_hashes(texts, fold=False):
                repeating = _repeating_rows(hashes, offsets)
                counts = np.diff(offsets)
                runs, kept = [], []
                for row in range(len(counts)):
                    own = word_runs(hashes[offsets[row]: offsets[row + 1]]) if row in repeating else []
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                    kept.append(collapsed((texts[first + row].as_py() or "").encode().split(), own).decode())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(counts)), pa.array(counts, pa.int64()), pa.array(runs, RUN_TYPE), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, FOUND)
