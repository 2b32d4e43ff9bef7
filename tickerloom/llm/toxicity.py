"""Toxicity by class-conditional Kneser-Ney models.

Both classes have a model of the letters of words: the probability of a byte after the up to four
bytes before it in its word.  Counts of a class are discounted, and what that frees goes to one
shared backoff, Kneser-Ney continuation counts of both classes together, so an expression that
neither class has seen speaks for neither.  Counts are of distinct words per document, so one
repetitive document weighs like any other.

A word's evidence is its toxic minus its ordinary log-likelihood.  It depends on the word alone, so
each distinct word of a block is scored once.  A document is described by its length-normalised
evidence, by how much of it lies in strongly toxic words, and by its length; a logistic scale, fitted
on labelled documents the counts did not see, turns that into a score.

The labelled sample is bounded: at most ``MOST_PER_CLASS`` documents of each class, those with the
least hash of doc_id, a quarter of them for the scale.  The scale weighs both classes as all labelled rows
do, so the bound does not move it.  Every document of the table is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.shared import sliced, trimmed, word_blocks

ORDER = 5                               # bytes of a gram, at most 8
MOST_PER_CLASS = 10_000
STRONG = 3.0                            # evidence of a strongly toxic word
LEAN = 1.0
SCALE_PARTS = 4                         # one part in so many of the sample fits the scale
_NUMBERS = 7
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER[0] = 1


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed gram of every byte of the given words and of their ends, and where each word begins.

    A word is read between two spaces; a gram has the byte and up to ``ORDER - 1`` before it, back to
    the space before the word.
    """
    size = ends - starts + 1                      # with the space after
    begin = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(begin, size)
    at = np.repeat(starts, size) + place
    end = place == np.repeat(size, size) - 1
    letter = _LOWER[data[np.minimum(at, len(data) - 1)]] if len(data) else np.empty(0, np.uint64)
    letter = np.where(end, np.uint64(32), letter)
    key = letter.copy()
    for k in range(1, ORDER):
        before = np.zeros(len(letter), np.uint64)
        before[k:] = letter[:-k]
        before = np.where(place >= k, before, np.where(place == k - 1, np.uint64(32), np.uint64(0)))
        key |= before << np.uint64(8 * k)
    return key, begin


def _crc(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("long").cast("string"), "utf-8"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(_crc(doc_id) % 5 == 0, F.lit(False))


def _level(keys: np.ndarray) -> np.ndarray:
    return 1 + sum((keys >> np.uint64(8 * j) > 0).astype(np.int64) for j in range(1, ORDER))


def _tail(keys: np.ndarray, length: int) -> np.ndarray:
    return keys & np.uint64((1 << (8 * length)) - 1)


def _discount(counts: np.ndarray) -> float:
    once, twice = int((counts == 1).sum()), int((counts == 2).sum())
    return once / (once + 2 * twice) if once and twice else 0.75


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


@dataclass
class Model:
    grams: np.ndarray                   # rising, with the evidence of each
    evidence: np.ndarray
    contexts: np.ndarray                # rising, with the evidence of a gram not seen after it
    rest: np.ndarray
    mean: np.ndarray = None             # of the features, then their weights
    spread: np.ndarray = None
    weights: np.ndarray = None
    prior: float = 0.0

    @classmethod
    def of_counts(cls, keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Model:
        """Model of grams (rising) and their counts in both classes."""
        level = _level(keys)
        shared = _shared(keys, level)
        context, of = np.unique(keys >> np.uint64(8), return_inverse=True)

        def logs(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            cut = _discount(counts)
            total = np.bincount(of, counts, len(context))
            kinds = np.bincount(of, counts > 0, len(context))
            free = np.where(total > 0, cut * kinds / np.maximum(total, 1), 1.0)
            own = np.maximum(counts - cut, 0) / np.maximum(total[of], 1)
            return np.log(own + free[of] * shared), np.log(free)

        (t, t_free), (o, o_free) = logs(toxic.astype(float)), logs(ordinary.astype(float))
        return cls(keys, t - o, context, t_free - o_free)

    def of_words(self, keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Evidence of each word from its grams."""
        at, seen = _found(self.grams, keys)
        where, known = _found(self.contexts, keys >> np.uint64(8))
        value = np.zeros(len(keys))
        value[known] = self.rest[where[known]]
        value[seen] = self.evidence[at[seen]]
        return np.add.reduceat(value, begin) if len(begin) else np.empty(0)

    def features(self, column: pa.Array) -> np.ndarray:
        """Per row: mean evidence, mean excess over two levels, share of strong words, whether two
        different ones occur, log length, words."""
        rows = len(column)
        sums, strong = np.zeros((rows, 5)), []
        for row, data, starts, ends, hashes, offsets in word_blocks(column):
            if not len(hashes):
                continue
            kinds, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            value = self.of_words(*_grams(data, starts[first], ends[first]))[back]
            of = row + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            for k, x in enumerate((value, np.maximum(value - LEAN, 0), np.maximum(value - STRONG, 0), value > STRONG, np.ones(len(value)))):
                sums[:, k] += np.bincount(of, x, rows)
            loud = value > STRONG
            strong.append(np.stack([of[loud].astype(np.uint64), hashes[loud]]))
        two = np.zeros(rows)
        if strong:
            pairs = np.unique(np.concatenate(strong, axis=1), axis=1)
            two = np.bincount(pairs[0].astype(np.int64), minlength=rows) >= 2
        words = np.maximum(sums[:, 4], 1)
        return np.column_stack([sums[:, :4] / words[:, None], two, np.log(words), sums[:, 4]])

    def score(self, column: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(column), self.prior)
        x = (self.features(column)[:, :-1] - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -35, 35)))

    def scaled(self, features: np.ndarray, label: np.ndarray, share: tuple[float, float] = (1.0, 1.0)) -> Model:
        """Fits the logistic scale, by Newton steps with a small ridge.

        ``share`` are the rows that a row of the ordinary and of the toxic class stands for: the sample
        is bounded by class, and the scale is that of all labelled rows whatever the bound."""
        x = features[:, :-1]
        weight = np.where(label == 1, share[1], share[0])
        weight = weight * (len(x) / weight.sum())
        self.mean = np.average(x, axis=0, weights=weight)
        self.spread = np.sqrt(np.average((x - self.mean) ** 2, axis=0, weights=weight)) + 1e-9
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.spread])
        ridge = 1e-3 * len(x) * np.eye(z.shape[1])
        ridge[0, 0] = 1e-6
        w = np.zeros(z.shape[1])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
            step = np.linalg.solve((z * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ z + ridge, z.T @ (weight * (p - label)) + ridge @ w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        return self


def _shared(keys: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Backoff probability of every gram without its first byte: Kneser-Ney over the number of
    different bytes seen before, down to one byte and then an even chance."""
    above, levels = np.empty(0, np.uint64), {}
    for k in range(ORDER, 1, -1):
        above, counts = np.unique(_tail(np.unique(np.concatenate([above, keys[level == k]])), k - 1), return_counts=True)
        levels[k - 1] = above, counts
    chance: dict[int, np.ndarray] = {}
    for k in range(1, ORDER):
        grams, counts = levels[k]
        _, of = np.unique(grams >> np.uint64(8), return_inverse=True)
        total, kinds, cut = np.bincount(of, counts), np.bincount(of), _discount(counts)
        low = chance[k - 1][np.searchsorted(levels[k - 1][0], _tail(grams, k - 1))] if k > 1 else 1 / 256
        chance[k] = np.maximum(counts - cut, 0) / total[of] + cut * kinds[of] / total[of] * low
    out = np.full(len(keys), 1 / 256)
    for k in range(2, ORDER + 1):
        mine = level == k
        out[mine] = chance[k - 1][np.searchsorted(levels[k - 1][0], _tail(keys[mine], k - 1))]
    return out


def _training(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id is not null and toxic in (0, 1)").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("_toxic")).where(~held_out(F.col("doc_id")))


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Texts of the labelled sample with their class and part; the sample's ids are bounded."""
    rows = _training(labels)
    picked = [rows.where(f"_toxic = {c}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    chosen = picked[0].unionByName(picked[1]).withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SCALE_PARTS)).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "_toxic", "_part")     # at most 2 * most ids


def fit(docs: DataFrame, labels: DataFrame, most_per_class: int = MOST_PER_CLASS) -> Model:
    """Model of ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``, without the held-out rows.

    Rows without id, label or text teach nothing.  Without rows of both classes every score is the
    share of toxic rows, counted with one ordinary row more.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {0: [], 1: []}
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for row, data, starts, ends, hashes, offsets in word_blocks(batch.column(0)):
                of = row + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                order = np.lexsort((hashes, of))
                new = np.ones(len(order), bool)
                new[1:] = (of[order][1:] != of[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
                word = order[new]
                for c in (0, 1):
                    mine = word[toxic[of[word]] == c]
                    held[c].append(np.unique(_grams(data, starts[mine], ends[mine])[0], return_counts=True))
        for c, parts in held.items():
            if parts:
                keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), c, np.int32)), pa.array(counts)], names=["gram", "toxic", "n"])

    sample = _sample(docs, labels, most_per_class)
    counted = sample.where("_part > 0").select("text", "_toxic").mapInArrow(trimmed(count), "gram long, toxic int, n long") \
        .groupBy("gram").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("o"))
    table = counted.toPandas()          # grams of the bounded sample
    order = np.argsort(table["gram"].to_numpy(np.int64).view(np.uint64))
    keys = table["gram"].to_numpy(np.int64).view(np.uint64)[order]
    toxic, ordinary = table["t"].to_numpy(np.int64)[order], table["o"].to_numpy(np.int64)[order]
    if not toxic.sum() or not ordinary.sum():
        seen = {r["_toxic"]: r["n"] for r in sample.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        nothing = np.empty(0)
        return Model(nothing.astype(np.uint64), nothing, nothing.astype(np.uint64), nothing, prior=seen.get(1, 0) / (seen.get(0, 0) + seen.get(1, 0) + 1))
    model = Model.of_counts(keys, toxic, ordinary)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.features(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.arange(0, found.size + 1, _NUMBERS, dtype=np.int32), found.reshape(-1)), batch.column(1)], names=["x", "toxic"])

    rows = sample.where("_part = 0").select("text", "_toxic").mapInArrow(trimmed(describe), "x array<double>, toxic int").toPandas()
    label = rows["toxic"].to_numpy(float)
    if label.min(initial=1) == label.max(initial=0):
        label, x = np.array([0.0, 1.0]), np.array([[0.0] * 4 + [0, 4, 1], [1.0] * 4 + [1, 4, 1]])    # no rows to scale by
        return model.scaled(x, label)
    every = {r["_toxic"]: r["n"] for r in _training(labels).groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = tuple(max(every.get(c, 0) / most_per_class, 1.0) for c in (0, 1))
    return model.scaled(np.stack(rows["x"].to_list()), label, share)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Null text counts as empty, and all empty texts have one score; equal texts have equal scores;
    repeated rows each have a row, as have rows without doc_id, which are never held out; an empty
    table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(batch.column(1)))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimmed(run), "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` scored below one half, all columns as they are; repeated rows stay or go
    together, rows without doc_id like any other, and an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array(shared.value.score(batch.column("text")) < 0.5))

    return docs.mapInArrow(trimmed(run), docs.schema)
