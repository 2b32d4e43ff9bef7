"""One-permutation MinHash fingerprints with optimal densification and packed low-order bits.

Each shingle of five words is hashed once: its high bits choose one of ``bins`` bins, which keeps its
least hash.  An empty bin borrows from the first filled bin in a sequence that depends on the bin
and the attempt only, so documents with equal bins borrow alike.  The lowest ``bits`` bits of every
bin are packed.  Two unlike bins agree by chance once in ``2**bits``; ``likeness`` takes that out.

A text without words has no shingles: its fingerprint is the empty string, like another empty one
and unlike all others.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.shared import mix64, shingles, word_hashes

WORDS = 5
BINS = 512
BITS = 4                                # packed two to a byte
ROWS_AT_ONCE = 1024
TASK_BYTES = 32 << 20
MOST_TASKS = 10_000
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _least(rows: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """Least hash per row and bin; ``_FREE`` where a bin is empty."""
    table = np.full(count * BINS, _FREE, np.uint64)
    shift = np.uint64(64 - (BINS - 1).bit_length())
    np.minimum.at(table, rows * BINS + (hashes >> shift).astype(np.int64), mix64(hashes))
    return table.reshape(count, BINS)


def densified(table: np.ndarray) -> np.ndarray:
    """``table`` with every empty bin filled from another bin of its row; empty rows stay empty."""
    filled = table != _FREE
    row, bin_ = np.nonzero(~filled & filled.any(axis=1, keepdims=True))
    out, attempt = table.copy(), 0
    while len(row):
        tries = int(np.clip((1 << 16) // len(row), 1, 256))
        steps = np.arange(attempt, attempt + tries, dtype=np.uint64) * np.uint64(BINS)
        lender = (mix64(bin_.astype(np.uint64)[:, None] + steps) % np.uint64(BINS)).astype(np.int64)
        good = filled[row[:, None], lender]
        first = good.argmax(axis=1)
        done = good[np.arange(len(row)), first]
        out[row[done], bin_[done]] = table[row[done], lender[done, first[done]]]
        row, bin_, attempt = row[~done], bin_[~done], attempt + tries
    return out


def fingerprints_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Packed fingerprints, one row each, and which of them have any shingle."""
    packs, some = [], []
    for _, hashes, offsets in word_hashes(column):
        for at in range(0, len(offsets) - 1, ROWS_AT_ONCE):
            part = offsets[at: at + ROWS_AT_ONCE + 1]
            rows, values = shingles(hashes[part[0]: part[-1]], part - part[0], WORDS)
            table = densified(_least(rows, values, len(part) - 1))
            low = (table & np.uint64((1 << BITS) - 1)).astype(np.uint8)
            packs.append(low[:, ::2] << BITS | low[:, 1::2])
            some.append(np.diff(part) > 0)
    if not packs:
        return np.empty((0, BINS // 2), np.uint8), np.empty(0, bool)
    return np.concatenate(packs), np.concatenate(some)


_AGREE = np.array([(b >> BITS == 0) + (b % (1 << BITS) == 0) for b in range(256)], np.int64)


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Estimated share of common shingles, row by row, from 0 to 1."""
    share = _AGREE[a ^ b].sum(axis=1) / BINS
    chance = 1 / (1 << BITS)
    guess = np.clip((share - chance) / (1 - chance), 0, 1)
    return np.where(a_some & b_some, guess, np.where(a_some == b_some, 1.0, 0.0))


def _texts(packed: np.ndarray, some: np.ndarray) -> list[str]:
    return [base64.b64encode(p.tobytes()).decode() if s else "" for p, s in zip(packed, some, strict=True)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (base64, or empty) of every row of ``docs(doc_id, text)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_texts(*fingerprints_of(batch.column(1))), pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (rising) up to ``doc_id``: a binary search, no join."""
    if not bounds:
        return F.lit(0)
    where = F.array(*[F.lit(b).cast("long") for b in bounds]) if len(bounds) < 3 else \
        F.expr("array(" + ",".join(f"{b}L" for b in bounds) + ")")
    begin = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        up = F.get(where, mid) <= doc_id
        return F.when(s["lo"] >= s["hi"], s).when(up, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))) \
            .otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.when(doc_id.isNull(), 0).otherwise(F.reduce(steps, begin, halve)["lo"])


def in_order(docs: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``docs(doc_id, text)`` range-partitioned and sorted by doc_id, so that the row after each one
    is its successor: the texts are shuffled once and no window is needed.

    Adds ``bucket`` and ``tail``.  The bounds of the buckets are ids that exist, and the rows at a
    bound also come, marked ``tail``, at the end of the bucket before; the first rows of all end the
    last bucket.  Rows without doc_id come first; equal ids are ordered by their text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    tasks = int(min(MOST_TASKS, max(1, -(-(size[0] or 0) // task_bytes))))
    bounds: list[int] = []
    if tasks > 1:
        found = docs.agg(F.percentile_approx("doc_id", [k / tasks for k in range(1, tasks)], 20 * tasks)).first()[0] or []
        bounds = sorted({b for b in found if b > size[1]})
    doc_id = F.col("doc_id")
    own = _bucket(doc_id, bounds)
    first = doc_id.isNull() if size[2] else doc_id == F.lit(size[1])
    spare = F.filter(F.array(
        F.when(doc_id.isin(bounds), own - 1) if bounds else F.lit(None).cast("int"),
        F.when(first, F.lit(len(bounds)))), lambda b: b.isNotNull())
    places = F.concat(
        F.array(F.struct(own.alias("bucket"), F.lit(False).alias("tail"))),
        F.transform(spare, lambda b: F.struct(b.alias("bucket"), F.lit(True).alias("tail"))))
    rows = docs.select("doc_id", "text", F.inline(places))
    return rows.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions("bucket", "tail", "doc_id", "text")


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def fingerprints_and_edits(docs: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Fingerprint of every text and of the text whose last quarter comes from the next document.

    The next document is the next row by doc_id, after the last the first; a table of one row follows
    itself.  Null text counts as empty.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                     # the row whose successor is still to come
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = pa.Table.from_batches([batch.slice(at, ROWS_AT_ONCE)])
                part = pa.concat_tables([held, part]) if held is not None else part
                held = part.slice(part.num_rows - 1)
                if part.num_rows > 1:
                    yield from _pairs(part.combine_chunks().to_batches()[0])

    return in_order(docs, task_bytes).mapInArrow(run, SCHEMA)


def _pairs(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Results of the rows whose successor follows them in ``part``."""
    bucket, tail = part["bucket"].to_numpy(), part["tail"].to_numpy(zero_copy_only=False)
    rows = np.flatnonzero((bucket[:-1] == bucket[1:]) & ~tail[:-1])
    if not len(rows):
        return
    texts = part["text"].to_pylist()
    changed = [edited(texts[k], texts[k + 1]) for k in rows]
    mine, mine_some = fingerprints_of(part["text"])
    new, new_some = fingerprints_of(pa.array(changed, pa.large_string()))
    here, here_some = mine[rows], mine_some[rows]
    yield pa.RecordBatch.from_arrays([
        part["doc_id"].take(pa.array(rows)),
        pa.array([len(texts[k]) for k in rows], pa.int64()),
        pa.array([hashlib.sha256(c.encode("utf-8", "replace")).hexdigest() for c in changed], pa.string()),
        pa.array(_texts(here, here_some), pa.string()), pa.array(_texts(new, new_some), pa.string()),
        pa.array(likeness(here, here_some, new, new_some), pa.float64()),
        pa.array(likeness(here, here_some, mine[rows + 1], mine_some[rows + 1]), pa.float64()),
    ], names=[c.split()[0] for c in SCHEMA.split(", ")])
