"""Best-fit packing of tokenised documents into sequences of a fixed length.

Two steps.  ``tokenised_pieces`` turns every whole text into ids and cuts only what is longer than a
sequence.  ``packed`` gives every piece a sequence and a place there: bounded-space online best fit,
a fixed number of open bins in a bitset keyed by free space, the fullest closed first.

Pieces are dealt by a hash into tasks of about ``PIECES_PER_TASK``, so the number of part-filled bins
does not depend on how the input was split, and each task packs its pieces in hash order: a task that
is run again gives the same result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.shared import stored, trimmed

SEQUENCE_TOKENS = 2048
OPEN_BINS = 4096
PIECES_PER_TASK = 100_000
END_ID = 0
# The added token of the vocabulary; its id follows those of the ranks.
SPECIAL = "<|endoftext|>"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=1)
def _encoder(ranks_file: str | None):
    """The byte-level BPE of ``byte_bpe_50k.json`` with its special token, from its rank file: the same
    ids, some five times faster than the tokenizers library gives them (a test compares both)."""
    import public_tokenizers
    import tiktoken

    path = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})


def encode(text: str | None, ranks_file: str | None = None) -> np.ndarray:
    """Ids of a whole text as unsigned 32-bit numbers, ended by ``END_ID``; null counts as empty."""
    ids = _encoder(ranks_file).encode_to_numpy(text, allowed_special="all") if text else []
    return np.append(np.asarray(ids, "<u4"), np.uint32(END_ID)).astype("<u4", copy=False)


@lru_cache(maxsize=1)
def token_bytes(ranks_file: str | None = None) -> np.ndarray:
    """Bytes of text that each id stands for."""
    encoder = _encoder(ranks_file)
    return np.array([len(encoder.decode_single_token_bytes(i)) for i in range(encoder.n_vocab)])


def cuts(length: int, limit: int) -> list[int]:
    """Starts of the pieces of a document: whole ones of ``limit`` ids, the first may be shorter."""
    return [0, *range(length % limit or limit, length, limit)]


def tokenised_pieces(
    docs: DataFrame, limit: int = SEQUENCE_TOKENS, ranks_file: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``; ``with_ids`` adds the ids themselves.

    Null and empty texts have the end id alone; a row without doc_id keeps null; repeated rows are
    documents of their own.
    """
    schema = PIECES + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py(), ranks_file)
                at = cuts(len(ids), limit)
                for k, (lo, hi) in enumerate(zip(at, [*at[1:], len(ids)], strict=True)):
                    piece = ids[lo:hi]
                    rows.append((doc_id, k, lo, hi - lo, zlib.crc32(piece.tobytes()), piece if with_ids else None))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 6 if with_ids else 5]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types[: len(names)], strict=False)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(trimmed(run), schema)


class OpenBins:
    """Bounded-space best fit.  Bit ``f`` of ``spaces`` is set while a bin with ``f`` free tokens is
    open, so the tightest bin for a piece is the lowest set bit from its length on."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.spaces, self.by_space, self.open, self.begun = 0, {}, 0, 0

    def _take(self, free: int) -> int:
        bins = self.by_space[free]
        number = bins.pop()
        if not bins:
            self.spaces ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Number of the bin and the place in it for a piece of ``length``."""
        fitting = self.spaces >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)   # the fullest closes
            free, number = self.capacity, self.begun
            self.begun += 1
        if left := free - length:
            self.by_space.setdefault(left, []).append(number)
            self.spaces |= 1 << left
            self.open += 1
        return number, self.capacity - free


def packed(
    pieces: DataFrame, limit: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every column of ``pieces`` stays.

    ``pieces`` needs ``length`` from 1 to ``limit`` and must be stored, since it is counted first.
    Sequence ids are the task's number times 2**40 plus a number within the task.
    """
    tasks = max(1, -(-pieces.count() // per_task))
    names = pieces.columns
    order = F.xxhash64(*names)
    schema = pieces.select(*names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(limit, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*names, "sequence_id", "offset"])

    return pieces.repartition(tasks, order).sortWithinPartitions(order, *names).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, limit: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pieces of all documents with their sequence and place; the digest of the ids stands for them."""
    return packed(stored(tokenised_pieces(docs, limit), "pieces"), limit, open_bins)
