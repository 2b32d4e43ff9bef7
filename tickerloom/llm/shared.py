"""Helpers the operators share: stored tables, null-safe inputs, hashed words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickerloom.session import stored  # noqa: F401  (the operators take it from here)

# Bytes of text hashed at once: bounds the numpy arrays of a task, not what is read.
BLOCK_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names after ``wanted`` that are not ``taken``, in any case of letters."""
    used = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


BATCH_BYTES = 8 << 20


def lean(spark: SparkSession) -> None:
    """Rows go to tasks in batches of at most ``BATCH_BYTES`` from here on in the session: long texts
    fill the default batch with tens of megabytes, held several times over on either side."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` that gives freed memory back to the machine when its task ends: workers live on from
    stage to stage, and what one stage needed is no use to the next."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return task


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E6D62D06F6A02ED)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


mix64 = _mix

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CASED = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_BYTE = _CASED.copy()
_BYTE[65:91] = _BYTE[97:123]          # A-Z count as a-z
_BASE = 0x9FB21C651E98DF25            # odd, so it has an inverse modulo 2**64
_BACK = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept for the worker's life."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        kept = []
        for base in (_BASE, _BACK):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            kept.append(np.cumprod(p))
        if size > 4 * BLOCK_BYTES:    # one enormous word: not kept
            return kept[0], kept[1]
        _POWERS[:] = kept
    return _POWERS[0], _POWERS[1]


def _hash_block(data: np.ndarray, rows: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in the bytes ``data`` and, per row border in ``rows``,
    the words before it."""
    n = len(data)
    if not n:
        nothing = np.empty(0, np.int64)
        return nothing, nothing, np.empty(0, np.uint64), np.zeros(len(rows), np.int64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = rows[(rows > 0) & (rows < n)]
    first[inner] = solid[inner]       # a word never runs over a row border
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, back = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_BYTE if fold else _CASED)[data] * power[:n], out=sums[1:])
    hashes = _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, hashes, np.searchsorted(starts, rows)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what goes back to the JVM stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_blocks(
    column: pa.Array, fold: bool = True,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks ``(first row, bytes, starts, ends, hashes, offsets)`` of the words of a string column.

    Words are runs of bytes other than white space (space, 9 to 13), hashed with A-Z lower-cased
    unless ``fold`` is false; row ``i`` of a block has the words ``offsets[i]`` to ``offsets[i + 1]``.  Null counts as empty.  A text
    longer than a block comes in several blocks of that one row, cut at white space.
    """
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    row, rows = 0, len(column)
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), rows)
        lo, hi = offsets[row], offsets[stop]
        if hi - lo <= BLOCK_BYTES:
            yield row, data[lo:hi], *_hash_block(data[lo:hi], offsets[row: stop + 1] - lo, fold)
        else:
            for piece in _long_pieces(data[lo:hi]):
                yield row, piece, *_hash_block(piece, np.array([0, len(piece)]), fold)
        row = stop


def word_hashes(column: pa.Array, fold: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks ``(first row, hashes, offsets)`` like ``word_blocks``, but whole rows only: a text
    longer than a block comes as a block of its own."""
    held: list = []
    for row, _, _, _, hashes, offsets in word_blocks(column, fold):
        if held and held[0] != row:
            yield _joined(held)
            held = []
        if held:
            held[1].append(hashes)
        else:
            held = [row, [hashes], offsets]
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple[int, np.ndarray, np.ndarray]:
    row, parts, offsets = held
    return (row, parts[0], offsets) if len(parts) == 1 else (row, np.concatenate(parts), np.array([0, sum(map(len, parts))]))


def _long_pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    while at < len(data):
        end = min(at + BLOCK_BYTES, len(data))
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:                     # one word longer than a block: to its end
                end = next((s + int(g[0]) for s in range(end, len(data), BLOCK_BYTES)
                            if len(g := np.flatnonzero(_SPACE[data[s: s + BLOCK_BYTES]]))), len(data))
        yield data[at:end]
        at = end


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every run of ``width`` words of each row; a row with fewer words has its
    whole sequence as one shingle, a row without words none."""
    counts = np.diff(offsets)
    n = len(hashes)
    rows = np.repeat(np.arange(len(counts)), counts)
    # runs start at every word but a row's last width - 1; a short row starts one at its first word
    place = np.arange(n) - offsets[rows]
    keep = (place + width <= counts[rows]) | ((place == 0) & (counts[rows] < width))
    at = np.flatnonzero(keep)
    room = np.minimum(counts[rows[at]], width)
    out = np.zeros(len(at), np.uint64)
    for k in range(width):
        more = k < room
        step = hashes[np.minimum(at + k, n - 1)] if n else hashes
        out = np.where(more, _mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + step), out)
    return rows[at], out
