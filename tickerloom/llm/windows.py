"""Order-preserving packing: one stream of ids cut into windows by dynamic programming.

The texts of a task form one stream of ids in the order of the rows.  Windows are stretches of it of at
most ``WINDOW`` ids; a window is padded to ``WINDOW``, except that a length that is a power of two needs
no padding.  Cuts may stand at the end of a document (free) or of a sentence (``SENTENCE_PENALTY``), and
inside a sentence over ``LONG_SENTENCE`` ids behind every 16th (``TOKEN_PENALTY``).  The cost of a layout is its padding
plus its penalties, and ``WindowCuts`` finds the least:

    cost(i) = penalty(i) + min( min over j >= i - WINDOW of cost(j) + WINDOW - (i - j),
                                min over powers of two k of cost(i - k) )

The first minimum is over a sliding window of ``cost(j) + j`` and comes from a monotone queue, the second
has ten terms, so each possible cut takes a bounded number of steps.  A window is settled as soon as the
layouts of all cuts that can still be a predecessor pass through its end: what is given out is the exact
optimum of the whole stream, and a task holds only what is not settled yet.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.packing import encode, token_bytes

WINDOW = 1024
SENTENCE_PENALTY = 4
TOKEN_PENALTY = 32
# Sentences over this many ids may be cut behind every ``TOKEN_STRIDE`` ids.
LONG_SENTENCE = 96
TOKEN_STRIDE = 16
# Ids, and possible cuts, that are worked on at once.
IDS_PER_STEP = 1 << 17
CUTS_PER_STEP = 5_000
# A stream that held this many ids without an agreed cut is cut at its last possible cut.
MOST_HELD = 1 << 24

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_TYPES = pa.schema([(name.split()[0], pa.int64()) for name in PIECES.split(", ")])

_BLANK, _STOP, _CLOSE = (np.isin(np.arange(256), list(signs)) for signs in (b"\t\n\v\f\r ", b".!?", b"\"')]"))


def sentence_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets where a sentence or a line of UTF-8 text ends: behind a mark and up to two closing
    signs before white space, behind a mark of Chinese or Japanese, behind a run of line breaks."""
    if len(data) < 3:
        return np.empty(0, np.int64)
    stop, close = _STOP[data], _CLOSE[data]
    ends = stop.copy()
    ends[1:] |= stop[:-1] & close[1:]
    ends[2:] |= stop[:-2] & close[1:-1] & close[2:]
    ends[:-1] &= _BLANK[data[1:]]
    line = data == 10
    ends[:-1] |= line[:-1] & ~line[1:]
    lead = np.flatnonzero((data[:-2] == 0xE3) | (data[:-2] == 0xEF))
    if len(lead):
        mark = data[lead].astype(np.int64) << 16 | data[lead + 1].astype(np.int64) << 8 | data[lead + 2]
        ends[lead[np.isin(mark, (0xE38082, 0xEFBC81, 0xEFBC9F))] + 2] = True
    return np.flatnonzero(ends) + 1


def possible_cuts(
    data: bytes, ids: np.ndarray, doc_ends: np.ndarray, most: int = LONG_SENTENCE, ranks_file: str | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of some documents as numbers of ids before them, and whether a cut is 0 the end of a
    document, 1 behind the id in which a sentence ends, 2 inside a sentence of over ``most`` ids.

    ``data`` are the texts and ``ids`` their ids, one after the other; the end id of a document is the
    one before its place in ``doc_ends`` and stands for no text."""
    lengths = token_bytes(ranks_file)[ids]
    lengths[doc_ends - 1] = 0
    cuts = np.searchsorted(np.cumsum(lengths), sentence_ends(np.frombuffer(data, np.uint8))) + 1
    kinds = np.full(len(ids) + 1, -1, np.int8)
    kinds[cuts] = 1
    kinds[doc_ends - 1] = -1                  # before an end id: not there
    kinds[doc_ends] = kinds[0] = 0
    places = np.flatnonzero(kinds >= 0)
    for wide in np.flatnonzero(np.diff(places) > most).tolist():
        kinds[places[wide] + TOKEN_STRIDE: places[wide + 1]: TOKEN_STRIDE] = 2
    places = np.flatnonzero(kinds >= 0)[1:]
    return places, kinds[places]


class WindowCuts:
    """Least-cost cuts of a stream whose possible cuts come in ascending order, no two further apart
    than ``window``.  The stream begins at place 0."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
        self._begin(0)

    def _begin(self, place: int) -> None:
        self.places, self.costs, self.before, self.queue = [place], [0], [-1], [0]

    def _exact(self, places: list[int]) -> tuple[list[int], list[int]]:
        """Pairs of a new cut and an earlier one a power of two before it, by the new cut; the last
        pair is a stop."""
        known = len(self.places)
        recent = max(0, bisect_left(self.places, places[0] - self.window))
        base = self.places[recent]
        new = np.array(places) - base
        number = np.full(new[-1] + 1, -1)
        number[np.array(self.places[recent:]) - base] = np.arange(recent, known)
        number[new] = np.arange(known, known + len(new))
        back = new[:, None] - np.array(self.powers)
        found = np.where(back >= 0, number[np.maximum(back, 0)], -1)
        row, column = np.nonzero(found >= 0)
        return [*(known + row).tolist(), -1], [*found[row, column].tolist(), -1]

    def add(self, places: list[int], penalties: list[int]) -> None:
        window, at, costs, before, queue = self.window, self.places, self.costs, self.before, self.queue
        (later, earlier), pair, head, n = self._exact(places), 0, 0, len(at)
        for place, penalty in zip(places, penalties, strict=True):
            oldest = place - window
            while at[queue[head]] < oldest:
                head += 1
            chosen = queue[head]
            cost = costs[chosen] + at[chosen] - oldest
            while later[pair] == n:
                if costs[earlier[pair]] < cost:
                    chosen = earlier[pair]
                    cost = costs[chosen]
                pair += 1
            cost += penalty
            at.append(place)
            costs.append(cost)
            before.append(chosen)
            key = cost + place
            while len(queue) > head and costs[queue[-1]] + at[queue[-1]] > key:
                queue.pop()
            queue.append(n)
            n += 1
        del queue[:head]

    def _path(self, node: int) -> list[int]:
        cuts = []
        while node >= 0:
            cuts.append(self.places[node])
            node = self.before[node]
        return cuts[::-1]

    def settled(self) -> list[int]:
        """Cuts, the last settled one first, up to the last that every layout still open passes
        through; the stream goes on from there."""
        last = len(self.places) - 1
        open_nodes = {n for n in range(last, -1, -1) if self.places[n] > self.places[last] - self.window}
        node = last
        while len(open_nodes) > 1:
            if node in open_nodes:
                open_nodes.remove(node)
                open_nodes.add(self.before[node])
            node -= 1
        agreed = open_nodes.pop()
        cuts = self._path(agreed)
        if agreed:
            # nodes that no open layout uses keep a predecessor below zero: none is followed
            self.places, self.costs = self.places[agreed:], [c - self.costs[agreed] for c in self.costs[agreed:]]
            self.before = [-1, *(b - agreed for b in self.before[agreed + 1:])]
            self.queue = [q - agreed for q in self.queue if q >= agreed]
        return cuts

    def ended(self) -> list[int]:
        """Cuts, the last settled one first, up to the end of what was added; a new stream begins there."""
        cuts = self._path(len(self.places) - 1)
        self._begin(cuts[-1])
        return cuts


class _Stream:
    """The documents of a task: ids not settled yet, and the pieces of what is."""

    def __init__(self, window: int, penalties: tuple[int, int, int], first_sequence: int, ranks_file: str | None = None):
        self.cuts, self.window, self.ranks_file = WindowCuts(window), window, ranks_file
        self.settle_at = 4 * CUTS_PER_STEP
        self.waiting: list[tuple[bytes, np.ndarray]] = []
        self.waits = 0
        self.penalties = np.array(penalties)
        self.sequence, self.begin, self.end = first_sequence, 0, 0
        self.ids = np.empty(0, "<u4")
        self.more: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []      # doc_id, place of its first id, ids

    def add(self, doc_id: int | None, text: str | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.docs.append((doc_id, self.end, len(ids)))
        self.waiting.append(((text or "").encode(), ids))
        self.end += len(ids)
        self.waits += len(ids)
        if self.waits >= IDS_PER_STEP:
            yield from self._cut()

    def _cut(self) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([i for _, i in self.waiting])
        doc_ends = np.cumsum([len(i) for _, i in self.waiting])
        data = b"".join(t for t, _ in self.waiting)
        places, kinds = possible_cuts(data, ids, doc_ends, min(LONG_SENTENCE, self.window), self.ranks_file)
        places, penalties = places + (self.end - self.waits), self.penalties[kinds]
        self.more.append(ids)
        self.waiting, self.waits = [], 0
        for lo in range(0, len(places), CUTS_PER_STEP):
            step = slice(lo, lo + CUTS_PER_STEP)
            self.cuts.add(places[step].tolist(), penalties[step].tolist())
            if len(self.cuts.places) > self.settle_at:
                done = self.cuts.settled()
                if self.cuts.places[-1] - self.cuts.places[0] > MOST_HELD:
                    done = done[:-1] + self.cuts.ended()
                self.settle_at = 2 * len(self.cuts.places) + 4 * CUTS_PER_STEP
                yield from self._pieces(done)

    def ended(self) -> Iterator[pa.RecordBatch]:
        if self.waits:
            yield from self._cut()
        if self.end > self.begin:
            yield from self._pieces(self.cuts.ended())

    def _pieces(self, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        if len(cuts) < 2:
            return
        ids = np.concatenate([self.ids, *self.more])
        edges, upto = np.array(cuts), cuts[-1]
        starts = np.array([first for _, first, _ in self.docs])
        breaks = np.unique(np.concatenate([edges, starts[(starts >= self.begin) & (starts < upto)]]))
        lo, hi = breaks[:-1], breaks[1:]
        doc = np.searchsorted(starts, lo, "right") - 1
        sequence = np.searchsorted(edges, lo, "right") - 1
        crc = [zlib.crc32(ids[a:b]) for a, b in zip((lo - self.begin).tolist(), (hi - self.begin).tolist(), strict=True)]
        columns = [
            pa.array([self.docs[d][0] for d in doc.tolist()], pa.int64()), pa.array(lo - starts[doc]), pa.array(hi - lo),
            pa.array(crc, pa.int64()), pa.array([self.docs[d][2] for d in doc.tolist()], pa.int64()),
            pa.array(self.sequence + sequence), pa.array(lo - edges[sequence]),
        ]
        self.sequence += len(edges) - 1
        self.ids, self.more = ids[upto - self.begin:].copy(), []
        self.begin = upto
        self.docs = [d for d in self.docs if d[1] + d[2] > upto]
        yield pa.RecordBatch.from_arrays(columns, schema=_TYPES)


def pack_in_order(
    docs: DataFrame, window: int = WINDOW, sentence_penalty: int = SENTENCE_PENALTY, token_penalty: int = TOKEN_PENALTY,
    ranks_file: str | None = None,
) -> DataFrame:
    """Pieces of all ``docs(doc_id, text)`` and their places in sequences of at most ``window`` ids.

    One row per piece: doc_id, its ``start`` and ``length`` in the document's ``doc_tokens`` ids (the end
    id included), the crc32 of its ids as little-endian unsigned 32-bit numbers, the sequence and the
    place there.  Each id lies in one piece.  Documents keep the order in which the partitions of
    ``docs`` hold them; one pass without a shuffle, each partition a stream of its own, so the last
    sequence of a partition may be short.  Sequence ids are the partition's number times 2**40 plus a
    number, so a task that runs again gives the same rows.  Null and empty texts have the end id alone;
    rows without doc_id keep null; repeated rows are documents of their own; other columns are left
    out; an empty table gives no rows.  A task holds the ids of one text and those not settled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(window, (0, sentence_penalty, token_penalty), TaskContext.get().partitionId() << 40, ranks_file)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                yield from stream.add(doc_id, text, encode(text, ranks_file))
        yield from stream.ended()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, PIECES)
