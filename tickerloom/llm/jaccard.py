"""Similarity join on word n-grams and the classes it makes.

Rows with equal shingle sets are one node from the start.  Shingles have one global order, rare ones
first, so two sets alike enough share a shingle among the first few of each: those prefixes are the
only rows that meet, on the shingle.  Pairs pass a length filter, a positional filter and a suffix
filter, and every pair left is verified once on the whole sets.

No shingle gives all pairs of its nodes.  First every node meets the pivot of each of its prefix
shingles (as many rows as postings), and the links found make classes.  The pivot is the node that has
the shingle earliest in its order: what a copy changed is rare and comes first, so the text copied from
stands before its copies.  Then only nodes outside the class of the pivot meet the others, and only
where classes differ: within a class nothing is left to find.  So a group of near copies costs a row
per posting, and no link between classes is lost.

The suffix filter bounds from below how many shingles two sets do not share.  Every shingle belongs to
a hash range; sets that differ little have equal parities of their counts in most ranges.  These
parities, 256 bits, are compared once per pair of a node and a pivot, and inside the join where other
nodes meet, before a pair becomes a row; counts per range follow for each pair.

The order comes from a fixed number of counters over all shingles of all texts.  It decides how many
pairs are met, never which ones qualify.  Shingles and nodes are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.components import components
from tickerloom.llm.shared import free_names, mix64, shingles, sliced, stored, trimmed, word_hashes

WORDS = 5
PERCENT = 80
COUNTER_BITS = 25                       # counters of the order: a byte each, a fixed 32 MB
COUNTER_PARTS = 64
RANGES = 32                             # hash ranges of the suffix filter, by counts
PARITY = ("p0", "p1", "p2", "p3")       # and by parities, 64 ranges to a number
BROADCAST_NODES = 500_000

SIZES = "doc_id long, n int, node long, spread array<int>, p0 long, p1 long, p2 long, p3 long, part int, counts binary"
POSTINGS = "shingle long, node long, n int, place int"


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of ``(first row, shingles, offsets)``: the distinct shingles of each row, rising."""
    for row, hashes, offsets in word_hashes(column):
        at, values = shingles(hashes, offsets, words)
        order = np.lexsort((values, at))
        at, values = at[order], values[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (values[1:] != values[:-1])
        at, values = at[new], values[new]
        yield row, values, np.searchsorted(at, np.arange(len(offsets)))


def _nodes(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One number per row for its set: equal sets have equal numbers."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values), dtype=np.uint64)])
    total = sums[offsets[1:]] - sums[offsets[:-1]]
    return mix64(total + np.diff(offsets).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)).view(np.int64)


def _parities(values: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per row, four numbers of 64 parities: of the shingles in each of 256 hash ranges."""
    bit = np.uint64(1) << (values >> np.uint64(40) & np.uint64(63))
    word = values >> np.uint64(46) & np.uint64(3)
    some = np.flatnonzero(np.diff(offsets))
    out = []
    for k in range(4):
        total = np.zeros(len(offsets) - 1, np.uint64)
        if len(some):
            total[some] = np.bitwise_xor.reduceat(np.where(word == k, bit, np.uint64(0)), offsets[some])
        out.append(total.view(np.int64))
    return out


def _counter(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _sizes(docs: DataFrame, words: int) -> DataFrame:
    """Two kinds of rows in one pass: every document with its node, and each task's counters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTER_BITS, np.uint8)     # a task counts to 255; sums over tasks go on
        nothing = pa.nulls
        for batch in batches:
            for row, values, offsets in _sets(batch.column(1), words):
                rows = len(offsets) - 1
                met, times = np.unique(_counter(values), return_counts=True)
                counts[met] = np.minimum(counts[met] + times, 255)
                of = np.repeat(np.arange(rows), np.diff(offsets))
                ranges = (values >> np.uint64(64 - RANGES.bit_length() + 1)).astype(np.int64)
                spread = np.bincount(of * RANGES + ranges, minlength=rows * RANGES).astype(np.int32)
                parity = [pa.array(p) for p in _parities(values, offsets)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, rows), pa.array(np.diff(offsets).astype(np.int32)), pa.array(_nodes(values, offsets)),
                    pa.ListArray.from_arrays(np.arange(0, len(spread) + 1, RANGES, dtype=np.int32), spread),
                    *parity, nothing(rows, pa.int32()), nothing(rows, pa.binary())], names=["doc_id", "n", "node", "spread", *PARITY, "part", "counts"])
        parts = np.split(counts, COUNTER_PARTS)
        packer = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays([
            nothing(len(parts), pa.int64()), nothing(len(parts), pa.int32()), nothing(len(parts), pa.int64()), nothing(len(parts), pa.list_(pa.int32())),
            *[nothing(len(parts), pa.int64())] * 4, pa.array(range(len(parts)), pa.int32()), pa.array([packer.compress(p.tobytes()) for p in parts], pa.binary())],
            names=["doc_id", "n", "node", "spread", *PARITY, "part", "counts"])

    return stored(_texts(docs).mapInArrow(trimmed(run), SIZES), "sizes")


def _order(sizes: DataFrame) -> dict[int, bytes]:
    """Summed counters on a scale of doublings, a byte each: ``2**COUNTER_BITS`` bytes at any size, in
    compressed parts, which is how they pass through the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.uint8).astype(np.int32)
                sums[part] = sums[part] + more if part in sums else more
        packer = zstandard.ZstdCompressor(level=3)
        level = {p: packer.compress(np.minimum(8 * np.log2(1 + s), 255).astype(np.uint8).tobytes()) for p, s in sums.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(level), pa.int32()), pa.array(list(level.values()), pa.binary())], names=["part", "counts"])

    rows = sizes.where("part is not null").select("part", "counts").repartition("part").mapInArrow(trimmed(run), "part int, counts binary")
    return {r.part: bytes(r.counts) for r in rows.toLocalIterator()}


def _levels(parts: dict[int, bytes]) -> np.ndarray:
    out = np.zeros((COUNTER_PARTS, (1 << COUNTER_BITS) // COUNTER_PARTS), np.uint8)
    for part, packed in parts.items():
        out[part] = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return out.reshape(-1)


def _postings(docs: DataFrame, order: dict[int, bytes], words: int, percent: int) -> DataFrame:
    """Prefix shingles of every set with their place in the order; equal sets of a task once."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = _levels(shared.value), np.empty(0, np.int64)
        for batch in batches:
            for row, values, offsets in _sets(batch.column(1), words):
                nodes, size = _nodes(values, offsets), np.diff(offsets)
                named = batch.column(0).slice(row, len(size)).is_valid().to_numpy(zero_copy_only=False)
                fit = np.flatnonzero(named & (size > 0) & ~np.isin(nodes, seen))
                new = np.zeros(len(size), bool)
                new[fit[np.unique(nodes[fit], return_index=True)[1]]] = True
                seen = np.union1d(seen, nodes[new])
                of = np.repeat(np.arange(len(size)), size)
                by = np.lexsort((values, level[_counter(values)], of))
                place = np.arange(len(values)) - offsets[of]
                prefix = size - -(-percent * size // 100) + 1
                keep = new[of] & (place < prefix[of])
                of, place = of[keep], place[keep]
                yield pa.RecordBatch.from_arrays([
                    pa.array(values[by][keep].view(np.int64)), pa.array(nodes[of]), pa.array(size[of].astype(np.int32)), pa.array(place.astype(np.int32))],
                    names=["shingle", "node", "n", "place"])

    postings = stored(_texts(docs).mapInArrow(trimmed(run), POSTINGS), "postings")
    shared.destroy()
    return postings


def _need(percent: int, n: str, other_n: str) -> Column:
    """The least number of shingles that linked sets of these sizes share."""
    return F.expr(f"({percent}L * ({n} + {other_n}) + {99 + percent}) div {100 + percent}")


def _may_link(percent: int) -> Column:
    """Whether a row's two nodes, met on a shingle, pass the length and the positional filter.

    A linked pair is looked for where it meets first in the order: nothing before that shingle is in
    both sets, so all they share stands from it on in either.  Where linked sets meet again they may
    fail; sets that are alike but not enough, whose own shingles come first, fail everywhere."""
    small, large = F.least("n", "other_n"), F.greatest("n", "other_n")
    behind = F.least(F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place"))
    return (small * 100 >= large * percent) & (behind >= _need(percent, "n", "other_n"))


def _parities_near(percent: int, n: str, other_n: str, mine: str, others: str) -> Column:
    """Whether the parities ``<mine>p0``.. and ``<others>p0``.. differ in no more ranges than linked sets can."""
    apart = [F.bit_count(F.col(mine + p).bitwiseXOR(F.col(others + p))) for p in PARITY]
    return sum(apart[1:], apart[0]) <= F.col(n) + F.col(other_n) - 2 * _need(percent, n, other_n)


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, known: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are alike enough: parities, then counts per range, then the sets."""
    node = known.select("node", "n", *PARITY)
    both = pairs.join(node.toDF("a", "a_n", *[f"a_{p}" for p in PARITY]), "a").join(node.toDF("b", "b_n", *[f"b_{p}" for p in PARITY]), "b")
    near = stored(both.where(_parities_near(percent, "a_n", "b_n", "a_", "b_")).select("a", "b", "a_n", "b_n"), "near")
    node = known.select("node", "spread")
    both = near.join(node.toDF("a", "a_spread"), "a").join(node.toDF("b", "b_spread"), "b")
    apart = F.aggregate(F.zip_with("a_spread", "b_spread", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    left = stored(both.where(apart <= F.col("a_n") + F.col("b_n") - 2 * _need(percent, "a_n", "b_n")).select("a", "b"), "pairs")

    wanted = left.select(F.col("a").alias("node")).unionByName(left.select(F.col("b").alias("node"))).distinct()
    sample = known.join(wanted, "node", "left_semi").select("doc_id").distinct()
    few = sample.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    texts = _texts(docs).join(F.broadcast(sample) if few else sample, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, values, offsets in _sets(batch.column(1), words):
                yield pa.RecordBatch.from_arrays([
                    pa.array(_nodes(values, offsets)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))], names=["node", "grams"])

    # dealt by node once for both ends; only the sets of one end move to the other
    sets = texts.mapInArrow(trimmed(run), "node long, grams array<long>").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    met = left.join(sets.toDF("a", "a_grams"), "a").join(sets.toDF("b", "b_grams"), "b")
    shared = F.size(F.array_intersect("a_grams", "b_grams"))
    return stored(met.where(shared * 100 >= (F.size("a_grams") + F.size("b_grams") - shared) * percent).select("a", "b"), "links")


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n, node)`` of every row, and ``(node, root)`` of every node linked with another."""
    sizes = _sizes(docs, words)
    rows = sizes.where("part is null")
    postings = _postings(docs, _order(sizes), words, percent)
    known = stored(rows.where("doc_id is not null and n > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n", "spread", *PARITY)]), "nodes")
    ends = postings.groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("shingle")
    shared = stored(postings.join(ends, "shingle").distinct(), "shared")
    pivots = shared.groupBy("shingle").agg(F.min(F.struct("place", "node", "n")).alias("pivot"), F.count(F.lit(1)).alias("holders"))
    stars = stored(shared.join(pivots, "shingle").where("node <> pivot.node").select(
        "shingle", "node", "n", "place", F.col("pivot.node").alias("other"), F.col("pivot.n").alias("other_n"),
        F.col("pivot.place").alias("other_place"), "holders"), "stars")
    links = _verified(_pairs(stars.where(_may_link(percent))), docs, known, words, percent)
    roots = components(links)

    # the pivot met everyone already: what is left is between other holders, where there are two
    rest = stored(stars.where("holders > 2").select("shingle", "node", "n", "place", F.col("other").alias("pivot"))
                  .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
                  .join(roots.toDF("pivot", "main"), "pivot", "left").withColumn("inside", F.col("root") == F.coalesce("main", "pivot"))
                  .drop("pivot", "main").join(known.select("node", *PARITY), "node"), "rest")
    outside = rest.where("not inside")
    if not outside.isEmpty():
        named = {c: f"other_{c}" for c in ("n", "place", "root", "inside", *PARITY)} | {"node": "other"}
        other = rest.select("shingle", *[F.col(c).alias(name) for c, name in named.items()])
        once = F.col("other_inside") | (F.col("node") < F.col("other"))
        met = outside.join(other, "shingle").where((F.col("root") != F.col("other_root")) & once & _may_link(percent)
                                                   & _parities_near(percent, "n", "other_n", "", "other_"))
        roots = components(links.unionByName(_verified(_pairs(met), docs, known, words, percent)))
    return rows.select("doc_id", "n", "node"), roots


def near_duplicate_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``n_shingles``, ``component_id`` (the least doc_id reachable
    by links), ``node`` (equal for equal shingle sets) and ``class_id`` (equal in a class).

    Words are runs of anything but white space, A-Z lower-cased; a text with fewer words than a
    shingle is one shingle; null, empty and blank texts have none and link with nothing.  Rows link
    when ``100 * common >= percent * union`` of their distinct shingles.  Rows are documents of their
    own even where doc_ids repeat; a row without doc_id links with nothing and has no component.
    """
    rows, roots = _classes(docs, words, percent)
    named = rows.where("doc_id is not null and n > 0").groupBy("node").agg(F.min("doc_id").alias("least")) \
        .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select("node", "component", "root")
    joined = rows.join(named, "node", "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.cast("long").alias("component_id"), "node",
                         F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("class_id"))


def one_per_class(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each class of near copies: that of the least doc_id, all columns.

    Rows without doc_id and rows without words stay.  Of equal rows one stays.
    """
    classes = stored(near_duplicate_classes(docs, words, percent), "classes")
    names = docs.columns
    node, some, least, its = free_names(names, "node", "some", "least", "its_node")
    kept = classes.where("doc_id = component_id and n_shingles > 0").groupBy("class_id").agg(
        F.min("doc_id").alias(least), F.min("node").alias(its)).drop("class_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            nodes, size = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for _, values, offsets in _sets(batch.column("text"), words):
                nodes.append(_nodes(values, offsets))
                size.append(np.diff(offsets))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(nodes)), pa.array(np.concatenate(size) > 0)], names=[*names, node, some])

    marked = docs.mapInArrow(trimmed(run), docs.select("*", F.lit(0).cast("long").alias(node), F.lit(True).alias(some)).schema)
    free = F.col("doc_id").isNull() | ~F.col(some)
    # rows of one class with the same doc_id and shingle set are copies: one of them
    chosen = marked.where(~free).join(kept, (F.col("doc_id") == F.col(least)) & (F.col(node) == F.col(its)), "left_semi") \
        .dropDuplicates(["doc_id", node])
    return marked.where(free).select(*names).unionByName(chosen.select(*names))
