"""Prefix trie of conversations by fixed-length block hashing.

A node of depth ``d`` is a distinct sequence of the first ``d`` turns; its members are the conversations
that begin with it.  Conversations are cut into blocks of ``BLOCK`` turns.  A block's digest is the XOR of
its turns' digests, each mixed with its place, so the digest of a prefix is the XOR of its blocks':

1. conversations are grouped by the digests of their successive blocks; a group is a block node with a
   number of members and a least member, its representative;
2. where a block node has no sibling, all its turns have the same members: the turns of the representative
   are its nodes as they are;
3. where siblings diverge, the turns of their representatives, not of all members, are grouped by the
   digest of the prefix up to each turn.

A node is known by its least member and its depth.  What a subtree holds needs no walk down the trie: a
conversation is least member of the nodes on the lower end of its path alone, so the sum over a subtree
is the sum of what its members are least member of, less what its own least member is above it; two more
sums over the same groups.

Digests are pairs of 64-bit hashes.  A key may hold any share of the rows: turns are placed by range, not
by conversation, running sums go by chunks of ``CHUNK`` rows, joins on a conversation by (conversation,
chunk), groups are pre-aggregated, and the few parents with many children are sent to all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.shared import stored

BLOCK = 8
CHUNK = 4096
# Ids that one piece of a list of ids may span.
ENDS_SPAN = 256
# A parent with more than this share of all nodes as children is sent to all tasks: at most 1000 rows.
HEAVY_SHARE = 1000

_NODE = ["depth", "x", "y"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, a, b, n_bytes)``: the digests of all turns, numbered from 0 within the conversation.

    Turns are ordered by ``turn``, null first; equal turns by role, then by the digest of role and text,
    and repeated rows are turns of their own.  Null role or text counts as empty; rows without conv_id
    belong to no conversation and are left out; other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    order = ["conv_id", "turn", "role", "a", "b"]
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("turn"), text, role).alias("b"), F.octet_length(text).cast("long").alias("n_bytes"))
    placed = stored(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "turns")
    # a part goes on with at most one conversation of the part before: no more rows than parts
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("part", "conv_id").count().withColumn("before", F.sum("count").over(earlier)).where("before > 0")
    here = Window.partitionBy("part", "conv_id").orderBy(*order[1:])
    return placed.withColumn("n", F.row_number().over(here)) \
        .join(F.broadcast(before.select("part", "conv_id", "before")), ["part", "conv_id"], "left") \
        .select("conv_id", (F.col("n") - 1 + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "a", "b", "n_bytes")


def chunk_of(place: Column) -> Column:
    """The chunk of a key's row at ``place`` (from 0)."""
    return F.floor(place / CHUNK)


def per_chunk(keys: DataFrame, rows: Column) -> DataFrame:
    """A row per key and ``chunk``, for joins with a key's rows by both; a key has ``rows`` of them."""
    last = F.greatest(chunk_of(rows - 1), F.lit(0).cast("long"))
    return keys.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _running(rows: DataFrame, key: list[str], place: str, sums: dict[str, str], fold) -> DataFrame:
    """``rows`` with, for each ``{column: name}``, the ``fold`` of the column over the rows of the key at
    smaller places.  Windows hold ``CHUNK`` places of a key, or one row per chunk of it."""
    rows = rows.withColumn("chunk", chunk_of(F.col(place)))
    here = Window.partitionBy(*key, "chunk").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*key).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*key, "chunk").agg(*(fold(c).alias(f"_{c}") for c in sums))
    offsets = totals.select(*key, "chunk", *(fold(f"_{c}").over(above).alias(f"_{c}") for c in sums)).where("chunk > 0")
    zero = F.lit(0).cast("long")
    out = rows.select("*", *(F.coalesce(fold(c).over(here), zero).alias(name) for c, name in sums.items())) \
        .join(offsets, [*key, "chunk"], "left")
    joined = (lambda a, b: a.bitwiseXOR(b)) if fold is F.bit_xor else (lambda a, b: a + b)
    for c, name in sums.items():
        out = out.withColumn(name, joined(F.col(name), F.coalesce(f"_{c}", zero))).drop(f"_{c}")
    return out


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """``(depth, x, y, ends_sha256)`` from ``ends(depth, x, y, conv_id)``: the digest of the ids in
    ascending order.  Lists hold ``ENDS_SPAN`` ids at most; a node's lists run through one digest."""
    span = ends.groupBy(*_NODE, F.floor(F.col("conv_id") / ENDS_SPAN).alias("span")) \
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(done)
        if node is not None:
            yield _rows([(*node, digest.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        types = pa.schema([("depth", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("ends_sha256", pa.string())])
        return pa.RecordBatch.from_pylist([dict(zip(types.names, r, strict=True)) for r in done], schema=types)

    return span.repartition(*_NODE).sortWithinPartitions(*_NODE, "span").select(*_NODE, "ids") \
        .mapInArrow(run, "depth long, x long, y long, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns(conv_id, pos, a, b, n_bytes, n_turns)``, rows as of
    ``numbered_turns`` with the conversation's number of turns; ``lengths(conv_id, n_turns)`` has one
    row per conversation, turnless ones included.

    Columns: ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (the parent's; null at the root),
    ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` of the subtree (per node the members
    after the first times the bytes of its last text), and ``ends_sha256``, of the ids of the members
    without further turns, ascending, joined by commas.  No conversations, no rows.
    """
    lengths = stored(lengths.select("conv_id", "n_turns"), "lengths")
    place = F.col("pos")
    turns = stored(turns.select(
        "conv_id", "pos", F.floor(place / BLOCK).alias("block"), F.xxhash64("pos", "a", "b").alias("tx"),
        F.xxhash64("b", "pos", "a").alias("ty"), "n_bytes", "n_turns"), "trie-turns")

    # 1. block nodes: conversations by the digests of their successive blocks
    blocks = turns.groupBy("conv_id", "block").agg(
        F.bit_xor("tx").alias("bx"), F.bit_xor("ty").alias("by"), F.count(F.lit(1)).alias("size"), F.max("n_turns").alias("n_turns"))
    blocks = stored(
        _running(blocks, ["conv_id"], "block", {"bx": "qx", "by": "qy"}, F.bit_xor)
        .select("conv_id", "block", "chunk", "size", "n_turns", "qx", "qy", (F.col("qx").bitwiseXOR(F.col("bx"))).alias("x"),
                (F.col("qy").bitwiseXOR(F.col("by"))).alias("y")), "blocks")
    key = ["block", "qx", "qy", "x", "y", "size"]
    groups = stored(blocks.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("rep")), "block-nodes")
    alone = groups.groupBy("block", "qx", "qy").agg(F.count(F.lit(1)).alias("siblings"), F.min("rep").alias("rep")) \
        .where("siblings = 1").select("block", "rep", F.lit(True).alias("alone"))

    # 2. and 3. turn nodes of the representatives, grouped only where siblings diverge
    inside = Window.partitionBy("rep", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    refined = stored(
        groups.join(alone, ["block", "rep"], "left")
        .join(turns.select(F.col("conv_id").alias("rep"), "block", "pos", "tx", "ty", "n_bytes"), ["rep", "block"])
        .select(
            "rep", "block", "n", F.coalesce("alone", F.lit(False)).alias("alone"), "n_bytes", (F.col("pos") + 1).alias("depth"),
            F.col("qx").bitwiseXOR(F.bit_xor("tx").over(inside)).alias("x"), F.col("qy").bitwiseXOR(F.bit_xor("ty").over(inside)).alias("y"),
            "tx", "ty"), "refined")
    found = refined.where("alone").select(*_NODE, "rep", "n", "n_bytes", "tx", "ty").unionByName(
        refined.where("not alone").groupBy(*_NODE).agg(
            F.min("rep").alias("rep"), F.sum("n").alias("n"), *(F.min(c).alias(c) for c in ("n_bytes", "tx", "ty"))))
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 0") \
        .select(*(zero.alias(c) for c in _NODE), "rep", "n", *(zero.alias(c) for c in ("n_bytes", "tx", "ty")))
    nodes = found.unionByName(root).select(
        *_NODE, "rep", "n", (F.col("n_bytes") * (F.col("n") - 1)).alias("own"),
        F.col("x").bitwiseXOR(F.col("tx")).alias("px"), F.col("y").bitwiseXOR(F.col("ty")).alias("py"))
    nodes = stored(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes-children")

    # sums over subtrees, from what each conversation is least member of
    held = nodes.groupBy(F.col("rep").alias("conv_id")).agg(
        F.sum("own").alias("held"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")).where("held > 0 or leaf > 0")
    held = stored(held, "held")
    by_chunk = per_chunk(held.join(lengths, "conv_id"), F.ceil(F.col("n_turns") / BLOCK)).select("conv_id", "chunk", "held", "leaf")
    sums = blocks.join(by_chunk, ["conv_id", "chunk"]).groupBy(*key).agg(F.sum("held").alias("held"), F.sum("leaf").alias("leaf"))
    sums = groups.join(sums, key).select("rep", "block", "held", "leaf")
    spread = refined.join(sums, ["rep", "block"]).select(*_NODE, "alone", "held", "leaf")
    below = spread.where("alone").drop("alone").unionByName(
        spread.where("not alone").groupBy(*_NODE).agg(F.sum("held").alias("held"), F.sum("leaf").alias("leaf"))).unionByName(
        held.agg(F.sum("held").alias("held"), F.sum("leaf").alias("leaf")).select(*(zero.alias(c) for c in _NODE), "held", "leaf"))
    above = _running(nodes, ["rep"], "depth", {"own": "above"}, F.sum)

    # the least member of the parent: parents with very many children are sent to all tasks
    limit = max(10_000, nodes.count() // HEAVY_SHARE)
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("rep").alias("parent_conv_id"), "n_children")
    heavy = F.broadcast(parents.where(F.col("n_children") > limit).drop("n_children"))
    link = ["depth", "px", "py"]
    ids = nodes.select(*_NODE, "px", "py")
    linked = ids.join(heavy, link).select(*_NODE, "parent_conv_id").unionByName(
        ids.join(heavy, link, "left_anti").join(parents.where(F.col("n_children") <= limit).drop("n_children"), link)
        .select(*_NODE, "parent_conv_id"))

    ends = blocks.where(f"block = floor((n_turns - 1) / {BLOCK})").select(F.col("n_turns").alias("depth"), "x", "y", "conv_id") \
        .unionByName(lengths.where("n_turns = 0").select(*(zero.alias(c) for c in _NODE), "conv_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return above.join(below, _NODE, "left").join(linked, _NODE, "left").join(_hashed_ends(ends), _NODE, "left").select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.coalesce("leaf", zero).alias("n_leaves"), (F.coalesce("held", zero) - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
