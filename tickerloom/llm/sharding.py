"""Balanced shards by Karmarkar-Karp differencing of indivisible groups (rows with equal texts).

A partial partition is a vector of shard sums.  Differencing repeatedly takes the two vectors with
the largest spread and adds them oppositely ordered, so large sums meet small ones.

At scale the groups never meet in one task.  Large groups (more than one in ``FINE`` of a shard, by
bytes or by rows, so at most ``2 * shards * FINE`` of them) are differenced in one small task.  All
other groups are dealt by hash into bounded tasks; each begins from a vector of what its shards lack
beside the large groups and differences its own groups into it, so the sums of all tasks end level.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerloom.llm.shared import stored

FINE = 2048
GROUPS_PER_TASK = 100_000
ROWS_PER_BUCKET = 100_000


def differenced(sizes: Sequence[int], shards: int, begun: Sequence[int] | None = None) -> list[int]:
    """Shard of every item.  ``begun`` holds what the shards have already; labels then count, and
    the result adds to shard ``k`` what ``begun[k]`` leaves open.  Ties go by item order."""
    items: list[tuple] = []
    # a node is (item,) for a leaf or (left, right, order): part k of the node is part k of left
    # with part order[k] of right; sums are kept rising with their part numbers
    for at, size in enumerate(sizes):
        parts = [(0, k) for k in range(shards - 1)] + [(size, shards - 1)]
        items.append((-size, at, parts, at))
    number = len(items)
    if begun is not None:
        low = min(begun)
        parts = sorted((b - low, k) for k, b in enumerate(begun))
        items.append((-(parts[-1][0] - parts[0][0]), number, parts, None))
        number += 1
    heapq.heapify(items)
    while len(items) > 1:
        _, _, a, left = heapq.heappop(items)
        _, _, b, right = heapq.heappop(items)
        mixed = sorted((x[0] + y[0], k, x[1], y[1]) for k, (x, y) in enumerate(zip(a, reversed(b), strict=True)))
        low = mixed[0][0]
        pairs = [(p, q) for _, _, p, q in mixed]
        heapq.heappush(items, (-(mixed[-1][0] - low), number, [(m[0] - low, k) for k, m in enumerate(mixed)], (left, right, pairs)))
        number += 1
    shard = [0] * len(sizes)
    if not items:
        return shard
    where: dict[int, int] = {}
    # walk down: the part of the whole that each part of a node belongs to
    todo = [(items[0][3], list(range(shards)))]
    while todo:
        node, label = todo.pop()
        if node is None:
            where = dict(enumerate(label))
        elif isinstance(node, tuple):
            left, right, pairs = node
            up, down = [0] * shards, [0] * shards
            for k, (p, q) in enumerate(pairs):
                up[p], down[q] = label[k], label[k]
            todo += [(left, up), (right, down)]
        else:
            shard[node] = label[shards - 1]
    if begun is not None:             # the begun vector's parts name the shards
        back = {label: k for k, label in where.items()}
        shard = [back[s] for s in shard]
    return shard


def level(large: Sequence[int], rest: int) -> list[float]:
    """What each shard takes of ``rest`` so that all end as level as they can."""
    room = sorted(large)
    for k in range(len(room), 0, -1):
        height = (sum(room[:k]) + rest) / k
        if height >= room[k - 1]:
            break
    return [max(0.0, height - have) for have in large]


def balanced_shards(rows: DataFrame, key: str, size: str, shards: int = 8) -> DataFrame:
    """``rows`` with ``shard``: groups of equal ``key`` stay together, summed ``size`` near equal.

    ``rows`` must be stored, since it is read several times.  A null key is a group; sizes must not
    be null.  An empty table gives an empty table.  Existing columns stay; ``shard`` is replaced.
    """
    rows = rows.drop("shard")
    groups = stored(rows.groupBy(F.col(key).alias("_key")).agg(
        F.sum(size).cast("long").alias("_size"), F.count(F.lit(1)).alias("_rows")), "groups")
    total = groups.agg(F.sum("_size"), F.sum("_rows"), F.count(F.lit(1))).first()
    if not total[2]:
        return rows.withColumn("shard", F.lit(None).cast("int"))
    heavy = (F.col("_size") * (shards * FINE) > total[0]) | (F.col("_rows") * (shards * FINE) > total[1])
    # at most 2 * shards * FINE rows: more cannot exceed the shares above
    large = sorted(groups.where(heavy).collect(), key=lambda g: (-g["_size"], g["_key"] is not None, g["_key"]))
    placed = differenced([g["_size"] for g in large], shards)
    sums = [0] * shards
    for g, s in zip(large, placed, strict=True):
        sums[s] += g["_size"]
    rest = total[0] - sum(sums)
    share = [-want / rest if rest else 0.0 for want in level(sums, rest)]
    small = groups.where(~heavy)
    tasks = max(1, -(-(total[2] - len(large)) // GROUPS_PER_TASK))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = list(batches)
        keys = [k for b in table for k in b.column(0).to_pylist()]
        sizes = [n for b in table for n in b.column(1).to_pylist()]
        mine = sum(sizes)
        got = differenced(sizes, shards, [round(mine * s) for s in share]) if sizes else []
        yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(got, pa.int32())], names=["_key", "shard"])

    from pyspark.sql.pandas.types import to_arrow_type

    spark, key_type = rows.sparkSession, groups.schema["_key"].dataType
    kind = to_arrow_type(key_type)
    dealt = small.select("_key", "_size").repartition(tasks, F.xxhash64("_key")) \
        .sortWithinPartitions(F.desc("_size"), "_key").mapInArrow(deal, f"_key {key_type.simpleString()}, shard int")
    dealt = stored(dealt, "dealt")    # one answer, whichever tasks are run again
    fixed = spark.createDataFrame([(g["_key"], s) for g, s in zip(large, placed, strict=True)], f"_key {key_type.simpleString()}, shard int")
    # hot keys are all large, and that table is bounded: broadcast.  The others meet in a shuffle.
    first = rows.join(F.broadcast(fixed.withColumnRenamed("shard", "_large")), rows[key].eqNullSafe(F.col("_key")), "left").drop("_key")
    done = first.where("_large is not null").withColumn("shard", F.col("_large"))
    left = first.where("_large is null")
    others = left.join(dealt, left[key].eqNullSafe(dealt["_key"])).drop("_key")
    return done.unionByName(others).drop("_large")


def with_slots(placed: DataFrame, order: Iterable[str]) -> DataFrame:
    """``placed`` (stored) with ``slot``: gapless from 0 within each ``shard``.

    Rows are numbered within hashed buckets of bounded size; the buckets' counts give the offsets.
    """
    order = list(order)
    buckets = max(1, -(-placed.count() // ROWS_PER_BUCKET))
    cut = placed.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = cut.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_bucket").orderBy(*order)
    return cut.withColumn("_place", F.row_number().over(inside) - 1).join(offsets, ["shard", "_bucket"]) \
        .withColumn("slot", (F.col("_place") + F.col("_before")).cast("long")).drop("_bucket", "_place", "_before")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard and slot of every row of ``docs(doc_id, text)``.

    Null text counts as empty and lies with it.  Rows without doc_id and repeated rows are rows of their
    own, with the group of their text; other columns are not read; an empty table gives no rows."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("_text")), "sizes")
    placed = stored(balanced_shards(sized, "_text", "size", shards).drop("_text"), "placed")
    slots = with_slots(placed, ["doc_id", "text_crc32", "size"])
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
