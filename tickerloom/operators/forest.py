"""Random forests grown over stored rows of binned features, handed over as MLlib models.

A row is stored once, a byte per feature and its label.  Nothing is kept per row and tree: the rows that a
tree draws come from a generator seeded by tree and block, and the node that a row has reached from the splits
made so far, anew in each pass.  A pass counts one level of all trees, so a task holds one block of rows and
the counts of that level, and a level's counts are summed and its splits chosen per tree, in tasks.

Draws, splits, feature subsets, limits and pruning follow MLlib's forests (Poisson draws, 32 bins from a
sample of 10,000 rows, root or third of the features per node, Gini or variance), whose own fit keeps over
2 KB a row in memory and on disk and passes over that once per level.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.session import stored, work_folder

BLOCK_BITS = 15            # rows that a task holds at a time, as a power of two
SPLIT_SAMPLE = 10_000      # rows whose values the bins are cut by, as in MLlib
PURE = 1e-16               # impurity below which a node is a leaf
BINNED = "id long, bins binary, y double"
CHOSEN = ("tree int, node int, feature int, cut int, gain double, impurity double, total array<double>, raw long, "
          "lower array<double>, lower_raw long, upper array<double>, upper_raw long")


@dataclass
class Plan:
    """What all tasks know of a forest; ``weights`` are those of the classes, None for a regression."""

    trees: int
    depth: int
    min_leaf: int
    seed: int
    cuts: list[list[float]]            # thresholds of each feature
    weights: list[float] | None
    feature: np.ndarray = field(init=False)   # (tree, node) as in a heap, the root is 1; -1 without a split
    cut: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.feature = np.full((self.trees, 2 << self.depth), -1, np.int32)
        self.cut = np.zeros((self.trees, 2 << self.depth), np.uint8)

    @property
    def width(self) -> int:
        """Features of a node: their root in a classification, a third of them in a regression."""
        n = len(self.cuts)
        return n if self.trees == 1 else int(np.ceil(np.sqrt(n) if self.weights is not None else n / 3))

    @property
    def bins(self) -> int:
        return max(map(len, self.cuts), default=0) + 1

    def subsets(self, level: int, open_nodes: dict[int, list[int]]) -> dict[int, np.ndarray]:
        """The features that each open node looks at, as (node, place) arrays; none behind the last level."""
        width = self.width if level < self.depth else 0
        drawn = np.random.default_rng([self.seed, level]).random((self.trees, 1 << level, len(self.cuts)))
        return {t: np.sort(np.argsort(drawn[t, np.array(nodes) - (1 << level)])[:, :width]) for t, nodes in open_nodes.items()}


def thresholds(values: np.ndarray, weights: np.ndarray, most: int) -> list[float]:
    """At most ``most`` cuts between sampled values: between all of them, or even shares of the weight."""
    distinct, at = np.unique(values, return_inverse=True)
    between = (distinct[:-1] + distinct[1:]) / 2
    if len(between) <= most:
        return between.tolist()
    reached = np.cumsum(np.bincount(at, weights=weights))
    stride = reached[-1] / (most + 1)
    out, target = [], stride
    for i in range(1, len(distinct)):
        if abs(reached[i - 1] - target) < abs(reached[i] - target):
            out.append(float(between[i - 1]))
            target += stride
    return out[:most]


def _binned(rows: DataFrame, label: str, features: str, cuts: list[list[float]]) -> DataFrame:
    """``rows`` as bytes, numbered within their part, in the order in which they are stored."""
    edges = [np.array(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = len(batch)
            values = np.asarray(batch.column(0).flatten()).reshape(n, len(edges))
            out = np.empty((n, len(edges)), np.uint8)
            for k, e in enumerate(edges):
                out[:, k] = np.searchsorted(e, values[:, k])    # a bin holds the values up to its cut
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(edges))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(at, at + n)), pa.Array.from_buffers(pa.binary(), n, [None, ends.buffers()[1], pa.py_buffer(out)]),
                batch.column(1)], names=["id", "bins", "y"])
            at += n

    return rows.select(vector_to_array(features), F.col(label).cast("double")).mapInArrow(run, BINNED)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first id, bins by feature, labels)`` of consecutive rows, at most a block at a time."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 1 << BLOCK_BITS

    def block() -> tuple[int, np.ndarray, np.ndarray]:
        ids, bins, y = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        return int(ids[0]), np.ascontiguousarray(bins.T), y

    for batch in batches:
        ids, column = np.asarray(batch.column(0)), batch.column(1)
        begin = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[begin: begin + len(column) * width].reshape(len(column), width)
        y = np.asarray(batch.column(2))
        lo = 0
        while lo < len(ids):
            have = sum(len(h[0]) for h in held)
            if have and (have == size or held[-1][0][-1] + 1 != ids[lo]):
                yield block()
                have = 0
            hi = min(len(ids), lo + size - have)
            breaks = np.flatnonzero(np.diff(ids[lo:hi]) != 1)
            hi = lo + int(breaks[0]) + 1 if len(breaks) else hi
            held.append((ids[lo:hi], data[lo:hi], y[lo:hi]))
            lo = hi
    if held:
        yield block()


def _drawn(seed: int, first: int, tree: int, n: int) -> np.ndarray:
    """The rows that a tree draws from a block of ``n``: each as often as a Poisson number of mean 1 says.

    As many places of a whole block as a Poisson number of its size says, each equally likely, are just
    that for every place; those behind the last row are left out."""
    bits = np.random.PCG64([seed, first, tree])
    many = int(np.random.Generator(bits).poisson(1 << BLOCK_BITS))
    places = bits.random_raw(-(-many // 4)).view(np.uint16)[:many] & np.uint16((1 << BLOCK_BITS) - 1)
    return (places if n == 1 << BLOCK_BITS else places[places < n]).astype(np.intp)


def _reached(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
    """Place in its level of the node that each row has reached; rows of a leaf go on to the left."""
    at = np.zeros(bins.shape[1], np.uint8)
    for above in range(level):
        right = np.zeros(bins.shape[1], bool)
        for k in np.flatnonzero(feature[1 << above: 2 << above] >= 0).tolist():
            node = (1 << above) + k
            go = bins[feature[node]] > cut[node]
            if above:
                go &= at == k
            right |= go
        at <<= 1
        at |= right.view(np.uint8)
    return at


def _count(plan: Plan, level: int, open_nodes: dict[int, list[int]], subsets: dict[int, np.ndarray]):
    """Sums over the rows of a task: of each open node the (feature, bin, class) counts, or the sum of squares
    and per feature the counts and sums by bin.  Nodes of the last level get the sum of squares alone."""
    features, kinds = len(plan.cuts), len(plan.weights) if plan.weights is not None else 1
    cells = plan.bins * kinds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        keyed_type = np.uint8 if cells <= 256 else np.uint16
        room = np.empty(1 << BLOCK_BITS + 1, np.intp), np.empty(1 << BLOCK_BITS + 1, np.intp), np.empty(1 << BLOCK_BITS + 1, keyed_type)
        for first, block, y in _blocks(batches, features):
            n = len(y)
            keyed = block.astype(keyed_type) * kinds + y.astype(keyed_type) if kinds > 1 else block.astype(keyed_type)
            flat = keyed.ravel()
            for t, nodes in open_nodes.items():
                rows, many = _drawn(plan.seed, first, t, n), len(nodes)
                at, key, found = (r[:len(rows)] for r in room)             # written anew for every feature
                slots = np.full(1 << level, many, np.intp)                 # rows elsewhere go behind the last
                slots[np.array(nodes) - (1 << level)] = np.arange(many)
                slot = slots.take(_reached(block, plan.feature[t], plan.cut[t], level).take(rows))
                base, size = slot * cells, many * cells
                parts = []
                if plan.weights is None:
                    values = y.take(rows)
                    parts.append(np.bincount(slot, values * values, many)[:many, None])
                begins = np.append(subsets[t].T * n, np.zeros((subsets[t].shape[1], 1), np.intp), axis=1)
                for of_slot in begins:
                    np.take(of_slot, slot, out=at, mode="clip")
                    at += rows
                    np.take(flat, at, out=found, mode="clip")
                    np.add(base, found, out=key)
                    parts.append(np.bincount(key, minlength=size)[:size].reshape(many, cells))
                    if plan.weights is None:
                        parts.append(np.bincount(key, values, size)[:size].reshape(many, cells))
                summed = np.concatenate(parts, axis=1, dtype=np.float64)
                sums[t] = sums[t] + summed if t in sums else summed
        for t, found in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([found.tobytes()], pa.binary())], names=["tree", "sums"])

    return run


def _gini(total: np.ndarray) -> np.ndarray:
    """Impurity of class weights, along the last axis."""
    weight = total.sum(-1, keepdims=True)
    share = total / np.where(weight > 0, weight, 1.0)
    return np.where(weight[..., 0] > 0, 1 - (share * share).sum(-1), 0.0)


def _splits(plan: Plan, subset: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every node: feature (-1 without a split), cut, gain, impurity, total, rows, and total and rows of
    both sides."""
    n, width = subset.shape
    if plan.weights is not None:
        weights = np.array(plan.weights)
        counts = sums.reshape(n, width, plan.bins, len(weights))
        left = np.cumsum(counts, axis=2)
        raw_by = counts[:, 0].sum(1)
        right = raw_by[:, None, None] - left
        low, high, raw = left.sum(-1), right.sum(-1), raw_by.sum(-1)
        left, right, total = left * weights, right * weights, raw_by * weights
        impurity, whole = _gini(total), np.maximum(total.sum(-1), 1e-300)[:, None, None]
        gain = impurity[:, None, None] - left.sum(-1) / whole * _gini(left) - right.sum(-1) / whole * _gini(right)
    else:
        pairs = sums[:, 1:].reshape(n, width, 2, plan.bins)
        low, left = np.cumsum(pairs[:, :, 0], axis=2), np.cumsum(pairs[:, :, 1], axis=2)
        raw, whole = pairs[:, 0, 0].sum(-1), pairs[:, 0, 1].sum(-1)
        total, many = np.stack([raw, whole, sums[:, 0]], axis=1), np.maximum(raw, 1.0)
        mean = whole / many
        impurity = sums[:, 0] / many - mean * mean
        high, shift = raw[:, None, None] - low, left - low * mean[:, None, None]
        gain = shift * shift * (1 / np.maximum(low, 1) + 1 / np.maximum(high, 1)) / many[:, None, None]
        left, right = np.stack([low, left], axis=-1), np.stack([high, whole[:, None, None] - left], axis=-1)
    limits = np.array([len(c) for c in plan.cuts])[subset]
    allowed = (np.arange(plan.bins) < limits[..., None]) & (low >= plan.min_leaf) & (high >= plan.min_leaf)
    gain = np.where(allowed, gain, -1.0).reshape(n, -1)
    best, node = np.argmax(gain, axis=1), np.arange(n)
    at, cut = np.divmod(best, plan.bins)
    split = (gain[node, best] > 0) & (impurity >= PURE)
    return (np.where(split, subset[node, at], -1), cut, np.where(split, gain[node, best], -1.0), impurity, total, raw,
            left[node, at, cut], low[node, at, cut], right[node, at, cut], high[node, at, cut])


def _choose(plan: Plan, level: int, open_nodes: dict[int, list[int]], subsets: dict[int, np.ndarray]):
    """The best split of each open node of a tree, from the sums of all tasks."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        nodes = open_nodes[tree]
        sums = np.zeros(1)
        for piece in table.column("sums"):
            sums = sums + np.frombuffer(piece.as_buffer())
        sums = sums.reshape(len(nodes), -1)
        if level == plan.depth:
            none = np.zeros(len(nodes))
            found = (none - 1, none, none, none, sums, none, sums[:, :0], none, sums[:, :0], none)
        else:
            found = _splits(plan, subsets[tree], sums)
        columns = [np.full(len(nodes), tree), np.array(nodes), *found]
        return pa.Table.from_arrays(
            [pa.array(c.tolist(), k) if c.ndim > 1 else pa.array(c).cast(k) for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)

    return run


_NAMES = [c.split()[0] for c in CHOSEN.split(", ")]
_KINDS = [{"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}.get(c.split()[1], pa.list_(pa.float64())) for c in CHOSEN.split(", ")]


def _grown(rows: DataFrame, plan: Plan) -> list[dict[int, dict]]:
    """The nodes of each tree, level by level: a pass over ``rows`` and a sum per tree."""
    trees: list[dict[int, dict]] = [{} for _ in range(plan.trees)]
    open_nodes = {t: [1] for t in range(plan.trees)}
    last = plan.depth if plan.weights is None else plan.depth - 1   # a regression's last leaves lack their squares
    for level in range(last + 1):
        if not open_nodes:
            break
        subsets = plan.subsets(level, open_nodes)
        counted = rows.mapInArrow(_count(plan, level, open_nodes, subsets), "tree int, sums binary")
        chosen = counted.groupBy("tree").applyInArrow(_choose(plan, level, open_nodes, subsets), CHOSEN).toArrow().to_pylist()
        following: dict[int, list[int]] = {}
        for c in sorted(chosen, key=lambda c: (c["tree"], c["node"])):
            nodes = trees[c["tree"]]
            if level == plan.depth:
                known = nodes[c["node"]]
                known["total"] = [*known["total"][:2], *c["total"]]
                continue
            nodes[c["node"]] = c
            if c["feature"] >= 0:
                plan.feature[c["tree"], c["node"]], plan.cut[c["tree"], c["node"]] = c["feature"], c["cut"]
                for node, side in ((2 * c["node"], "lower"), (2 * c["node"] + 1, "upper")):
                    nodes[node] = {"feature": -1, "gain": -1.0, "total": c[side], "raw": c[f"{side}_raw"]}
                    following.setdefault(c["tree"], []).append(node)
        open_nodes = following
    return trees


def _leaf_value(plan: Plan, total: list[float]) -> tuple[float, float]:
    """Prediction and impurity of a node."""
    if plan.weights is None:
        mean = total[1] / total[0] if total[0] else 0.0
        return mean, max(total[2] / total[0] - mean * mean, 0.0) if total[0] else 0.0
    return float(np.argmax(total)), float(_gini(np.array(total)))


def _as_rows(plan: Plan, tree: int, nodes: dict[int, dict]) -> list[tuple]:
    """``nodes`` as MLlib stores a tree: in preorder, leaves of one prediction under one node joined."""
    def join(at: int) -> dict:
        node = nodes[at]
        value, impurity = _leaf_value(plan, node["total"])
        out = node | {"value": value, "impurity": impurity, "sides": ()}
        if node["feature"] >= 0:
            low, high = join(2 * at), join(2 * at + 1)
            if low["sides"] or high["sides"] or low["value"] != high["value"]:
                out["sides"] = (low, high)
        return out

    rows: list[tuple] = []

    def write(node: dict) -> int:
        at = len(rows)
        rows.append(())
        sides = [write(s) for s in node["sides"]] or [-1, -1]
        cut = (node["feature"], [plan.cuts[node["feature"]][node["cut"]]], -1) if node["sides"] else (-1, [], -1)
        rows[at] = (tree, (at, node["value"], node["impurity"], node["total"], node["raw"], node["gain"] if node["sides"] else -1.0, *sides, cut))
        return at

    write(join(1))
    return rows


NODES = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint,
 gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""
FOREST_ONLY = {"numTrees", "bootstrap", "subsamplingRate", "featureSubsetStrategy"}


def _as_model(spark: SparkSession, estimator: Estimator, plan: Plan, trees: list[dict[int, dict]]) -> Model:
    """The MLlib model of these trees, by way of the format that MLlib stores models in."""
    path = work_folder(spark, "forest")
    kind = "classification" if plan.weights is not None else "regression"
    name = "Classification" if plan.weights is not None else "Regression"
    given = {p.name: v for p, v in estimator._paramMap.items()}
    defaults = {p.name: v for p, v in estimator._defaultParamMap.items()}

    def head(what: str, uid: str, left_out: set[str] = frozenset(), **more: int) -> str:
        params = [{k: v for k, v in m.items() if k not in left_out} for m in (given, defaults)]
        return json.dumps({
            "class": f"org.apache.spark.ml.{kind}.{what}{name}Model", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
            "uid": uid, "paramMap": params[0], "defaultParamMap": params[1], **more})

    sizes = {"numFeatures": len(plan.cuts)} | ({"numClasses": len(plan.weights)} if plan.weights is not None else {})
    whole = head("RandomForest", estimator.uid, **sizes, numTrees=plan.trees)
    each = [(t, head("DecisionTree", f"{estimator.uid}_{t}", FOREST_ONLY, **sizes), 1.0) for t in range(plan.trees)]
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [row for t, tree in enumerate(trees) for row in _as_rows(plan, t, tree)]
    spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/data")
    return (RandomForestClassificationModel if plan.weights is not None else RandomForestRegressionModel).load(path)


def fit_forest(estimator: Estimator, rows: DataFrame, parts: DataFrame, weights: dict[float, tuple[float, int]] | None = None) -> Model:
    """The model of an MLlib forest ``estimator``, fitted on the same rows by passes over small stored ones.

    ``parts`` are ``rows`` in even parts; ``weights`` holds (weight, rows) of each class, from 0 on.
    """
    spark = rows.sparkSession
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    if weights is None:
        n, known = (rows.agg(F.count("*").alias("n"), F.count(label).alias("known")).first()[k] for k in ("n", "known"))
    else:
        n = known = sum(many for _, many in weights.values())
    if known < n or not n:
        raise ValueError(f"{label} must be known in all rows, and there must be some")
    by_class = None if weights is None else [weights.get(float(c), (0.0, 0))[0] for c in range(int(max(weights)) + 1)]
    few = rows.sample(min(1.0, SPLIT_SAMPLE / n), estimator.getSeed()) if n > SPLIT_SAMPLE else rows
    seen = few.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).toArrow()
    y = np.asarray(seen["y"].combine_chunks())
    x = np.asarray(seen["x"].combine_chunks().flatten()).reshape(len(y), -1)
    each = np.ones(len(y)) if by_class is None else np.array(by_class).take(y.astype(int))
    most = min(estimator.getMaxBins(), n) - 1
    plan = Plan(
        estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getSeed(),
        [thresholds(x[:, k], each, most) for k in range(x.shape[1])], by_class)
    trees = _grown(stored(_binned(parts, label, features, plan.cuts), "binned"), plan)
    return _as_model(spark, estimator, plan, trees)
