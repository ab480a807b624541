"""Forests from histograms of blocks of rows, which add up.

The trees are grown by the rules of ``pyspark.ml`` (32 bins, variance, its leaves and candidate thresholds)
and come back as its model. A level of all trees is one pass: each block sums count, response and its
square per node, feature and bin, the sums of a tree meet in a shuffle and its best splits are found there.
Only splits reach the driver. A block is a few columns of bytes and not an object a row.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.io import scratch_path

#: Rows a block, which stay in a core's cache while all trees pass over them.
BLOCK_ROWS = 20_000
#: Rows of a bootstrap sample by 16 random bits: the counts of Poisson's law with mean 1, to a 65,536th.
_DRAWN = np.repeat(np.arange(9), np.diff(np.rint(
    65536 * np.append(np.cumsum(np.append(0.0, np.exp(-1) / np.cumprod(np.maximum(np.arange(8), 1)))), 1.0)
).astype(int))).astype(np.uint8)
#: The least draw that takes a row at all.
_NEVER = int(np.count_nonzero(_DRAWN == 0))
_NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
    "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


# --- rows to blocks -------------------------------------------------------------------------------

def thresholds_between(distinct: np.ndarray, counts: np.ndarray, rows: float, bins: int) -> np.ndarray:
    """Between all distinct values where they are few, else where as many rows lie between them."""
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) < bins:
        return middles
    stride = rows / bins
    found, target = [], stride
    below = np.cumsum(counts)
    for i in range(1, len(distinct)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _candidates(train: DataFrame, x: str, n: int, bins: int, seed: int) -> list[np.ndarray]:
    """Candidate thresholds of each feature, from as many rows as ``pyspark.ml`` looks at for them.

    Every row is in every histogram: only where a feature may be cut follows from these.
    """
    wanted = max(bins * bins, 10_000)
    rows = train.select(x) if n <= wanted else train.select(x).sample(False, wanted / n, seed)
    values = np.array([r[0] for r in rows.collect()], dtype=float)
    return [
        thresholds_between(*np.unique(column, return_counts=True), len(column), min(bins, n)) for column in values.T
    ]


def packed_blocks(
    train: DataFrame, x: str, thresholds: list[np.ndarray], partitions: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(number, bins of features by rows, responses) of some rows each, as bytes; a number is a block's own."""
    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        kept, rows = [], 0

        def block() -> pa.RecordBatch:
            bins = np.concatenate([b for b, _ in kept], axis=1).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([bins], pa.binary()),
                 pa.array([np.concatenate([y for _, y in kept]).tobytes()], pa.binary())],
                ["number", "bins", "y"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            wide = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            kept.append((np.stack([np.searchsorted(t, v).astype(np.uint8) for t, v in zip(thresholds, wide.T, strict=True)]), y))
            rows += len(y)
            if rows >= block_rows:
                yield block()
                kept, rows, number = [], 0, number + 1
        if kept:
            yield block()

    return train.select(F.col("y").cast("double"), x).coalesce(partitions).mapInArrow(
        binned, "number long, bins binary, y binary")


def _blocks(train: DataFrame, x: str, thresholds: list[np.ndarray], partitions: int) -> RDD:
    """The blocks as arrays."""
    width = len(thresholds)
    return packed_blocks(train, x, thresholds, partitions).rdd.map(lambda r: (
        r["number"], np.frombuffer(r["bins"], np.uint8).reshape(width, -1), np.frombuffer(r["y"])))


# --- growing --------------------------------------------------------------------------------------

@dataclass
class Trees:
    """Trees by heap number: node i has children 2i+1 and 2i+2; ``child`` of a leaf is the leaf.

    ``stats`` are count, sum and sum of squares of a node's responses.
    """

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    def split(self) -> np.ndarray:
        return self.child[:, ::2] != np.arange(self.feature.shape[1])

    def values(self) -> np.ndarray:
        return self.stats[..., 1] / np.maximum(self.stats[..., 0], 1.0)

    def take(self, t: int, level: int, gain: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, total: np.ndarray):
        """The best splits of a level of tree ``t``, where their gain is above 0, and the statistics of its nodes met."""
        first = 2 ** level - 1
        own = slice(first, first + 2 ** level)
        self.stats[t, own] = np.where(total[:, :1] > 0, total, self.stats[t, own])
        for k in np.flatnonzero(gain > 0):
            i = first + k
            self.feature[t, i], self.cut[t, i], self.gain[t, i] = feature[k], cut[k], gain[k]
            self.child[t, 2 * i : 2 * i + 2] = 2 * i + 1, 2 * i + 2
            self.stats[t, 2 * i + 1], self.stats[t, 2 * i + 2] = left[k], total[k] - left[k]


def empty_trees(count: int, depth: int) -> Trees:
    heap = 2 ** (depth + 1) - 1
    return Trees(
        np.zeros((count, heap), np.int64), np.zeros((count, heap), np.int64),
        np.tile(np.repeat(np.arange(heap), 2), (count, 1)), np.zeros((count, heap)), np.zeros((count, heap, 3)),
    )


class _Room:
    """Arrays used again for each tree and feature of a block: making them anew costs more than filling them."""

    def __init__(self, rows: int):
        self.at, self.node, self.other = (np.empty(rows, np.int64) for _ in range(3))
        self.bin, self.cut, self.right = np.empty(rows, np.uint8), np.empty(rows, np.uint8), np.empty(rows, bool)

    def bins(self, flat: np.ndarray, start: np.ndarray, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The bin of each row in its node's feature, which begins at ``start`` in ``flat``."""
        at = np.take(start, node, out=self.at[: len(rows)], mode="clip")
        at += rows
        return np.take(flat, at, out=self.bin[: len(rows)], mode="clip")

    def walked(self, binned: np.ndarray, rows: np.ndarray, trees: Trees, t: int, levels: int) -> np.ndarray:
        """The node of each row after some levels."""
        m, flat = len(rows), binned.ravel()
        node, other = self.node[:m], self.other[:m]
        node[:] = 0
        start, cut, child = trees.feature[t] * binned.shape[1], trees.cut[t].astype(np.uint8), trees.child[t]
        for _ in range(levels):
            found = self.bins(flat, start, node, rows)
            right = np.greater(found, np.take(cut, node, out=self.cut[:m], mode="clip"), out=self.right[:m])
            node *= 2
            node += right
            node, other = np.take(child, node, out=other, mode="clip"), node
        return node


def _sums(blocks: Iterator[tuple], trees: Trees, level: int, subsets: np.ndarray, wanted: np.ndarray, bins: int,
          seed: int | None, squares: bool) -> Iterator[tuple]:
    """(tree, sums by statistic, feature, node and bin) of a partition, over the ``wanted`` nodes of each tree.

    Without ``squares`` they are summed for the first feature only, which gives the nodes' own. With a
    ``seed``, a tree takes each row as often as a draw for tree and block says.
    """
    first, nodes = 2 ** level - 1, 2 ** level
    slots = subsets.shape[2]
    sums: dict[int, np.ndarray] = {}
    for number, binned, y in blocks:
        n, flat, room, square = len(y), binned.ravel(), _Room(len(y)), y * y
        every = np.arange(n)
        for t in np.flatnonzero(wanted.any(axis=1)).tolist():
            rows, weight = every, None
            if seed is not None:
                drawn = np.random.default_rng((seed, t, number)).integers(0, 2**64, n // 4 + 1, np.uint64).view(np.uint16)[:n]
                rows = np.flatnonzero(drawn >= _NEVER)
                weight = _DRAWN.take(drawn.take(rows)).astype(float)
            node = room.walked(binned, rows, trees, t, level)
            if not wanted[t].all():
                there = np.zeros(trees.feature.shape[1], dtype=bool)
                there[first : first + nodes] = wanted[t]
                live = np.flatnonzero(there.take(node))
                rows, node = rows.take(live), node.take(live)
                weight = None if weight is None else weight.take(live)
            base = (node - first) * bins
            whole = len(rows) == n
            stats = (y, square) if whole else (y.take(rows), square.take(rows))
            if weight is not None:
                stats = stats[0] * weight, stats[1] * weight
            stats = weight, *stats
            found = sums.setdefault(t, np.zeros((3, slots, nodes * bins)))
            alike = (subsets[t] == subsets[t, 0]).all()
            if not alike:
                node = node - first
            for j in range(slots):
                if alike:
                    own = binned[subsets[t, 0, j]]
                    own = own if whole else np.take(own, rows, out=room.bin[: len(rows)], mode="clip")
                else:
                    own = room.bins(flat, subsets[t, :, j] * n, node, rows)
                at = np.add(base, own, out=room.at[: len(rows)])
                for k, by in enumerate(stats if squares or j == 0 else stats[:2]):
                    found[k, j] += np.bincount(at, by, nodes * bins)
    return iter([(t, found.reshape(3, slots, nodes, bins)) for t, found in sums.items()])


def _impurity(stats: np.ndarray) -> np.ndarray:
    count = np.maximum(stats[0], 1.0)
    return (stats[2] - stats[1] * stats[1] / count) / count


def best_splits(sums: np.ndarray, subset: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature, bin, gain and statistics, left and all, of each node's best split; a gain of 0 is none."""
    left = sums.cumsum(axis=3)
    total = left[:, 0, :, -1]
    nodes, bins = sums.shape[2:]
    count, response = total[0][:, None], total[1][:, None]
    other = count - left[0]
    valid = (left[0] >= 1) & (other >= 1) & (np.arange(bins) < cuts[subset].T[..., None])
    valid &= (np.abs(_impurity(total)) >= np.finfo(float).eps)[:, None]
    # What the variance loses, without the squares, which cancel.
    parts = left[1] ** 2 / np.maximum(left[0], 1.0) + (response - left[1]) ** 2 / np.maximum(other, 1.0)
    gain = (parts - response**2 / np.maximum(count, 1.0)) / np.maximum(count, 1.0)
    flat = np.where(valid, gain, 0.0).transpose(1, 0, 2).reshape(nodes, -1)
    best = flat.argmax(axis=1)
    slot, cut = np.divmod(best, bins)
    node = np.arange(nodes)
    return subset[node, slot], cut, flat[node, best], left[:, slot, node, cut].T, total.T


def _grown(blocks: RDD, count: int, depth: int, slots: int, thresholds: list[np.ndarray], bins: int,
           rng: np.random.Generator, seed: int) -> Trees:
    """``count`` trees over the blocks, all of a level in one pass; a node sees ``slots`` features."""
    cuts, trees = np.array([len(t) for t in thresholds]), empty_trees(count, depth)
    for level in range(depth):
        first, nodes = 2 ** level - 1, 2 ** level
        every = np.tile(np.arange(len(cuts)), (count, nodes, 1))
        subsets = every if slots == len(cuts) else np.sort(rng.permuted(every, axis=2)[..., :slots], axis=2)
        wanted = np.ones((count, 1), dtype=bool)
        if level:
            wanted = np.repeat(trees.split()[:, (first - 1) // 2 : first], 2, axis=1)
        if not wanted.any():
            break
        sums = blocks.mapPartitions(lambda own: _sums(own, trees, level, subsets, wanted, bins, seed, level == depth - 1))
        found = sums.reduceByKey(np.add, min(count, blocks.context.defaultParallelism)).map(
            lambda tree: (tree[0], best_splits(tree[1], subsets[tree[0]], cuts))).collect()
        for t, (feature, cut, gain, left, total) in found:
            trees.take(t, level, gain, feature, cut, left, total)
    return trees


# --- forests -------------------------------------------------------------------------------------

def checked_rows(train: DataFrame, x: str) -> int:
    """The number of rows; unusable rows, or none, are an error, as in ``pyspark.ml``."""
    odd = F.col("y").isNull() | F.isnan("y") | F.col(x).isNull() | F.exists(
        x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    n, bad = train.agg(F.count(F.lit(1)), F.count_if(odd)).first()
    if n == 0 or bad:
        raise ValueError(f"{bad} of {n} rows to train on have no finite response or features" if n else "no rows to train on")
    return n


def _ready(train: DataFrame, x: str, bins: int, seed: int, rows_per_task: int) -> tuple[list[np.ndarray], RDD]:
    """Candidate thresholds and blocks of the rows."""
    n = checked_rows(train, x)
    thresholds = _candidates(train, x, n, bins, seed)
    most = 4 * train.sparkSession.sparkContext.defaultParallelism
    return thresholds, _blocks(train, x, thresholds, max(1, min(most, -(-n // rows_per_task))))


def grow_forest(train: DataFrame, x: str, forest: RandomForestRegressor) -> RandomForestRegressionModel:
    """The forest of the estimator's number of trees, depth, bins and seed, a third of the features a node."""
    seed, bins, count = forest.getSeed(), forest.getMaxBins(), forest.getNumTrees()
    thresholds, blocks = _ready(train, x, bins, seed, 25_000)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    slots = len(thresholds) if count == 1 else -(-len(thresholds) // 3)
    try:
        trees = _grown(blocks, count, forest.getMaxDepth(), slots, thresholds, bins, np.random.default_rng(seed), seed)
    finally:
        blocks.unpersist()
    return saved_model(train.sparkSession, forest, RandomForestRegressionModel, trees, np.ones(count), thresholds)


def saved_model(spark: SparkSession, estimator, kind: type, trees: Trees, weights: np.ndarray, thresholds: list[np.ndarray]):
    """The fitted ``pyspark.ml`` model, by its own reader, from a folder in the format of its writer."""
    path = scratch_path(spark, "ensemble")
    count = len(trees.feature)
    params = {p.name: v for p, v in estimator.extractParamMap().items()}
    single = {p.name for p in DecisionTreeRegressor().params}

    def metadata(name: str, uid: str, held: dict, **more) -> str:
        return json.dumps({
            "class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version, "uid": uid, "paramMap": held, "defaultParamMap": {}, **more,
        })

    about = metadata(kind.__name__, estimator.uid, params, numFeatures=len(thresholds), numTrees=count)
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    own = {k: v for k, v in params.items() if k in single}
    about = [(t, metadata("DecisionTreeRegressionModel", f"{estimator.uid}_{t}", own), float(weights[t])) for t in range(count)]
    spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(t, node) for t in range(count) for node in _numbered(trees, t, thresholds)]
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.parquet(f"{path}/data")
    return kind.load(path)


def _numbered(trees: Trees, t: int, thresholds: list[np.ndarray]) -> list[tuple]:
    """The nodes of a tree as its writer has them: numbered from the root, left side first."""
    split, values, impurity = trees.split()[t], trees.values()[t], _impurity(trees.stats[t].T)
    out: list[tuple | None] = []

    def add(i: int) -> int:
        number = len(out)
        out.append(None)
        left, right, gain, cut = -1, -1, -1.0, (-1, [], -1)
        if split[i]:
            feature = int(trees.feature[t, i])
            gain, cut = float(trees.gain[t, i]), (feature, [float(thresholds[feature][trees.cut[t, i]])], -1)
            left, right = add(2 * i + 1), add(2 * i + 2)
        stats = [float(v) for v in trees.stats[t, i]]
        out[number] = (number, float(values[i]), float(impurity[i]), stats, int(stats[0]), gain, left, right, cut)
        return number

    add(0)
    return out
