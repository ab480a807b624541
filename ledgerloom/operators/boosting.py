"""Boosted trees from histograms of parts of the rows, which add up.

The trees are grown by the rules of ``pyspark.ml`` (its candidate thresholds, variance, leaves, weights) and come
back as its model. Rows are binned once and stay as small codes while all rounds pass over them: a level of a
tree is one job, in which each part sums its histograms; what reaches the driver depends on features, bins and
depth, not on rows. So few rows that they are one part take one job for all rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterable, Iterator
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import RDD, StorageLevel, inheritable_thread_target
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.trees import (
    Trees, best_splits, checked_rows, empty_trees, packed_blocks, saved_model, thresholds_between,
)
from ledgerloom.sources.io import scratch_path

#: Rows of a part: a set of no more is one part; where there are several, at most.
ROWS_A_PART, MOST_ROWS = 500_000, 4_000_000
#: Rounds after which rows are written, so that their lineage stays short.
ROUNDS_KEPT = 25
#: Parts whose sums reach the driver one by one; more are added up on the way.
FEW_PARTS = 32
#: Features share one code, and so one pass over the rows, while it has no more values than this.
MOST_CODES = 2_048
#: Rows a step, which stay in a core's cache.
CHUNK = 1 << 16


def _thresholds(train: DataFrame, x: str, n: int, bins: int, seed: int) -> list[np.ndarray]:
    """Candidate thresholds of each feature from the rows that ``pyspark.ml`` draws for them, with its seed.

    Every row is in every histogram: only where a feature may be cut follows from these.
    """
    wanted, spark = max(bins * bins, 10_000), train.sparkSession
    rows, share = train.select(x), 1.0
    if n > wanted:
        share, jvm = wanted / n, spark._jvm
        drawn = rows._jdf.javaRDD().sample(False, share, jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
        rows = DataFrame(spark._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), spark)
    values = np.array([r[0] for r in rows.collect()], dtype=float)
    return [_spread(column, share * n, min(bins, n)) for column in values.T]


def _spread(values: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """As in ``pyspark.ml``: rows missing from the ``expected`` number of drawn ones count as zeros."""
    distinct, counts = np.unique(values[values != 0], return_counts=True)
    zeros = expected - counts.sum()
    if zeros > 100 * np.finfo(float).eps * counts.sum():
        at = np.searchsorted(distinct, 0.0)
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts.astype(float), at, zeros)
    return thresholds_between(distinct, counts, expected, bins)


class _Shared:
    """Features as one code: ``tables`` give the bin of each of its ``features`` by code."""

    def __init__(self, codes: np.ndarray, feature: int, bins: int):
        self.codes, self.size, self.features, self.tables = codes, bins, [feature], [np.arange(bins)]

    def joined(self, own: np.ndarray, feature: int, bins: int) -> bool:
        """Takes one more feature in, unless too many of the code's values occur then."""
        met = np.zeros(self.size * bins, dtype=bool)
        for rows in (slice(CHUNK), slice(None)):
            both = self.codes[rows].astype(np.int32) * bins + own[rows]
            met[both] = True
            if np.count_nonzero(met) > MOST_CODES:
                return False
        found = np.flatnonzero(met)
        self.codes = (np.cumsum(met) - 1).astype(np.uint16).take(both)
        self.tables = [t.take(found // bins) for t in self.tables] + [found % bins]
        self.size, self.features = max(len(found), 1), [*self.features, feature]
        return True


#: The splits of one level: whether a node has one, its feature and the last bin that goes left.
Level = tuple[np.ndarray, np.ndarray, np.ndarray]


class _Rows:
    """A part of the rows: their shared codes and what is left of their responses."""

    def __init__(self, blocks: Iterable[tuple[int, bytes, bytes]], cuts: np.ndarray, bins: int):
        blocks = sorted(blocks)  # the order in which they arrive is not fixed
        self.left = np.concatenate([np.zeros(0), *(np.frombuffer(y) for _, _, y in blocks)])
        wide = [np.frombuffer(b, np.uint8).reshape(len(cuts), -1) for _, b, _ in blocks]
        self.n, self.bins, self.count, self.squares = len(self.left), bins, len(cuts), []
        shared: list[_Shared] = []
        for f in range(self.count):
            own = np.concatenate([np.zeros(0, np.uint8), *(b[f] for b in wide)])
            if not any(s.joined(own, f, int(cuts[f]) + 1) for s in shared):
                shared.append(_Shared(own.astype(np.uint16), f, int(cuts[f]) + 1))
        self.flat = np.concatenate([s.codes for s in shared])
        self.sizes = [s.size for s in shared]
        #: Which code a feature is in, and its bin by code.
        self.place = {f: (i, t) for i, s in enumerate(shared) for f, t in zip(s.features, s.tables, strict=True)}

    def _chunks(self, path: list[Level]) -> Iterator[tuple[slice, np.ndarray]]:
        """Some rows and their nodes below the splits of ``path``; from a node without a split all go left."""
        widest, steps = max(self.sizes), []
        for split, feature, cut in path:
            right, start = np.zeros((len(split), widest), np.uint8), np.zeros(len(split), np.intp)
            for k in np.flatnonzero(split):
                i, table = self.place[int(feature[k])]
                start[k] = i * self.n
                right[k, : len(table)] = table > cut[k]
            steps.append((start, right.ravel()))
        for first in range(0, self.n, CHUNK):
            own = slice(first, min(first + CHUNK, self.n))
            every, node = np.arange(own.start, own.stop), np.zeros(own.stop - own.start, np.intp)
            for start, right in steps:
                at = start.take(node)
                at += every
                at = self.flat.take(at) + node * widest
                node *= 2
                node += right.take(at)
            yield own, node

    def sums(self, path: list[Level], counted: bool = True) -> np.ndarray:
        """(count, sum of what is left, sum of squares) by feature, node and bin; the squares by node alone, in bin 0."""
        nodes = 2 ** len(path)
        found = [np.zeros((2, nodes * size)) for size in self.sizes]
        out, first = np.zeros((3, self.count, nodes * self.bins)), np.arange(nodes)[:, None] * self.bins
        for own, node in self._chunks(path):
            left = self.left[own]
            out[2, 0, first.ravel()] += np.bincount(node, left * left, nodes)
            for i, (size, into) in enumerate(zip(self.sizes, found, strict=True)):
                at = node * size
                at += self.flat[i * self.n + own.start : i * self.n + own.stop]
                into[1] += np.bincount(at, left, nodes * size)
                if counted:
                    into[0] += np.bincount(at, minlength=nodes * size)
        for f, (i, table) in self.place.items() if self.n else ():
            at = (first + table).ravel()
            for k in (0, 1) if counted else (1,):
                out[k, f] = np.bincount(at, found[i][k], nodes * self.bins)
        return out.reshape(3, self.count, nodes, self.bins)

    def after(self, path: list[Level], values: np.ndarray, factor: float, times: float) -> _Rows:
        """The same rows with less left: their leaves' values by ``factor`` are taken off."""
        new = object.__new__(_Rows)
        vars(new).update(vars(self), left=np.empty(self.n))
        squares = np.zeros(len(values))
        for own, node in self._chunks(path):
            left = self.left[own]
            squares += np.bincount(node, left * left, len(values))
            new.left[own] = (left - factor * values.take(node)) * times
        new.squares = [*self.squares, squares]
        return new


def _rounds(cuts: np.ndarray, bins: int, rounds: int, rate: float, depth: int) -> Generator[tuple, np.ndarray, Trees]:
    """Grows all trees of a model; asks for ``sums`` and ``after`` of _Rows, over all rows, by name and arguments."""
    trees, counts = empty_trees(rounds, depth), np.zeros((len(cuts), 1, bins))
    for t in range(rounds):
        live, path = np.ones(1, dtype=bool), []
        for level in range(depth):
            found = yield "sums", (path, level > 0 or t == 0)
            if level == 0:
                counts = found[0] if t == 0 else counts
                found[0] = counts
            every = np.tile(np.arange(len(cuts)), (2 ** level, 1))
            feature, cut, gain, left, total = best_splits(found, every, cuts)
            split = live & (gain > 0)
            trees.take(t, level, np.where(split, gain, 0.0), feature, cut, left, np.where(live[:, None], total, 0.0))
            path, live = [*path, (split, feature, cut)], np.repeat(split, 2)
        values, parts = trees.stats[t, :, 1] / np.maximum(trees.stats[t, :, 0], 1.0), trees.split()[t]
        for i in range(1, len(values)):
            if not parts[(i - 1) // 2]:
                values[i] = values[(i - 1) // 2]
        # Rows are left with twice their residual, the slope of the squared loss.
        yield "after", (path, values[2 ** depth - 1 :], *((2.0 * rate, 1.0) if t else (1.0, 2.0)))
    return trees


def _in_one_task(blocks: Iterator, *how) -> Trees:
    held, growing, found = _Rows(((r["number"], r["bins"], r["y"]) for r in blocks), *how[:2]), _rounds(*how), None
    while True:
        try:
            name, asked = growing.send(found)
        except StopIteration as grown:
            return _squared(grown.value, held.squares)
        found = getattr(held, name)(*asked)
        if name == "after":
            held, found = found, None


def _in_parts(rows: RDD, spark: SparkSession, hows: list[tuple]) -> list[Trees]:
    """Models in step, so that a job serves them all; ``rows`` holds parts, each a list of one _Rows a model.

    Each round's rows are made from those of the round before.
    """
    few, growing = rows.getNumPartitions() <= FEW_PARTS, [_rounds(*how) for how in hows]
    held, before, done, found = rows.persist(StorageLevel.MEMORY_AND_DISK), None, 0, [None] * len(hows)

    def each(name: str, asked: list[tuple]) -> RDD:
        return held.map(lambda part: [getattr(r, name)(*how) for r, how in zip(part, asked, strict=True)])

    def added(parts: RDD) -> list:
        add = lambda a, b: [x + y for x, y in zip(a, b, strict=True)]
        return reduce(add, parts.collect()) if few else parts.treeReduce(add)

    try:
        while True:
            try:
                steps = [g.send(f) for g, f in zip(growing, found, strict=True)]
            except StopIteration as grown:
                trees = [grown.value, *(_value(g) for g in growing[1:])]
                squares = added(held.map(lambda part: [np.array(r.squares) for r in part]))
                return [_squared(t, s) for t, s in zip(trees, squares, strict=True)]
            name, asked = steps[0][0], [how for _, how in steps]
            if name == "sums":
                found = added(each(name, asked))
                if before is not None:
                    before.unpersist()
                    before = None
                continue
            before, held, done, found = held, each(name, asked), done + 1, [None] * len(hows)
            if done % ROUNDS_KEPT == 0:
                path = scratch_path(spark, "boosted-rows")
                held.saveAsPickleFile(path, 1)
                held = spark.sparkContext.pickleFile(path)
            held = held.persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for rdd in (held, before):
            if rdd is not None:
                rdd.unpersist()


def _value(growing: Generator) -> Trees:
    """What a generator returns, at its last step."""
    try:
        growing.send(None)
    except StopIteration as grown:
        return grown.value
    raise RuntimeError("models in step have rounds and depth in common")


def _squared(trees: Trees, squares: list[np.ndarray] | np.ndarray) -> Trees:
    """The trees with the sums of squares of their lowest nodes."""
    bottom = trees.stats[:, -len(squares[0]) :]
    bottom[..., 2] = np.where(bottom[..., 0] > 0, np.array(squares), 0.0)
    return trees


def at_once(spark: SparkSession, work: Callable, items: list, threads: int = 4) -> list:
    """``work`` of each item, some at a time: a fit is a chain of jobs too short to fill a cluster."""
    with ThreadPool(threads) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items)


def grow_boosted(trains: list[DataFrame], x: str, boosted: GBTRegressor) -> list[GBTRegressionModel]:
    """Boosted trees of the estimator's rounds, step, depth and bins, a model for each set of rows.

    As in ``pyspark.ml`` the first tree counts whole and later ones by the step; they are fitted to twice
    the residual, the slope of the squared loss. Sets of many rows are fitted in step by the same jobs.
    """
    if not trains:
        return []
    spark, rounds, rate, depth = trains[0].sparkSession, boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth()

    def ready(train: DataFrame) -> tuple:
        n = checked_rows(train, x)
        thresholds = _thresholds(train, x, n, boosted.getMaxBins(), boosted.getSeed())
        cuts = np.array([len(t) for t in thresholds])
        # Drawn rows may give one bin more than asked for.
        return n, train, thresholds, (cuts, int(cuts.max()) + 1, rounds, rate, depth)

    def alone(one: tuple) -> Trees:
        n, train, thresholds, how = one
        return packed_blocks(train, x, thresholds, 1).rdd.mapPartitions(lambda own: [_in_one_task(own, *how)]).collect()[0]

    sets = at_once(spark, ready, trains)
    small, large = ([k for k, one in enumerate(sets) if (one[0] > ROWS_A_PART) == many] for many in (False, True))
    trees = dict(zip(small, at_once(spark, alone, [sets[k] for k in small]), strict=True))
    if large:
        n = sum(sets[k][0] for k in large)
        parts = max(-(-n // MOST_ROWS), min(spark.sparkContext.defaultParallelism, -(-n // ROWS_A_PART)))
        hows = [sets[k][3] for k in large]

        def part(blocks: Iterator) -> list[list[_Rows]]:
            own = [[] for _ in hows]
            for r in blocks:
                own[r["model"]].append((r["number"], r["bins"], r["y"]))
            return [[_Rows(b, *how[:2]) for b, how in zip(own, hows, strict=True)]]

        blocks = reduce(DataFrame.unionAll, (
            packed_blocks(sets[k][1], x, sets[k][2], 4 * parts, 1).withColumn("model", F.lit(i)) for i, k in enumerate(large)
        ))
        grown = _in_parts(blocks.repartition(parts).rdd.mapPartitions(part), spark, hows)
        trees.update(zip(large, grown, strict=True))
    weights = np.append(1.0, np.full(rounds - 1, rate))
    return at_once(
        spark, lambda k: saved_model(spark, boosted, GBTRegressionModel, trees[k], weights, sets[k][2]), list(range(len(sets))))
