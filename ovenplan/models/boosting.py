"""Boosting one tree at a time, from the margin of the trees so far.

Each tree is fitted to what the earlier ones leave: the
first to the label, the others to twice the rest (the negative gradient of the squared
error), scaled by the step size, as ``GBTRegressor`` does. The margin, the sum of the
trees so far, is a column of the training and the stopping rows. So a tree more
costs one tree, errors on the stopping set are known after each, boosting ends as soon
as the patience is met, and any first trees are a model of their own: nothing is
fitted again.

Features do not change from tree to tree: they are cut into bins once, at the thresholds that
Spark ML's trees take, and rows travel as blocks of bin numbers. A level of a tree is one job: tasks
add up count, sum and sum of squares per node and bin, a shuffle by node adds up the tasks, and the best
split of each node goes to the driver. Splits, leaves and their order are those of
``DecisionTreeRegressor`` (variance, all features); a missing value goes right of every other one. The
trees kept become Spark ML models.

With ``l2`` a leaf's value is sum(rest) / (rows + l2) in place of the mean.

The rows are kept by the executors (in memory, the rest on their disks) with the margin of the latest tree.
Every ``checkpoint_interval`` trees they are written to the shared folder with
their margins and the table before is removed: a plan holds that many trees at most, and
a lost executor works out that many again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.session import remove, shared_dir

CHECKPOINT_INTERVAL = 10
#: Rows that thresholds are taken from at least, as in Spark ML: the square of the bins, or these.
SAMPLE_ROWS = 10_000
#: A child this pure is a leaf.
EPSILON = float(np.finfo(float).eps)
BLOCK = "codes binary, label binary, margin binary"


@dataclass
class Ensemble:
    """The first trees of a boosting run; ``leaves``: with l2, each tree's leaf values by leaf id."""

    trees: list[DecisionTreeRegressionModel]
    weights: list[float]
    leaves: list[list[float]] | None

    def first(self, n: int) -> Ensemble:
        return Ensemble(self.trees[:n], self.weights[:n], None if self.leaves is None else self.leaves[:n])

    def model(self) -> GBTRegressionModel:
        """One Spark ML model of these trees, with leaf means as values."""
        cls = SparkSession.active().sparkContext._jvm.org.apache.spark.ml.regression
        trees = JavaWrapper._new_java_array([t._java_obj for t in self.trees], cls.DecisionTreeRegressionModel)
        weights = JavaWrapper._new_java_array(self.weights, SparkSession.active().sparkContext._jvm.double)
        return GBTRegressionModel(cls.GBTRegressionModel(f"boosted_{len(self.trees)}", trees, weights))

    def weighted_leaves(self) -> list[list[float]] | None:
        """Each tree's leaf values times its weight."""
        if self.leaves is None:
            return None
        return [[w * v for v in own] for w, own in zip(self.weights, self.leaves, strict=True)]


def leaf_prediction(weighted_leaves: list[list[float]], leaf_ids: str = "leaves") -> Column:
    """The sum of the values of a row's leaves; ``leaf_ids`` is a vector with a leaf id per tree."""
    # One constant, however many trees.
    values = F.from_json(F.lit(json.dumps(weighted_leaves)), "array<array<double>>")
    own = F.zip_with(values, vector_to_array(leaf_ids), lambda v, leaf: F.get(v, leaf.cast("int")))
    return F.aggregate(own, F.lit(0.0), lambda a, x: a + x)


# ---- bins ----------------------------------------------------------------------------------------


def thresholds_of(values: np.ndarray, counts: np.ndarray, splits: int) -> list[float]:
    """At most ``splits`` thresholds between sorted distinct values: all, or at steps of equal counts; infinity before missing ones."""
    real = ~np.isnan(values)
    missing, values, counts = not real.all(), values[real], counts[real].astype(float)
    between = (values[:-1] + values[1:]) / 2.0
    splits -= missing
    if len(between) <= splits:
        found = between.tolist()
    else:
        found, stride = [], counts.sum() / (splits + 1)
        target, up_to = stride, np.cumsum(counts)
        for i in range(len(between)):
            if abs(up_to[i] - target) < abs(up_to[i + 1] - target):
                found.append(float(between[i]))
                target += stride
    return found + [float("inf")] * (missing and len(values) > 0)


def find_thresholds(rows: DataFrame, max_bins: int, seed: int | None) -> list[list[float]]:
    """The thresholds of each of ``features`` (vector), from all rows or a sample that does not grow with them."""
    n, wanted = rows.count(), max(max_bins**2, SAMPLE_ROWS)
    if not n:
        raise ValueError("no rows to learn from")
    sample = rows.sample(wanted / n, seed) if n > wanted else rows
    splits = min(max_bins, n) - 1

    def cut(values: pd.DataFrame) -> pd.DataFrame:
        values = values.sort_values("value")
        found = thresholds_of(values["value"].to_numpy(float), values["n"].to_numpy(), splits)
        return pd.DataFrame({"feature": [values["feature"].iloc[0]], "found": [found]})

    # At most a sample's rows for each feature.
    values = sample.select(F.posexplode(vector_to_array("features")).alias("feature", "value"))
    # Zero and minus zero are one value, missing ones (NaN) as well.
    found = values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    found = found.groupBy("feature").applyInPandas(cut, "feature int, found array<double>")
    return [r.found for r in sorted(found.collect())]


def coded(rows: DataFrame, thresholds: list[list[float]]) -> DataFrame:
    """Blocks of (features, label): a byte or two per feature and row, the number of thresholds below the value."""
    cuts = [np.array(t) for t in thresholds]
    kind = _code_type(thresholds)

    def task(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                codes = np.array([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], dtype=kind)
                label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
                block = [codes.tobytes(), label.tobytes(), np.zeros(n).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in block], ["codes", "label", "margin"])

    return rows.select(vector_to_array("features").alias("x"), F.col("label").cast("double")).mapInArrow(task, BLOCK)


def _code_type(thresholds: list[list[float]]) -> np.dtype:
    return np.dtype(np.uint8 if max(map(len, thresholds)) < 256 else np.uint16)


# ---- trees ---------------------------------------------------------------------------------------


@dataclass
class Tree:
    """A binary tree; a node's children have the numbers 2i and 2i+1, the root 1. Leaves have no feature (-1)."""

    depth: int
    feature: np.ndarray
    code: np.ndarray
    gain: np.ndarray
    #: Count, sum and sum of squares of each node.
    stats: np.ndarray
    #: What a leaf adds to the margin.
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls(depth, np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros((n, 3)), np.zeros(n))

    def nodes_of(self, codes: np.ndarray) -> np.ndarray:
        """The leaf, or the last node so far, of each row."""
        node, rows = np.ones(codes.shape[1], dtype=np.int64), np.arange(codes.shape[1])
        for _ in range(self.depth):
            feature = self.feature[node]
            node = np.where(feature < 0, node, 2 * node + (codes[feature, rows] > self.code[node]))
        return node

    def leaves(self, node: int = 1) -> Iterator[int]:
        """From left to right."""
        if self.feature[node] < 0:
            yield node
        else:
            yield from self.leaves(2 * node)
            yield from self.leaves(2 * node + 1)

    def mean(self, node: int) -> float:
        n, total, _ = self.stats[node]
        return float(total / n) if n else 0.0

    def prune(self, node: int = 1) -> None:
        """Two leaves of the same mean are one."""
        if self.feature[node] >= 0:
            a, b = 2 * node, 2 * node + 1
            self.prune(a)
            self.prune(b)
            if self.feature[a] < 0 and self.feature[b] < 0 and self.mean(a) == self.mean(b):
                self.feature[node] = -1

    def model(self, number: int, thresholds: list[list[float]]) -> DecisionTreeRegressionModel:
        """The same tree as a Spark ML model, with means as values."""
        jvm, gateway = SparkSession.active().sparkContext._jvm, SparkSession.active().sparkContext._gateway
        tree, variance = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

        def of(node: int):
            array = gateway.new_array(jvm.double, 3)
            for i, v in enumerate(self.stats[node]):
                array[i] = float(v)
            own = variance(array, int(self.stats[node][0]))
            about, feature = (self.mean(node), float(_variance(*self.stats[node]))), int(self.feature[node])
            if feature < 0:
                return tree.LeafNode(*about, own)
            split = tree.ContinuousSplit(feature, thresholds[feature][self.code[node]])
            return tree.InternalNode(*about, float(self.gain[node]), of(2 * node), of(2 * node + 1), split, own)

        cls = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
        return DecisionTreeRegressionModel(cls(f"tree_{number}", of(1), len(thresholds)))


def _variance(n, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (squares - total * total / n) / n)


def node_sums(codes: np.ndarray, node: np.ndarray, target: np.ndarray, nodes: int, bins: np.ndarray) -> np.ndarray:
    """(nodes, 3, all bins): count, sum and sum of squares of the rows of each node and bin; ``bins``: how many each feature has."""
    squares, out = target * target, np.empty((nodes, 3, bins.sum()))
    end = 0
    for own, n in zip(codes, bins.tolist(), strict=True):
        at, end = node * n + own, end + n
        for i, weights in enumerate((None, target, squares)):
            out[:, i, end - n : end] = np.bincount(at, weights, nodes * n).reshape(nodes, n)
    return out


def best_split(sums: np.ndarray, bins: np.ndarray, whole: np.ndarray | None) -> tuple:
    """(gain, feature, code, left sums, right sums) of the best split of a node; ``whole``: the node's sums, if known. Ties: the first."""
    best, end = (0.0, -1, 0, None, None), 0
    for feature, n in enumerate(bins.tolist()):
        up_to, end = np.cumsum(sums[:, end : end + n], axis=1), end + n
        if n == 1:
            continue
        left = up_to[:, :-1]
        right = up_to[:, -1:] - left
        whole = left[:, 0] + right[:, 0] if whole is None else whole
        total = left[0] + right[0]
        gain = _variance(*whole) - left[0] / total * _variance(*left) - right[0] / total * _variance(*right)
        gain[(left[0] < 1) | (right[0] < 1)] = -1.0
        at = int(np.argmax(gain))
        if gain[at] > best[0]:
            best = float(gain[at]), feature, at, left[:, at], right[:, at]
    return *best, sums[:, : bins[0]].sum(axis=1) if whole is None else whole


def grow(state: RDD, depth: int, bins: np.ndarray, first: bool) -> Tree:
    """The tree of the rows' targets; a job per level."""
    tree, open_nodes = Tree.empty(depth), [1]
    while open_nodes:
        place = np.full(2 << depth, -1)
        place[open_nodes] = np.arange(len(open_nodes))
        known = {} if open_nodes == [1] else {i: tree.stats[i] for i in open_nodes}

        def sums(blocks, tree=tree, place=place, nodes=tuple(open_nodes)):
            total = 0.0
            for codes, label, margin in blocks:
                own = place[tree.nodes_of(codes)]
                target = label if first else 2.0 * (label - margin)
                if own.min() < 0:
                    at = np.flatnonzero(own >= 0)
                    codes, own, target = codes[:, at], own[at], target[at]
                total = total + node_sums(codes, own, target, len(nodes), bins)
            return [] if isinstance(total, float) else list(zip(nodes, total, strict=True))

        parts = min(len(open_nodes), state.getNumPartitions())
        added = state.mapPartitions(sums).reduceByKey(np.add, parts)
        found = added.map(lambda x, known=known: (x[0], best_split(x[1], bins, known.get(x[0])))).collect()
        below = []
        for node, (gain, feature, code, left, right, whole) in found:
            if whole is not None:
                tree.stats[node] = whole
            if feature >= 0:
                tree.feature[node], tree.code[node], tree.gain[node] = feature, code, gain
                for child, own in ((2 * node, left), (2 * node + 1, right)):
                    tree.stats[child] = own
                    if 2 * child < 2 << depth and abs(_variance(*own)) >= EPSILON:
                        below.append(child)
        open_nodes = sorted(below)
    tree.prune()
    return tree


# ---- boosting ------------------------------------------------------------------------------------


class _Rows:
    """Blocks of (codes, label, margin) of one set of rows: kept by the executors, and written down now and then."""

    def __init__(self, df: DataFrame, thresholds: list[list[float]], name: str):
        self.spark, self.name, self.path, self.kept = df.sparkSession, name, None, []
        self.features, self.kind = len(thresholds), _code_type(thresholds)
        self._write(coded(df, thresholds))

    def _write(self, table: DataFrame) -> None:
        path, before = shared_dir(self.spark, self.name), self.path
        table.write.parquet(path)
        self._free(0)
        features, kind = self.features, self.kind

        def block(r):
            label = np.frombuffer(r.label)
            return np.frombuffer(r.codes, dtype=kind).reshape(features, len(label)), label, np.frombuffer(r.margin)

        self.path = path
        self._keep(self.spark.read.schema(BLOCK).parquet(path).rdd.map(block))
        if before:
            remove(self.spark, before)

    def _keep(self, blocks: RDD) -> None:
        self.blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        # The one before is read once more, to fill this one.
        self.kept.append(self.blocks)
        self._free(2)

    def _free(self, but: int) -> None:
        while len(self.kept) > but:
            self.kept.pop(0).unpersist()

    def write(self) -> None:
        rows = self.blocks.map(lambda b: tuple(bytearray(np.ascontiguousarray(v).tobytes()) for v in b))
        self._write(self.spark.createDataFrame(rows, BLOCK))

    def add(self, tree: Tree) -> None:
        self._keep(self.blocks.map(lambda b: (b[0], b[1], b[2] + tree.value[tree.nodes_of(b[0])])))

    def error(self) -> float:
        n, total = self.blocks.map(lambda b: (len(b[1]), float(np.abs(b[1] - b[2]).sum()))).fold(
            (0, 0.0), lambda a, b: (a[0] + b[0], a[1] + b[1])
        )
        return total / n if n else None

    def end(self) -> None:
        self._free(0)
        remove(self.spark, self.path)


def boost(
    train: DataFrame,
    stop: DataFrame | None,
    max_iter: int,
    patience: int,
    best: Callable[[list[float], int], int],
    l2: float = 0.0,
    step_size: float = 0.05,
    checkpoint_interval: int = CHECKPOINT_INTERVAL,
    maxDepth: int = 5,
    maxBins: int = 32,
    seed: int | None = None,
) -> tuple[Ensemble, list[float]]:
    """(the best first trees, mean absolute error on ``stop`` after each tree built).

    ``train`` and ``stop`` have ``features`` and ``label``. ``best`` gives the number of
    trees to keep of a list of errors; at most ``patience`` trees are built beyond it.
    Without ``stop`` all ``max_iter`` trees are built and kept.
    """
    thresholds = find_thresholds(train, maxBins, seed)
    bins = np.array([len(t) + 1 for t in thresholds])
    rows, held = _Rows(train, thresholds, "margins"), None if stop is None else _Rows(stop, thresholds, "stop-margins")
    trees, errors = [], []
    while len(trees) < max_iter:
        tree, weight = grow(rows.blocks, maxDepth, bins, not trees), step_size if trees else 1.0
        for leaf in tree.leaves():
            tree.value[leaf] = weight * (tree.stats[leaf][1] / (tree.stats[leaf][0] + l2) if l2 else tree.mean(leaf))
        trees.append((tree, weight))
        for r in (rows, held) if held else (rows,):
            r.add(tree)
            if len(trees) % checkpoint_interval == 0:
                r.write()
        if held:
            errors.append(held.error())
            if len(errors) - best(errors, patience) >= patience:
                break
    for r in (rows, held) if held else (rows,):
        r.end()
    trees = trees[: best(errors, patience)] if held else trees
    leaves = [[float(t.stats[i][1] / (t.stats[i][0] + l2)) for i in t.leaves()] for t, _ in trees] if l2 else None
    return Ensemble([t.model(i, thresholds) for i, (t, _) in enumerate(trees)], [w for _, w in trees], leaves), errors
