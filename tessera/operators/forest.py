"""Random forest over sparse rows: IMB7.

Spark's own forest makes each row an array of one number per column, and keeps
those arrays for all levels: at 65,536 hashed columns a quarter of a megabyte for
a text of a few hundred words. Here a row stays the list of its non-zero columns.

Trees grow level by level, one pass over the rows each. A pass counts the weight
of each class per (node, candidate column, bin) over the entries that rows do
have; what a column's zeros weigh is the node's total less that. Candidates,
split points, gain, stopping, pruning and votes are those of Spark's classifier;
the draws are not, since rows are drawn by a hash of their key and columns by the
node, so that a forest does not depend on how its table is stored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.common import cut

# Rows that are looked at together, and counts that a task holds before it adds up equal keys.
ROWS = 1000
HELD = 1 << 20


def _entries(features: str) -> tuple[Column, Column]:
    """Columns and values of a vector's entries, in column order."""
    v = F.unwrap_udt(F.col(features))
    every = F.sequence(F.lit(0), F.size(v["values"]) - 1)
    at = F.when(v["type"] == 0, v["indices"]).when(F.size(v["values"]) > 0, every)
    return F.coalesce(at, F.array().cast("array<int>")), v["values"]


def split_points(values, weights, total: float, bins: int) -> list[float]:
    """Split points of a column with these distinct non-zero ``values``, of
    ``weights``; what is left of ``total`` is zero. Between all neighbours, or
    where the cumulative weight comes nearest to equal shares."""
    order = np.argsort(values)
    values, weights = np.asarray(values, float)[order], np.asarray(weights, float)[order]
    zeros = total - weights.sum()
    if zeros > 1e-9 * total:
        at = int(np.searchsorted(values, 0.0))
        values, weights = np.insert(values, at, 0.0), np.insert(weights, at, zeros)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle.tolist()
    upto, share = np.cumsum(weights), total / bins
    target, points = share, []
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            points.append(float(middle[i - 1]))
            target += share
    return points


class Points(NamedTuple):
    """Split points of all columns, one after the other: those of a column
    begin at ``first``, ``number`` of them; ``zero`` is the bin of its zeros."""
    flat: np.ndarray
    first: np.ndarray
    number: np.ndarray
    zero: np.ndarray

    def bins(self, column: np.ndarray, value: np.ndarray) -> np.ndarray:
        """A value's bin: how many of its column's split points lie below it."""
        out, at, k = np.zeros(len(column), np.int32), np.arange(len(column)), 0
        while len(at := at[self.number[column[at]] > k]):
            out[at] += value[at] > self.flat[self.first[column[at]] + k]
            k += 1
        return out


def points_of(rows: list, width: int) -> Points:
    by = {r["column"]: r["points"] for r in rows}
    number = np.zeros(width, np.int32)
    number[list(by)] = [len(p) for p in by.values()]
    zero = np.zeros(width, np.int32)
    zero[list(by)] = [sum(x < 0 for x in p) for p in by.values()]
    flat = np.array([x for c in sorted(by) for x in by[c]], float)
    return Points(flat, np.cumsum(number) - number, number, zero)


class Rows(NamedTuple):
    """Some rows: entry ``i`` is in row ``row[i]``, ``column[i]`` and ``bin[i]``."""
    n: int
    row: np.ndarray
    column: np.ndarray
    bin: np.ndarray

    def descend(self, column: np.ndarray, split: np.ndarray, depth: int, points: Points) -> np.ndarray:
        """The node of each row in a tree after ``depth`` steps: its root is
        node 1, and the children of node i are 2 i and 2 i + 1."""
        node, width = np.ones(self.n, np.int64), len(points.number)
        key = np.append(self.row.astype(np.int64) * width + self.column, np.int64(self.n) * width)
        for _ in range(depth):
            c = column[node]
            want = np.arange(self.n) * width + np.maximum(c, 0)
            at = np.searchsorted(key, want)
            has = key[at] == want
            b = points.zero[np.maximum(c, 0)]
            b[has] = self.bin[at[has]]
            node = np.where(c < 0, node, 2 * node + (b > split[node]))
        return node


def draws(key: np.ndarray, tree: int, mean: float) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson, by a hash of its key."""
    x = key.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for by in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(by)
    u = (x ^ (x >> np.uint64(31))) / np.float64(2 ** 64)
    p = np.array([math.exp(i * math.log(mean) - mean - math.lgamma(i + 1)) for i in range(64)])
    return np.searchsorted(np.cumsum(p), u, "right")


def impurity(w: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy of class weights (last axis); 0 without weight."""
    total = w.sum(-1, keepdims=True)
    p = np.divide(w, total, out=np.zeros_like(w), where=total > 0)
    if kind == "gini":
        return np.where(total[..., 0] > 0, 1 - (p * p).sum(-1), 0.0)
    return -(p * np.log2(p, out=np.zeros_like(p), where=p > 0)).sum(-1)


class Tree:
    """Per node its split (column -1: a leaf) and its class weights."""

    def __init__(self, depth: int, classes: int):
        self.column = np.full(2 << depth, -1, np.int64)
        self.split = np.zeros(2 << depth, np.int64)
        self.weight = np.zeros((2 << depth, classes))

    @property
    def depth(self) -> int:
        inner = np.flatnonzero(self.column >= 0)
        return int(inner.max()).bit_length() if len(inner) else 0

    def prune(self) -> None:
        """A split whose children are leaves of one prediction is a leaf."""
        for i in np.flatnonzero(self.column >= 0)[::-1]:
            kids = [2 * i, 2 * i + 1]
            if (self.column[kids] < 0).all() and len(set(self.weight[kids].argmax(1))) == 1:
                self.column[i] = -1


class SparseForestModel(Model):
    """Adds ``rawPrediction``, ``probability`` and ``prediction``."""

    def __init__(self, trees: list[Tree], points: Points, features: str):
        super().__init__()
        self.trees, self._points, self._features = trees, points, features

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        trees, points = self.trees, self._points

        @F.pandas_udf("array<double>")
        def votes(columns: pd.Series, values: pd.Series) -> pd.Series:
            out = []
            for i in range(0, len(columns), ROWS):
                c, v = columns.iloc[i:i + ROWS], values.iloc[i:i + ROWS]
                n = len(c)
                row = np.repeat(np.arange(n), [len(x) for x in c])
                column, value = np.concatenate(c.to_list()), np.concatenate(v.to_list())
                part = Rows(n, row, column, points.bins(column, value))
                raw = np.zeros((n, trees[0].weight.shape[1]))
                for t in trees:
                    w = t.weight[part.descend(t.column, t.split, t.depth, points)]
                    total = w.sum(1, keepdims=True)
                    raw += np.divide(w, total, out=np.zeros_like(w), where=total > 0)
                out += raw.tolist()
            return pd.Series(out, dtype=object)

        columns, values = _entries(self._features)
        out = df.withColumn("_raw", votes(columns, values))
        total = F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x)
        share = F.transform("_raw", lambda x: F.when(F.col("_total") > 0, x / F.col("_total")).otherwise(x))
        out = out.withColumn("_total", total).withColumn("rawPrediction", array_to_vector("_raw"))
        out = out.withColumn("probability", array_to_vector(share))
        best = F.array_position("_raw", F.array_max("_raw")) - 1
        return out.withColumn("prediction", best.cast("double")).drop("_raw", "_total")


class SparseForest(Estimator):
    """Parameters as in Spark's ``RandomForestClassifier``. ``keyCol``: the
    column by which rows are drawn, the same draws for equal keys; without one
    they are drawn by their place in the table. The model scores like any other
    stage; a model that has to be saved is ``classifier('rf_dense')``'s."""

    def __init__(self, labelCol="label", featuresCol="features", seed=42, numTrees=20, maxDepth=5, maxBins=32,
                 minInstancesPerNode=1, minInfoGain=0.0, impurity="gini", subsamplingRate=1.0, bootstrap=True,
                 featureSubsetStrategy="auto", keyCol=None):
        super().__init__()
        if impurity not in ("gini", "entropy") or featureSubsetStrategy not in ("auto", "all", "sqrt"):
            raise ValueError("impurity is gini or entropy, featureSubsetStrategy auto, all or sqrt")
        self.label, self.features, self.seed, self.n_trees, self.depth = labelCol, featuresCol, seed, numTrees, maxDepth
        self.n_bins, self.least, self.min_gain, self.impurity = maxBins, minInstancesPerNode, minInfoGain, impurity
        self.rate, self.bootstrap, self.key, self.weight = subsamplingRate, bootstrap, keyCol, None
        self.every_column = featureSubsetStrategy == "all" or (featureSubsetStrategy == "auto" and numTrees == 1)

    def setWeightCol(self, value: str) -> SparseForest:
        self.weight = value
        return self

    def _fit(self, df: DataFrame) -> SparseForestModel:
        rows = self._read(df)
        size = rows.agg(F.max("label").alias("last"), F.sum("weight").alias("total"), F.max("width").alias("width")).first()
        if size["last"] is None:
            raise ValueError("a forest needs a row to be fitted on")
        classes = int(size["last"]) + 1
        points = self._points(rows, size["total"], size["width"])
        rows = self._binned(rows, points)
        trees = [Tree(self.depth, classes) for _ in range(self.n_trees)]
        open_ = [(t, 1) for t in range(self.n_trees)]
        for level in range(self.depth + 1):
            if open_:
                open_ = self._grow(rows, trees, points, open_, level)
        for t in trees:
            t.prune()
        return SparseForestModel(trees, points, self.features)

    def _read(self, df: DataFrame) -> DataFrame:
        columns, values = _entries(self.features)
        v = F.unwrap_udt(F.col(self.features))
        key = F.monotonically_increasing_id() if self.key is None else F.col(self.key)
        rows = df.select(F.xxhash64(F.lit(self.seed), key).alias("key"), F.col(self.label).cast("int").alias("label"),
                         (F.lit(1.0) if self.weight is None else F.col(self.weight).cast("double")).alias("weight"),
                         F.coalesce(v["size"], F.size(v["values"])).alias("width"),
                         columns.alias("columns"), values.alias("values"))
        return cut(rows, "forest-rows")

    def _points(self, rows: DataFrame, total: float, width: int) -> Points:
        """All rows count, by distinct values of a column. The driver holds
        fewer than ``maxBins`` numbers a column."""
        n_bins = self.n_bins

        def points(batches):
            for pdf in batches:
                yield pd.DataFrame({"column": pdf["column"], "points": [
                    split_points(v, w, total, n_bins) for v, w in zip(pdf["v"], pdf["w"])]})

        entry = rows.select("weight", F.explode(F.arrays_zip("columns", "values")).alias("e"))
        entry = entry.select("weight", F.col("e.columns").alias("column"), F.col("e.values").alias("v")).filter("v <> 0")
        by = entry.groupBy("column", "v").agg(F.sum("weight").alias("w")).groupBy("column").agg(
            F.sort_array(F.collect_list(F.struct("v", "w"))).alias("e"))
        by = by.select("column", F.col("e.v").alias("v"), F.col("e.w").alias("w"))
        return points_of(by.mapInPandas(points, "column int, points array<double>").filter("size(points) > 0").collect(), width)

    def _binned(self, rows: DataFrame, points: Points) -> DataFrame:
        """Entries of columns that can be split, as bins; they are written once
        and read again for each level."""
        def run(batches):
            for b in batches:
                columns = b.column("columns")
                ends = np.concatenate([[0], np.cumsum(columns.value_lengths().to_numpy(zero_copy_only=False))])
                column = columns.flatten().to_numpy(zero_copy_only=False)
                value = b.column("values").flatten().to_numpy(zero_copy_only=False)
                keep = (points.number[column] > 0) & (value != 0)
                ends = np.concatenate([[0], np.cumsum(keep)])[ends].astype(np.int32)
                column, value = column[keep], value[keep]
                out = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32)))
                       for x in (column, points.bins(column, value))]
                yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label"), b.column("weight"), *out],
                                                 ["key", "label", "weight", "columns", "bins"])

        return cut(rows.drop("width").mapInArrow(run, "key long, label int, weight double, columns array<int>, bins array<int>"),
                   "forest-bins")

    def _grow(self, rows: DataFrame, trees: list[Tree], points: Points, open_: list, level: int) -> list:
        """Counts the open nodes' rows and splits them; the nodes that are open
        then. Past the last level only class weights are counted."""
        width, classes, n_bins = len(points.number), trees[0].weight.shape[1], self.n_bins
        n_columns = 0 if level == self.depth else width if self.every_column else math.ceil(math.sqrt(width))
        candidates = [np.sort(np.random.default_rng([self.seed, t, i]).choice(width, n_columns, replace=False))
                      if n_columns < width else np.arange(width) for t, i in open_]
        mean, least, min_gain, kind = self.rate if self.bootstrap else None, self.least, self.min_gain, self.impurity
        of_tree = {t: [k for k, (u, _) in enumerate(open_) if u == t] for t in {t for t, _ in open_}}
        shape = (len(open_), n_columns + 1, n_bins, classes)  # the last column holds a node's totals

        def count(batches):
            held, n_held = [], 0
            lookup = {}
            for t, nodes in of_tree.items():
                place = np.full(2 << level, -1, np.int64)
                place[[open_[k][1] for k in nodes]] = nodes
                pairs = np.concatenate([k * width + candidates[k] for k in nodes]).astype(np.int64)
                slots = np.concatenate([np.arange(n_columns) for _ in nodes])
                wanted = np.zeros(width, bool)
                wanted[pairs % width] = True
                lookup[t] = place, np.append(pairs, len(open_) * width), slots, wanted

            def added():
                key, w, n = (np.concatenate(x) for x in zip(*held))
                key, at = np.unique(key, return_inverse=True)
                return key, np.bincount(at, w, len(key)), np.bincount(at, n, len(key)).astype(np.int64)

            for batch in batches:
                for i in range(0, batch.num_rows, ROWS):
                    b = batch.slice(i, ROWS)
                    c = b.column("columns")
                    row = np.repeat(np.arange(b.num_rows), c.value_lengths().to_numpy(zero_copy_only=False))
                    part = Rows(b.num_rows, row, c.flatten().to_numpy(zero_copy_only=False),
                                b.column("bins").flatten().to_numpy(zero_copy_only=False))
                    key, label, weight = (b.column(x).to_numpy(zero_copy_only=False) for x in ("key", "label", "weight"))
                    for t, (place, pairs, slots, wanted) in lookup.items():
                        node = place[part.descend(trees[t].column, trees[t].split, level, points)]
                        n = np.ones(part.n, np.int64) if mean is None else draws(key, t, mean)
                        node[n == 0] = -1
                        r = np.flatnonzero(node >= 0)
                        held.append((np.ravel_multi_index((node[r], np.full(len(r), n_columns), 0 * r, label[r]), shape),
                                     weight[r] * n[r], n[r]))
                        e = np.flatnonzero(wanted[part.column])
                        e = e[node[part.row[e]] >= 0]
                        pair = node[part.row[e]] * width + part.column[e]
                        at = np.searchsorted(pairs, pair)
                        ok = pairs[at] == pair
                        e, r, s = e[ok], part.row[e[ok]], slots[at[ok]]
                        held.append((np.ravel_multi_index((node[r], s, part.bin[e], label[r]), shape), weight[r] * n[r], n[r]))
                        n_held += len(e) + part.n
                    if n_held > HELD:
                        held = [added()]
                        n_held = len(held[0][0])
                        if n_held > HELD // 2:
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["key", "w", "n"])
                            held, n_held = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in added()], ["key", "w", "n"])

        def best(pdf: pd.DataFrame) -> pd.DataFrame:
            k = int(pdf["node"].iloc[0])
            _, slot, bin_, cls = np.unravel_index(pdf["key"].to_numpy(), shape)
            w, n = np.zeros(shape[1:]), np.zeros(shape[1:], np.int64)
            w[slot, bin_, cls], n[slot, bin_, cls] = pdf["w"], pdf["n"]
            total, rows_ = w[-1, 0], n[-1, 0]
            out = {"node": [k], "total": [total.tolist()], "column": [-1], "split": [0]}
            if n_columns and impurity(total, kind) > 1e-12 and total.sum() > 0:
                w, n, each, zero = w[:-1], n[:-1], np.arange(n_columns), points.zero[candidates[k]]
                w[each, zero] += total - w.sum(1)
                n[each, zero] += rows_ - n.sum(1)
                w[n == 0] = 0.0
                left, n_left = w.cumsum(1)[:, :-1], n.sum(2).cumsum(1)[:, :-1]
                right = np.maximum(total - left, 0.0)
                share = left.sum(2) / total.sum()
                gain = impurity(total, kind) - share * impurity(left, kind) - (1 - share) * impurity(right, kind)
                ok = (n_left >= least) & (rows_.sum() - n_left >= least)
                ok &= np.arange(n_bins - 1) < points.number[candidates[k]][:, None]
                gain = np.where(ok, gain, -1.0).round(12)  # equal gains stay equal in whatever order weights were added
                at, split = np.unravel_index(gain.argmax(), gain.shape)
                if gain[at, split] > 0 and gain[at, split] >= min_gain:
                    out |= {"column": [int(candidates[k][at])], "split": [int(split)]}
            return pd.DataFrame(out)

        per_node = shape[1] * shape[2] * shape[3]
        counts = rows.mapInArrow(count, "key long, w double, n long").groupBy("key").agg(F.sum("w").alias("w"), F.sum("n").alias("n"))
        counts = counts.withColumn("node", F.floor(F.col("key") / F.lit(per_node)).cast("int"))
        found = counts.withColumn("key", F.pmod("key", F.lit(per_node))).groupBy("node").applyInPandas(
            best, "node int, total array<double>, column long, split long")
        grown = []
        for r in found.collect():
            t, i = open_[r["node"]]
            trees[t].weight[i], trees[t].column[i], trees[t].split[i] = r["total"], r["column"], r["split"]
            grown += [(t, 2 * i), (t, 2 * i + 1)] if r["column"] >= 0 else []
        return sorted(grown)
