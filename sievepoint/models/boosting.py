"""Boosted trees with leaf penalties and column samples: second-order gain from gradient histograms over binned columns.

Columns are binned once. For every level of a tree each task sums gradients and curvatures of its rows by node, column and bin;
the sums of all tasks meet by node and column, where the best cut is chosen. The driver sees one cut for each node.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.runtime import materialize

# Trees whose answers are worked out anew in every pass before the rows' margins are written again.
PENDING = 8
# Gains under this are rounding.
LEAST_GAIN = 1e-9
SUMS = "node int, feature int, g array<double>, h array<double>"
CUTS = "node int, feature int, bin int, gain double, g_left double, h_left double, g double, h double"


def shrunk(g, alpha: float):
    """A gradient sum less what the absolute penalty takes from it."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_value(g: float, h: float, alpha: float, lam: float, rate: float) -> float:
    return float(-rate * shrunk(g, alpha) / (h + lam)) if h + lam > 0 else 0.0


def best_cut(g: np.ndarray, h: np.ndarray, alpha: float, lam: float, least_weight: float) -> tuple:
    """(bin, gain, sums left) of the best cut "at or under this bin"; bin -1 if none gains."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    worth = lambda a, b: shrunk(a, alpha) ** 2 / np.maximum(b + lam, 1e-300)
    gain = 0.5 * (worth(left_g, left_h) + worth(all_g - left_g, all_h - left_h) - worth(all_g, all_h))
    gain = np.where((left_h >= least_weight) & (all_h - left_h >= least_weight), gain, -1.0)
    at = int(gain.argmax()) if len(gain) else -1
    if at < 0 or gain[at] <= LEAST_GAIN:
        return -1, 0.0, 0.0, 0.0, float(all_g), float(all_h)
    return at, float(gain[at]), float(left_g[at]), float(left_h[at]), float(all_g), float(all_h)


def nodes_of(tree: dict, bins: np.ndarray) -> np.ndarray:
    """The node that each row reaches; children of node i are 2 i + 1 (at or under the cut) and 2 i + 2."""
    at = np.zeros(len(bins), np.int64)
    for node in sorted(tree["cuts"]):
        feature, cut = tree["cuts"][node][:2]
        here = at == node
        at[here] = 2 * node + 1 + (bins[here, feature] > cut)
    return at


def _margins(trees: list[dict], bins: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bins))
    for tree in trees:
        values = np.zeros(max(tree["leaves"]) + 1)
        values[list(tree["leaves"])] = list(tree["leaves"].values())
        out += values[nodes_of(tree, bins)]
    return out


def _binned(edges: list[list[float]]):
    """Rows to (label, bins, margin): a bin is the number of edges under the value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, values = batch.num_rows, batch.column("x")
            rows = values.flatten().to_numpy(zero_copy_only=False).reshape(n, len(edges))
            bins = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(np.zeros(n))],
                                             ["y", "bins", "margin"])
    return run


def _bins(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _advanced(trees: list[dict], width: int):
    """The same rows with the trees' answers in their margins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = batch.column("margin").to_numpy() + _margins(trees, _bins(batch.column("bins"), width))
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("bins"), pa.array(margin)], ["y", "bins", "margin"])
    return run


def _summed(pending: list[dict], tree: dict, open_nodes: list[int], features: list[int], width: int, n_bins: int):
    """Gradient and curvature sums of a task's rows by open node, column and bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {node: i for i, node in enumerate(open_nodes)}
        size = len(features) * n_bins
        sums = np.zeros((2, len(open_nodes) * size))
        for batch in batches:
            bins, y = _bins(batch.column("bins"), width), batch.column("y").to_numpy()
            p = 1 / (1 + np.exp(-(batch.column("margin").to_numpy() + _margins(pending, bins))))
            at = np.array([place.get(n, -1) for n in range(max(open_nodes) + 1)] + [-1])[np.minimum(nodes_of(tree, bins), max(open_nodes) + 1)]
            kept = at >= 0
            cell = at[kept, None] * size + np.arange(len(features)) * n_bins + bins[kept][:, features]
            for i, weight in enumerate((p - y, p * (1 - p))):
                sums[i] += np.bincount(cell.ravel(), np.repeat(weight[kept], len(features)), sums.shape[1])
        shaped = sums.reshape(2, len(open_nodes) * len(features), n_bins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(open_nodes, len(features)), pa.int32()), pa.array(np.tile(features, len(open_nodes)), pa.int32()),
             pa.array(list(shaped[0]), pa.list_(pa.float64())), pa.array(list(shaped[1]), pa.list_(pa.float64()))], ["node", "feature", "g", "h"])
    return run


def _chosen(alpha: float, lam: float, least_weight: float):
    def of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        g, h = (np.stack(rows[c].to_numpy()) for c in ("g", "h"))
        # Sums of all tasks in an order of their own, so that equal rows give equal cuts however they are dealt.
        total_g, total_h = (np.sort(x, axis=0).sum(axis=0) for x in (g, h))
        return pd.DataFrame([(*key, *best_cut(total_g, total_h, alpha, lam, least_weight))], columns=[c.split()[0] for c in CUTS.split(", ")])
    return of


def _sample(features: list[int], share: float, *salt) -> list[int]:
    """``ceil(share * n)`` features, chosen by hash."""
    order = sorted(features, key=lambda f: hashlib.md5(":".join(map(str, (*salt, f))).encode()).hexdigest())
    return sorted(order[:max(1, math.ceil(share * len(features)))])


class _TreeParams(HasFeaturesCol, HasLabelCol):
    _float, _int = TypeConverters.toFloat, TypeConverters.toInt
    maxIter = Param(Params._dummy(), "maxIter", "trees", _int)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of cuts in a tree", _int)
    stepSize = Param(Params._dummy(), "stepSize", "factor of each tree's answers", _float)
    regLambda = Param(Params._dummy(), "regLambda", "squared penalty of leaf values", _float)
    regAlpha = Param(Params._dummy(), "regAlpha", "absolute penalty of leaf values", _float)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least curvature of a child", _float)
    colsampleByTree = Param(Params._dummy(), "colsampleByTree", "share of columns drawn for a tree", _float)
    colsampleByLevel = Param(Params._dummy(), "colsampleByLevel", "share of a tree's columns drawn for a level", _float)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a column, 256 at most", _int)
    seed = Param(Params._dummy(), "seed", "seed of column samples", _int)


class PenalisedTrees(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator of ``PenalisedTreesModel`` for a 0/1 label and a feature vector without missing values."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxIter=100, maxDepth=5, stepSize=0.3, regLambda=1.0, regAlpha=0.0,
                 minChildWeight=1.0, colsampleByTree=1.0, colsampleByLevel=1.0, maxBins=64, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(featuresCol="features", labelCol="label", maxIter=100, maxDepth=5, stepSize=0.3, regLambda=1.0, regAlpha=0.0,
                         minChildWeight=1.0, colsampleByTree=1.0, colsampleByLevel=1.0, maxBins=64, seed=42)

    def _edges(self, rows: DataFrame, width: int, n_bins: int) -> list[list[float]]:
        """Upper edges of the bins of each column: values at even ranks, all of them where they are few."""
        shares = [i / n_bins for i in range(1, n_bins)]
        ranks = rows.agg(*(F.percentile_approx(F.get("x", F.lit(j)), shares, 20_000).alias(f"e{j}") for j in range(width))).first()
        return [sorted(set(ranks[f"e{j}"] or ())) for j in range(width)]

    def _fit(self, df: DataFrame) -> "PenalisedTreesModel":
        get = lambda name: self.getOrDefault(getattr(self, name))
        alpha, lam, rate, seed = get("regAlpha"), get("regLambda"), get("stepSize"), get("seed")
        n_bins = min(256, get("maxBins"))
        rows = df.select(F.col(self.getLabelCol()).cast("double").alias("y"), vector_to_array(self.getFeaturesCol()).alias("x")).where("y IS NOT NULL")
        first = rows.first()
        width = len(first.x) if first else 0
        edges = self._edges(rows, width, n_bins) if width else []
        now = materialize(rows.mapInArrow(_binned(edges), "y double, bins binary, margin double")) if width else None
        trees, pending = [], []
        for t in range(get("maxIter") if width else 0):
            of_tree = _sample(list(range(width)), get("colsampleByTree"), seed, t)
            tree, sums, open_nodes = {"cuts": {}, "leaves": {}}, {}, [0]
            for level in range(get("maxDepth")):
                features = _sample(of_tree, get("colsampleByLevel"), seed, t, level)
                cuts = (now.mapInArrow(_summed(pending, tree, open_nodes, features, width, n_bins), SUMS).groupBy("node", "feature")
                        .applyInPandas(_chosen(alpha, lam, get("minChildWeight")), CUTS))
                best = F.max_by(F.struct(*cuts.columns), F.struct("gain", -F.col("feature")))
                for r in (r.best for r in cuts.groupBy("node").agg(best.alias("best")).collect()):  # one for each open node
                    sums[r.node] = (r.g, r.h)
                    if r.bin >= 0:
                        tree["cuts"][r.node] = (r.feature, r.bin, edges[r.feature][r.bin], r.gain)
                        sums[2 * r.node + 1], sums[2 * r.node + 2] = (r.g_left, r.h_left), (r.g - r.g_left, r.h - r.h_left)
                open_nodes = sorted(c for n in open_nodes if n in tree["cuts"] for c in (2 * n + 1, 2 * n + 2))
                if not open_nodes:
                    break
            tree["leaves"] = {n: leaf_value(*sums[n], alpha, lam, rate) for n in sums if n not in tree["cuts"]}
            trees.append(tree)
            pending.append(tree)
            if len(pending) == PENDING:
                now, pending = materialize(now.mapInArrow(_advanced(pending, width), now.schema)), []
        model = PenalisedTreesModel(featuresCol=self.getFeaturesCol())
        return model._set(trees=json.dumps([{"cuts": {str(n): c for n, c in t["cuts"].items()},
                                             "leaves": {str(n): v for n, v in t["leaves"].items()}} for t in trees]), width=width)


class PenalisedTreesModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``margin`` and ``probability`` (a vector of both classes)."""
    trees = Param(Params._dummy(), "trees", "cuts and leaf values as JSON", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(trees="[]", width=0)

    def listed(self) -> list[dict]:
        """Trees as (feature, bin, threshold, gain) by inner node and value by leaf."""
        return [{"cuts": {int(n): tuple(c) for n, c in t["cuts"].items()}, "leaves": {int(n): v for n, v in t["leaves"].items()}}
                for t in json.loads(self.getOrDefault(self.trees))]

    @property
    def featureImportances(self):
        """Gain by feature, as a share of all gain."""
        total = np.zeros(self.getOrDefault(self.width))
        for tree in self.listed():
            for feature, _, _, gain in tree["cuts"].values():
                total[feature] += gain
        return Vectors.dense(total / (total.sum() or 1.0))

    def _margin(self) -> Column:
        # The threshold stands for the bin, so that values are compared as they are.
        trees = [{**t, "cuts": {n: (f, x) for n, (f, _, x, _) in t["cuts"].items()}} for t in self.listed()]

        def of(rows: pd.Series) -> pd.Series:
            return pd.Series(_margins(trees, np.stack(rows.to_numpy())) if len(rows) else [], dtype="float64")
        return F.pandas_udf(of, "double")(vector_to_array(self.getFeaturesCol()))

    def _transform(self, df: DataFrame) -> DataFrame:
        p = 1 / (1 + F.exp(-F.col("margin")))
        return df.withColumn("margin", self._margin()).withColumn("probability", array_to_vector(F.array(1 - p, p)))
