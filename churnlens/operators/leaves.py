"""The leaves of a boosted model as boxes, and what is read off them with numpy inside tasks.

A leaf is a box: an interval per feature. The cuts of all trees divide each feature into a few bins (the training's histogram bounds their
number), so a row is known by its bins, and whether it fits a leaf in a feature is looked up by the bin. One table per feature holds that
for all leaves: the margin of a row is an AND over its features' entries, without walking a tree.
"""

from __future__ import annotations

from math import factorial

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from churnlens.session import scratch_path

_CELLS = 1 << 18  # row-leaf pairs held at once (they stay in a core's cache)
_WORD = 32        # leaves of one tree in a word


class LeafBoxes:
    """All leaves of a model: each holds the rows with low < x <= high in every feature, and adds ``value`` to the margin. ``tree``
    tells the tree of each leaf, of whose leaves a row fits exactly one. Values of rows must be finite."""

    def __init__(self, low: np.ndarray, high: np.ndarray, value: np.ndarray, tree: np.ndarray):
        self.value, width = value, low.shape[1]
        self.cuts = [np.unique(low[np.isfinite(low[:, f]), f]) for f in range(width)]
        fits = []  # per feature: (bin, leaf)
        for f, cuts in enumerate(self.cuts):
            bins = np.arange(len(cuts) + 1)[:, None]
            fits.append((bins >= np.searchsorted(cuts, low[:, f], "right")) & (bins <= np.searchsorted(cuts, high[:, f], "left")))
        kind = np.min_scalar_type((1 << width) - 1)
        self.codes = [(fit * (1 << f)).astype(kind) for f, fit in enumerate(fits)]
        # a row fits at most one leaf of a word
        _, tree, sizes = np.unique(tree, return_inverse=True, return_counts=True)
        order = np.argsort(tree, kind="stable")
        words = -(-sizes // _WORD)
        place = np.empty(len(value), np.int64)
        place[order] = np.concatenate([np.arange(n) + _WORD * at for n, at in zip(sizes, np.cumsum(words) - words, strict=True)])
        self.words = []
        for fit in fits:
            wide = np.zeros((len(fit), words.sum() * _WORD), bool)
            wide[:, place] = fit
            self.words.append(np.packbits(wide, axis=1, bitorder="little").view("<u4"))
        self.added = np.zeros((words.sum(), _WORD + 1))  # what a word adds by its bit; slot 0: none
        self.added[place // _WORD, place % _WORD + 1] = value
        self.weights, self.pattern = _pattern_weights(width)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(cuts, x[:, f], "left") for f, cuts in enumerate(self.cuts)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaf values that each row reaches."""
        bins, out = self.bins(x), np.zeros(len(x))
        starts = np.arange(len(self.added)) * (_WORD + 1)
        step = max(1, _CELLS // len(starts) // 8)
        for lo in range(0, len(x), step):
            fit = self.words[0][bins[0][lo: lo + step]]
            for table, b in zip(self.words[1:], bins[1:], strict=True):
                fit &= table[b[lo: lo + step]]
            # one bit or none is set: its number is the exponent of the word as a double
            slot = np.maximum((fit.astype(float).view(np.int64) >> 52) - 1022, 0)
            out[lo: lo + step] = self.added.take(slot + starts).sum(axis=1)
        return out

    def contributions(self, x: np.ndarray, baseline: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(margin of the baseline, margins of the rows, contributions by row and feature)."""
        def fits(bins: list[np.ndarray]) -> np.ndarray:
            """(row, leaf): a bit per feature in which the row's value lies in the leaf's interval."""
            out = self.codes[0][bins[0]]
            for table, b in zip(self.codes[1:], bins[1:], strict=True):
                out |= table[b]
            return out

        bins, base = self.bins(x), fits(self.bins(baseline[None, :]))[0]
        full, leaves = base.dtype.type((1 << x.shape[1]) - 1), len(self.value)
        out = np.zeros((len(x), x.shape[1] + 1))
        step = max(1, _CELLS // leaves)
        for lo in range(0, len(x), step):
            mine = fits([b[lo: lo + step] for b in bins])
            n = len(mine)
            hit = np.flatnonzero((mine | base) == full)  # leaves that some coalition reaches
            row, leaf = np.divmod(hit, leaves)
            kind = self.pattern[mine.ravel()[hit], base[leaf]]
            sums = np.bincount(row * len(self.weights) + kind, self.value[leaf], n * len(self.weights))
            out[lo: lo + step] = sums.reshape(n, -1) @ self.weights
        return float(self.value[base == full].sum()), out[:, -1], out[:, :-1]


def _pattern_weights(width: int) -> tuple[np.ndarray, np.ndarray]:
    """What a leaf's value adds to each feature, and (last column) to the row's margin, by which features only the row, only the baseline
    or both fit; and the number of that pattern by the bits of row and baseline (-1: a leaf that no coalition reaches)."""
    full = (1 << width) - 1
    pattern, weights = np.full((full + 1, full + 1), -1, np.int64), []
    for mine in range(full + 1):
        for theirs in range(full + 1):
            if mine | theirs != full:
                continue
            only_row, only_base = mine & ~theirs, theirs & ~mine
            p, q = only_row.bit_count(), only_base.bit_count()
            gain = factorial(p - 1) * factorial(q) / factorial(p + q) if p else 0.0
            loss = factorial(p) * factorial(q - 1) / factorial(p + q) if q else 0.0
            pattern[mine, theirs] = len(weights)
            weights.append([gain * (only_row >> f & 1) - loss * (only_base >> f & 1) for f in range(width)] + [float(mine == full)])
    return np.array(weights), pattern


def leaf_boxes(model: PipelineModel, spark: SparkSession) -> LeafBoxes:
    """The leaves of a fitted pipeline's last stage, read once from its saved form: a table of nodes whose size the
    number of trees and their depth bound."""
    trees = model.stages[-1]
    if (have := getattr(trees, "_leaf_boxes", None)) is not None:
        return have
    path = scratch_path(spark, "trees")
    trees.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), "nodeData.prediction").collect()
    weights, width = trees.treeWeights, trees.numFeatures
    children = {(r["treeID"], r["id"]): r for r in nodes}
    low, high, value, of = [], [], [], []
    for tree, weight in enumerate(weights):
        todo = [(0, [-np.inf] * width, [np.inf] * width)]
        while todo:
            at, below, above = todo.pop()
            r = children[tree, at]
            if r["leftChild"] < 0:
                low.append(below)
                high.append(above)
                value.append(weight * r["prediction"])
                of.append(tree)
                continue
            f, cut = r["feature"], r["threshold"]
            todo.append((r["leftChild"], below, [min(v, cut) if i == f else v for i, v in enumerate(above)]))
            todo.append((r["rightChild"], [max(v, cut) if i == f else v for i, v in enumerate(below)], above))
    trees._leaf_boxes = LeafBoxes(np.array(low), np.array(high), np.array(value), np.array(of))
    return trees._leaf_boxes
