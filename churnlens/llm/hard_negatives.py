"""Hard-negative mining with angular triangle filtering.

Every vector stores its angles to a few reference directions. By the triangle inequality of angles the angle of two vectors
lies between |s - t| and min(s + t, 2 pi - s - t) for their angles s, t to any one reference; the tightest of these
over all references is an interval of the cosine, and times the norms one of the score, widened beyond what doubles can
round. Only pairs whose interval reaches what is asked (the scores of the best positives, then the windows of
the negatives) are scored in integers. Rows lie in blocks by their nearest reference, whose ranges of
angles and norms rule out whole blocks for an anchor in the same way.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import map_arrow, ship
from .topk import quantised, usable

_SLACK = 1e-6  # radians: some 20 times what an arc cosine of rounded products can be off
_MARGIN = 1e-9  # of the product of norms
_AT_ONCE = 1 << 19  # pairs whose intervals are held at a time
_ROW = "vec_id long, label long, x array<long>, norm double, angles array<double>, home int"


def reference_directions(sample: list[list[int]], count: int) -> list[np.ndarray]:
    """Up to ``count`` unit vectors of a sample of vectors of one length, each next one farthest from those before."""
    rows = np.array([v for v in sample if any(v)], np.float64)
    if not len(rows):
        return []
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    chosen, nearest = [rows[0]], rows @ rows[0]
    while len(chosen) < min(count, len(rows)):
        at = int(np.argmin(nearest))
        if nearest[at] > 1 - 1e-9:
            break
        chosen.append(rows[at])
        nearest = np.maximum(nearest, rows @ rows[at])
    return chosen


def with_angles(rows: DataFrame, references: dict[int, list[np.ndarray]]) -> DataFrame:
    """Adds ``norm``, ``angles`` to the references of the vector's length, and ``home``: the number of the nearest
    one (-1 without any)."""
    first, at = {}, 0
    for d in sorted(references):
        first[d], at = at, at + len(references[d])
    stacked = {d: np.array(r) for d, r in references.items() if r}

    def run(batches):
        for batch in batches:
            norms, angles, homes = [], [], []
            for v in batch.column(2):
                v = np.array(v.as_py(), np.float64)
                norm = float(np.linalg.norm(v))
                norms.append(norm)
                if len(v) not in stacked:
                    angles.append([])
                    homes.append(-1)
                    continue
                # a zero vector's score is 0 whatever its angle
                a = np.arccos(np.clip(stacked[len(v)] @ v / (norm or 1.0), -1, 1))
                angles.append(a.tolist())
                homes.append(first[len(v)] + int(np.argmin(a)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms, pa.float64()), pa.array(angles, pa.list_(pa.float64())),
                                              pa.array(homes, pa.int32())], names=["vec_id", "label", "x", "norm", "angles", "home"])

    return map_arrow(rows, run, _ROW)


def score_bounds(norm: float, angles: np.ndarray, norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest, highest) inner product of one vector with each of many, by their angles to common references."""
    size = norm * norms
    if not others.shape[1]:
        return -size * (1 + _MARGIN) - 1, size * (1 + _MARGIN) + 1
    both = others + angles
    near = np.abs(others - angles).max(axis=1) - _SLACK
    far = np.minimum(both, 2 * np.pi - both).min(axis=1) + _SLACK
    high = np.where(near > 0, np.cos(np.minimum(near, np.pi)), 1.0)
    low = np.where(far < np.pi, np.cos(np.maximum(far, 0)), -1.0)
    return low * size - _MARGIN * size - 1, high * size + _MARGIN * size + 1


class _Cell:
    """Anchors against the rows of one block, length by length."""

    def __init__(self, asking: pd.DataFrame, offered: pd.DataFrame):
        self.parts = []
        if not len(asking) or not len(offered):
            return
        mine, theirs = asking["x"].map(len), offered["x"].map(len)
        for d in sorted(set(mine) & set(theirs) - {0}):
            a, o = asking[mine == d], offered[theirs == d]
            x, q = np.stack(o["x"].to_numpy()), np.stack(a["x"].to_numpy())
            peak = float(np.abs(x.astype(float)).max()) * float(np.abs(q.astype(float)).max()) * d
            kind = np.float64 if peak * 100 < 2.0 ** 53 else object  # doubles while they are exact
            angles, norms = np.stack(o["angles"].to_numpy()).reshape(len(o), -1), o["norm"].to_numpy()
            self.parts.append((a, q.astype(kind), o["vec_id"].to_numpy(), o["label"].to_numpy(), x.astype(kind), norms, angles))

    def anchors(self):
        """(anchor, ids, labels, exact score of chosen rows, lowest, highest) of every anchor and the rows of its length."""
        for a, q, ids, labels, x, norms, angles in self.parts:
            for anchor, vector in zip(a.itertuples(index=False), q):
                low, high = score_bounds(anchor.norm, np.asarray(anchor.angles), norms, angles)
                yield anchor, ids, labels, (lambda rows, v=vector, x=x: x[rows] @ v), low, high


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    order = np.argsort(ids, kind="stable")
    return order[np.argsort(-scores[order], kind="stable")[:k]]


def _long(score) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def _positives(asking: pd.DataFrame, offered: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    for anchor, ids, labels, score, low, high in _Cell(asking, offered).anchors():
        same = np.flatnonzero((labels == anchor.label) & (ids != anchor.vec_id))
        if not len(same):
            continue
        least = -np.inf if anchor.least is None or np.isnan(anchor.least) else anchor.least
        if len(same) >= k:  # k rows score at least this
            least = max(least, np.partition(low[same], len(same) - k)[len(same) - k])
        rows = same[high[same] >= least]
        scores = score(rows)
        out += [(anchor.vec_id, ids[rows[i]], _long(scores[i])) for i in _best(scores, ids[rows], k)]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])


def _negatives(asking: pd.DataFrame, offered: pd.DataFrame, k: int, percent: tuple[int, int]) -> pd.DataFrame:
    out = []
    for anchor, ids, labels, score, low, high in _Cell(asking, offered).anchors():
        wanted = [(int(p), int(s)) for p, s in zip(anchor.positive_ids, anchor.positive_scores)]
        meets = np.zeros(len(ids), bool)
        for _, s in wanted:
            meets |= (high >= percent[0] * s / 100) & (low <= percent[1] * s / 100)
        rows = np.flatnonzero(meets & (labels != anchor.label))
        if not len(rows):
            continue
        scores = score(rows)
        for p, s in wanted:
            inside = np.flatnonzero((100 * scores >= percent[0] * s) & (100 * scores <= percent[1] * s))
            out += [(anchor.vec_id, p, s, ids[rows[inside[i]]], _long(scores[inside[i]])) for i in _best(scores[inside], ids[rows[inside]], k)]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _bound(highest: bool) -> Column:
    """The highest (or lowest) score that an anchor can have in a block, by its ranges of angles and norms."""
    angles = F.arrays_zip("angles", "from_angle", "to_angle")
    if highest:
        apart = F.transform(angles, lambda z: F.greatest(z["angles"] - z["to_angle"], z["from_angle"] - z["angles"], F.lit(0.0)))
        cosine = F.cos(F.least(F.greatest(F.coalesce(F.array_max(apart), F.lit(0.0)) - _SLACK, F.lit(0.0)), F.lit(math.pi)))
        size = F.when(cosine >= 0, F.col("to_norm")).otherwise(F.col("from_norm"))
        return cosine * size * F.col("norm") + _MARGIN * F.col("norm") * F.col("to_norm") + 1.0
    widest = F.transform(angles, lambda z: F.least(z["angles"] + z["to_angle"], F.lit(2 * math.pi) - z["angles"] - z["from_angle"]))
    farthest = F.least(F.coalesce(F.array_min(widest), F.lit(math.pi)) + _SLACK, F.lit(math.pi))
    cosine = F.cos(F.greatest(farthest, F.lit(0.0)))
    size = F.when(cosine >= 0, F.col("from_norm")).otherwise(F.col("to_norm"))
    return cosine * size * F.col("norm") - _MARGIN * F.col("norm") * F.col("to_norm") - 1.0


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                        every: int = 100, n_positives: int = 5, n_negatives: int = 10, percent: tuple[int, int] = (30, 90),
                        scale: int = 256, references: int = 16, sample_rows: int = 512, block_rows: int = 8192,
                        anchor_rows: int = 1024) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. Their positives are the ``n_positives`` best other rows of their label;
    for each, the first ``n_negatives`` rows of another label whose score lies between the two percentages of the positive's.
    Scores are integer inner products of floor(scale * x); higher ones come first, ties by the smaller id. The result is exact:
    the references (from at most ``sample_rows`` rows of smallest id hash) decide the work only.

    Rows with a null id or label, or a vector that is null or holds null or non-finite entries, take no part. A vector is compared
    with those of its length, an empty one with none; a zero vector scores 0. Rows repeated under an id count once (the smallest label
    and vector). Scores beyond a long are held at its ends. An empty table gives an empty result; other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("x")))
            .select("vec_id", F.struct("label", quantised(F.col("x"), scale).alias("x")).alias("_v"))
            .groupBy("vec_id").agg(F.min("_v").alias("_v")).select("vec_id", "_v.label", "_v.x"))
    rows = materialize(rows, "mined-rows")
    sample: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect():  # a bounded number of vectors
        sample.setdefault(len(r["x"]), []).append(r["x"])
    by_length = {d: reference_directions(v, references) for d, v in sample.items()}
    rows = with_angles(rows, by_length)

    # blocks: the rows of one home, in as many parts as its count asks for; homes are bounded by the sample
    rows = materialize(rows, "angles")
    salts = {r["home"]: max(1, math.ceil(r["count"] / block_rows)) for r in rows.groupBy("home").count().collect()}
    if not salts:
        salts = {-1: 1}
    parts = F.create_map(*[F.lit(v) for pair in salts.items() for v in pair])
    first, at = {}, 0
    for home in sorted(salts):
        first[home], at = at, at + salts[home]
    begin = F.create_map(*[F.lit(v) for pair in first.items() for v in pair])
    block = begin[F.col("home")] + F.pmod(F.xxhash64("vec_id"), parts[F.col("home")].cast("long"))
    rows = rows.withColumn("b", block.cast("int"))
    anchors = rows.filter(F.col("vec_id") % every == 0)
    groups = max(1, math.ceil(anchors.count() / anchor_rows))
    anchors = anchors.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))

    wide = max((len(r) for r in by_length.values()), default=0)
    ranges = materialize(rows.groupBy("b").agg(
        F.min("norm").alias("from_norm"), F.max("norm").alias("to_norm"), F.min("home").alias("_home"),
        *[f(F.get("angles", F.lit(j))).alias(f"_{n}{j}") for j in range(wide) for f, n in ((F.min, "from"), (F.max, "to"))]).select(
        "b", "from_norm", "to_norm", *[F.filter(F.array(*[F.col(f"_{n}{j}") for j in range(wide)]), lambda v: v.isNotNull()).cast("array<double>").alias(f"{n}_angle")
                                       if wide else F.array().cast("array<double>").alias(f"{n}_angle") for n in ("from", "to")]), "blocks")

    def against(asked: DataFrame, cell, schema: str) -> DataFrame:
        """The anchors of ``asked``, which names a block ``b`` in each row, against the rows of these blocks."""
        asked = materialize(asked, "asked")
        cells = asked.select(F.col("q").alias("q"), F.col("b").alias("b")).distinct()
        offered = rows.select("b", "vec_id", "label", "x", "norm", "angles").join(cells, "b")
        return asked.groupBy("q", "b").cogroup(offered.groupBy("q", "b")).applyInPandas(cell, schema)

    def everywhere(asking: DataFrame) -> DataFrame:
        """Each anchor at each block, with the block's ranges."""
        at_each = asking.withColumnRenamed("b", "own").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(at - 1))))
        return at_each.join(ranges, "b")

    unmeasured = F.size("angles") != F.size("from_angle")  # lengths without references, or of another length: for the cell to tell
    found = "anchor_id long, positive_id long, positive_score long"

    def positives(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        return _positives(asking, offered, n_positives)

    # an anchor's own block gives scores that rule out other blocks
    home = materialize(against(anchors.withColumn("least", F.lit(None).cast("double")), positives, found), "home-positives")
    floor = home.groupBy("anchor_id").agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("_s")).select(
        F.col("anchor_id").alias("vec_id"), F.get("_s", F.lit(n_positives - 1)).cast("double").alias("least"))
    asked = everywhere(anchors.join(floor, "vec_id", "left")).filter(
        (F.col("b") != F.col("own")) & (F.col("least").isNull() | unmeasured | (_bound(True) >= F.col("least"))))
    others = against(asked.drop("own", "from_norm", "to_norm", "from_angle", "to_angle"), positives, found)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = (home.unionByName(others).withColumn("_nth", F.row_number().over(best)).filter(F.col("_nth") <= n_positives)
              .groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("_nth", "positive_id", "positive_score"))).alias("_p")))
    chosen = materialize(chosen.select(F.col("anchor_id").alias("vec_id"), F.col("_p.positive_id").alias("positive_ids"),
                                       F.col("_p.positive_score").alias("positive_scores")), "positives")

    def negatives(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        return _negatives(asking, offered, n_negatives, percent)

    # windows of negative scores are empty: below zero the smaller percentage is the larger bound
    some = anchors.join(chosen, "vec_id").filter(F.array_max("positive_scores") >= 0)
    low = F.array_min(F.filter("positive_scores", lambda s: s >= 0)) * F.lit(percent[0] / 100.0)
    high = F.array_max("positive_scores") * F.lit(percent[1] / 100.0)
    asked = everywhere(some).filter(unmeasured | ((_bound(True) >= low) & (_bound(False) <= high)))
    mined = against(asked.drop("own", "from_norm", "to_norm", "from_angle", "to_angle"), negatives,
                    "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (mined.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def relabelled(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", every: int = 7, labels: int = 10) -> DataFrame:
    """The table with label (label + 1) modulo ``labels`` where the id is divisible by ``every``."""
    label = F.col(label_col).cast("long")
    return vectors.withColumn(label_col, F.when(F.col(id_col) % every == 0, (label + 1) % labels).otherwise(label))
