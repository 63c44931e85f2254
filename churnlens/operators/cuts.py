"""Candidate cuts of the features over all rows, and the rows that differ in no cut, counted.

A histogram tree sees of a value only the cuts below it. MLlib takes its cuts from a sample of some 10,000 rows; here they come
from the counts of every value, by the same rule: all midpoints of neighbouring values where these are few, else
midpoints near equal shares of the weight. Rows of equal bins and label have equal gradients in every tree, so they are one row
of their common weight: the fit is that of all rows, and its passes grow with the distinct rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.running import running_totals
from churnlens.session import materialize, scratch_path

BINS = 32  # of a feature at most, as by MLlib's default


def value_counts(data: DataFrame, columns, label: str = "label") -> DataFrame:
    """(feature, value, n0, n1): rows of either label that hold each value; written once."""
    long = data.unpivot([label], list(columns), "feature", "value")
    return materialize(long.groupBy("feature", "value").agg(
        F.count_if(F.col(label) != 1.0).alias("n0"), F.count_if(F.col(label) == 1.0).alias("n1")), "value_counts")


def cut_ranks(distinct: int, reached: list[int | None]) -> list[int]:
    """Ranks (from 1) of the values that a cut lies just below. ``reached`` holds for each share the first rank whose middle is beyond
    it; a very common value reaches several, and the cuts that it takes up go to the values after it, one each."""
    if distinct <= len(reached) + 1:
        return list(range(2, distinct + 1))
    ranks, last = [], 1
    for rank in reached:
        if rank is None or (last := max(last + 1, rank)) > distinct:
            break
        ranks.append(last)
    return ranks


def feature_cuts(counts: DataFrame, columns, weights: tuple[float, float], bins: int = BINS) -> list[list[float]]:
    """Ascending cuts of each feature: at most ``bins`` - 1 numbers."""
    run = running_totals(counts.withColumn("one", F.lit(1).cast("long")), "value", ["n0", "n1", "one"], ["feature"])
    middle = sum(F.lit(w) * (F.col(f"cum_{n}") - F.col(n) / 2) for n, w in zip(("n0", "n1"), weights))
    ranked = materialize(run.select("feature", "value", "n0", "n1", F.col("cum_one").alias("rank"), middle.alias("middle")), "ranked_values")
    totals = ranked.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.max("rank").alias("distinct"))
    totals = {r["feature"]: r for r in totals.collect()}  # one row per feature
    if not totals:
        return [[] for _ in columns]
    any_ = next(iter(totals.values()))  # every feature holds every row
    share = (weights[0] * any_["n0"] + weights[1] * any_["n1"]) / bins
    beyond = [F.min(F.when((F.col("rank") > 1) & (F.col("middle") > share * k), F.col("rank"))) for k in range(1, bins)]
    reached = {r["feature"]: r["reached"] for r in ranked.groupBy("feature").agg(F.array(*beyond).alias("reached")).collect()}
    ranks = {c: cut_ranks(totals[c]["distinct"], reached[c]) for c in columns}
    wanted = sorted({(c, r) for c in columns for at in ranks[c] for r in (at - 1, at)})
    if not wanted:
        return [[] for _ in columns]
    # at most 2 * (bins - 1) rows per feature
    wanted = F.broadcast(counts.sparkSession.createDataFrame(wanted, "feature string, rank long"))
    value = {(r["feature"], r["rank"]): r["value"] for r in ranked.join(wanted, ["feature", "rank"]).collect()}
    return [[(value[c, at - 1] + value[c, at]) / 2 for at in ranks[c]] for c in columns]


def bin_of(value: Column, cuts: list[float], first: int = 0) -> Column:
    """Number of cuts below a value, found by halves."""
    if not cuts:
        return F.lit(float(first))
    at = len(cuts) // 2
    return F.when(value <= F.lit(cuts[at]), bin_of(value, cuts[:at], first)).otherwise(
        bin_of(value, cuts[at + 1:], first + at + 1))


def counted_rows(data: DataFrame, columns, cuts: list[list[float]], label: str = "label") -> DataFrame:
    """The distinct rows of bins and label, with their number ``n``; written once."""
    binned = data.select(*[bin_of(F.col(c), k).alias(c) for c, k in zip(columns, cuts, strict=True)], label)
    return materialize(binned.groupBy(*columns, label).agg(F.count(F.lit(1)).alias("n")), "fit_rows")


def with_cuts(model: GBTClassificationModel, cuts: list[list[float]], spark) -> GBTClassificationModel:
    """A model of bins as a model of values: a threshold between bins becomes the cut between them. Goes by the saved form."""
    path = scratch_path(spark, "trees")
    model.write().overwrite().save(path)
    nodes = materialize(spark.read.parquet(f"{path}/data"), "nodes")  # as many as the trees have
    table = F.array(*[F.array(*[F.lit(x) for x in (*k, float("nan"))]) for k in cuts])
    split = F.col("nodeData.split")
    cut = F.get(F.get(table, split["featureIndex"]), F.floor(F.get(split["leftCategoriesOrThreshold"], F.lit(0))).cast("int"))
    moved = F.when(split["featureIndex"] >= 0, F.array(cut)).otherwise(split["leftCategoriesOrThreshold"])
    nodes.withColumn("nodeData", F.col("nodeData").withField("split.leftCategoriesOrThreshold", moved)).write.mode(
        "overwrite").parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
