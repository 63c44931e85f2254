"""Mixing sources to target weights by systematic sampling.

Sources share all words by weight, no source above ``cap`` times its own words.
Within a source each document expects target / size copies. Documents stand in
order of size; the running sum of expected copies plus one random offset is cut
at the integers, and a document is emitted once per integer crossed inside its
own stretch. In order of size the sample follows the size distribution, so taken
words stay within a few long documents of the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import shielded, text_of, word_count

_SALTS = 256


def fraction_of(source: Column, seed: str) -> Column:
    """A number in [0, 1), a multiple of 2**-20, fixed by the source and the seed."""
    digest = F.md5(F.concat(F.lit(seed + "/"), F.coalesce(source, F.lit("\x00null"))))
    return F.conv(F.substring(digest, 1, 5), 16, 10).cast("long") / F.lit(float(1 << 20))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size) -> the same with ``target``: one row per source.

    Sources by code point, null last, weigh ``weights`` repeating. Water filling: the
    targets are min(cap * size, level * weight) with the level at which they add up to
    all sizes. Sources in order of cap / weight are capped up to a point and not
    beyond it, so the level is the smallest of (what is left of the total) / (weight
    left) that a source does not reach its cap at. The table holds one row per
    source, which is all that these windows see.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    t = t.withColumn("_total", F.sum("source_size").over(every))
    t = (t.withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
         .withColumn("_level", F.col("_left") / F.sum("_weight").over(onwards)))
    open_ = F.col("_level") * F.col("_weight") <= F.col("_cap")
    t = t.withColumn("_fill", F.first(F.when(open_, F.col("_level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return t.select("source", "source_size",
                    F.least(F.col("_cap"), F.coalesce(F.col("_fill") * F.col("_weight"), F.col("_cap"))).alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: id, source, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    ``size`` counts words, null text 0. A document without words may be emitted but
    takes nothing. A source without words has target 0 and emits nothing. Repeated
    rows are documents of their own, told apart by nothing, so each takes its own
    place in the order. An empty table gives an empty result. Reruns agree: the order
    is by (size, salt of the id, id), for null ids by (size, salt of the text, text hash), the offset by source name and ``seed``.

    The place of a document is found without a window over a source: documents per
    (source, size) are counted, and running sums over sizes and over 256 salts of
    the id give each (source, size, salt) its first place. A hot source or a hot
    size is thus spread; windows over rows see one salt of one size.
    """
    out = _mixed(docs, id_col, text_col, source_col, weights, cap, seed)
    return out.select(F.col("_id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "copies", "taken")


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3,
           seed: str = "mix") -> DataFrame:
    """:func:`mix_sources` under fixed names, with ``_mark``: a hash of the text of a null id, else 0."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(source_col).cast("string").alias("source"),
                       word_count(text_of(text_col)).alias("size"), text_of(text_col).alias("_text"))
    # null ids, which any number of rows may share, are spread by their texts
    spread = F.md5(F.coalesce(F.col("_id").cast("string"), F.col("_text")))
    rows = materialize(rows.withColumn("_salt", F.conv(F.substring(spread, 1, 2), 16, 10).cast("int"))
                       .withColumn("_mark", F.when(F.col("_id").isNull(), F.xxhash64("_text")).otherwise(F.lit(0)))
                       .drop("_text"), "mix-sizes")

    cells = rows.groupBy("source", "size", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    steps = cells.groupBy("source", "size").agg(F.sum("_n").alias("_n"))
    sizes = steps.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).alias("source_size"))
    targets = source_targets(sizes, weights, float(cap))

    in_source = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("source", "size", F.coalesce(F.sum("_n").over(in_source), F.lit(0)).alias("_before"))
    steps = _on(steps, targets, ["source"])
    in_size = Window.partitionBy("source", "size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("source", "size", "_salt", F.coalesce(F.sum("_n").over(in_size), F.lit(0)).alias("_inside"))
    cells = _on(cells, steps, ["source", "size"])

    in_cell = Window.partitionBy("source", "size", "_salt").orderBy("_id", "_mark")
    out = _on(rows.withColumn("_nth", F.row_number().over(in_cell)), cells, ["source", "size", "_salt"])
    place = (F.col("_before") + F.col("_inside") + F.col("_nth")).cast("double")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = fraction_of(F.col("source"), seed)
    copies = F.floor(place * share + offset) - F.floor((place - 1) * share + offset)
    copies = F.least(copies, F.lit(int(cap)))
    return out.select("_id", "source", "size", "_mark", "source_size", "target",
                      copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join in which a null source meets the null source."""
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(right, on).drop(*[f"_r_{k}" for k in keys])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    **params) -> DataFrame:
    """The mix itself: every row of ``docs``, with its columns, whatever their names, as often as it has copies.

    Rows that share id, size and source (null ids: and text) differ in nothing that a decision rests on;
    they are numbered on both sides and matched by number.
    """
    keys = ["_mix_id", "_mix_source", "_mix_size", "_mix_mark"]
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy("_mix_id"))
    mix = _mixed(docs, id_col, text_col, source_col, **params).select(
        F.col("_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"),
        F.col("_mark").alias("_mix_mark"), F.col("copies").alias("_mix_copies")).withColumn("_mix_nth", numbered)
    rows = shielded(docs, _mix_id=F.col(id_col).cast("long"), _mix_source=F.col(source_col).cast("string"), _mix_size=word_count(text_of(text_col)),
                    _mix_mark=F.when(F.col(id_col).cast("long").isNull(), F.xxhash64(text_of(text_col))).otherwise(F.lit(0)))
    out = _on(rows.withColumn("_mix_nth", numbered), mix, [*keys, "_mix_nth"]).filter("_mix_copies > 0")
    out = out.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return out.select("_row.*")
