"""Line dedup by site-relative frequency.

Per host, a line is boilerplate when the share of the host's pages that hold it
exceeds a ratio. Lines are counted once per page as 128-bit hashes, pre-aggregated
before the shuffle; the boilerplate of a host is a short list (at most lines per
page / ratio entries). The lists are written, so the planner knows their size: small, they go to
the pages, which stay where they lie; else pages and lists meet by host in a plain join, whose
hot hosts AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import text_of

_EDGE = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def _line_key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def drop_boilerplate(pages: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """One row per page: id, host, ``n_lines``, ``n_dropped``, ``kept_text``.

    Lines are what newlines separate, compared without the white space at their ends.
    A line goes where it stands on at least ``min_pages`` pages of the host and on more
    than ``ratio`` of them; every occurrence goes. Blank lines always stay, so does
    every line of a small host. Null text counts as empty (one blank line); null
    hosts form one host. Repeated rows are pages of their own. An empty table gives an
    empty result; only the three named columns are read.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(host_col).cast("string").alias("_host"),
                        text_of(text_col).alias("_text"))
    bare = lambda line: F.regexp_replace(line, _EDGE, "")
    lines = F.split("_text", "\n")
    counted = (rows.select("_host", F.explode(F.array_distinct(F.transform(lines, bare))).alias("_line"))
               .filter("_line != ''").select("_host", _line_key(F.col("_line")).alias("_key"))
               .groupBy("_host", "_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_pages))
    hosts = rows.groupBy(F.col("_host").alias("_of")).agg(F.count(F.lit(1)).alias("_pages"))
    boiler = (counted.join(hosts, F.col("_host").eqNullSafe(F.col("_of")))
              .filter(F.col("_n") > F.lit(float(ratio)) * F.col("_pages"))
              .groupBy("_of").agg(F.collect_list("_key").alias("_boiler")))
    out = rows.join(materialize(boiler, "boilerplate"), F.col("_host").eqNullSafe(F.col("_of")), "left")
    keep = F.filter(lines, lambda x: F.coalesce(
        (bare(x) == "") | ~F.array_contains(F.col("_boiler"), _line_key(bare(x))), F.lit(True)))
    out = out.select("_id", "_host", F.size(lines).alias("n_lines"), keep.alias("_kept"))
    return out.select(F.col("_id").alias(id_col), F.col("_host").alias(host_col), "n_lines",
                      (F.col("n_lines") - F.size("_kept")).alias("n_dropped"), F.array_join("_kept", "\n").alias("kept_text"))
