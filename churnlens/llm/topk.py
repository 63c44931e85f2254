"""Exact top-k inner product by Fagin's threshold algorithm, in blocks.

Candidates are dealt into blocks of bounded size, queries likewise; each cell (a
query block against a candidate block) sorts the candidates along every
dimension once and runs the threshold algorithm for each of its queries: it goes
down all lists together, scores candidates as they first appear, and stops when the
bound of the unseen (the product of the query with the values at the current depth)
lies below the kth score. The best k of each cell then compete per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship

_HITS = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                                         & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def threshold_topk(query: np.ndarray, values: np.ndarray, order: np.ndarray, ids: np.ndarray, k: int,
                   skip: np.ndarray | None = None, first_depth: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(row, score) of the k best rows of ``values`` (n x d) for one query, ties to the
    smaller id. ``order[:, j]`` lists the rows by ascending value in dimension j.
    ``skip`` marks rows that take no part. The depth grows fourfold from step to step."""
    n = len(values)
    used = np.flatnonzero(query)
    seen = np.zeros(n, bool) if skip is None else skip.copy()
    rows, scores = np.zeros(0, np.int64), np.zeros(0, values.dtype)
    if len(used) == 0:  # every score is 0: the smallest ids
        rows = np.flatnonzero(~seen)
        rows = rows[np.argsort(ids[rows], kind="stable")[:k]]
        return rows, np.zeros(len(rows), values.dtype)
    down = query[used] > 0
    depth, done = min(first_depth, n), 0
    while done < n:
        top = order[n - depth: n - done, used[down]]
        bottom = order[done:depth, used[~down]]
        fresh = np.concatenate([top.ravel(), bottom.ravel()])
        fresh = np.unique(fresh[~seen[fresh]])
        seen[fresh] = True
        if len(fresh):
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, values[fresh] @ query])
            best = np.lexsort((ids[rows], -scores))[:k]
            rows, scores = rows[best], scores[best]
        done = depth
        if done >= n:
            break
        edge = np.where(down, values[order[n - done, used], used], values[order[done - 1, used], used])
        if len(rows) == k and scores[-1] > edge @ query[used]:  # an unseen row may still tie at the bound
            break
        depth = min(n, depth * 4)
    return rows, scores


def _cell_hits(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    out_q, out_v, out_s = [], [], []
    if len(queries) and len(rows):
        rows = rows.assign(_len=rows["x"].map(len))
        lengths = queries["x"].map(len)
        for length, part in rows.groupby("_len", sort=True):  # vectors of one length are comparable
            mine = queries[lengths == length]
            if not len(mine) or not length:
                continue
            ids = part["vec_id"].to_numpy()
            x, q = np.stack(part["x"].to_numpy()), np.stack(mine["x"].to_numpy())
            peak = float(np.abs(x).max()) * float(np.abs(q).max()) * length
            # below 2**53 doubles are exact and the products run in BLAS; else Python integers
            kind = np.float64 if peak < 2.0 ** 53 else object
            x, q = x.astype(kind), q.astype(kind)
            order = np.argsort(x, axis=0, kind="stable")
            for query_id, vector in zip(mine["vec_id"].to_numpy(), q):
                hit, score = threshold_topk(vector, x, order, ids, k, skip=ids == query_id)
                out_q += [query_id] * len(hit)
                out_v += ids[hit].tolist()
                out_s += [max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in score]
    return pd.DataFrame({"query_id": np.array(out_q, np.int64), "vec_id": np.array(out_v, np.int64),
                         "score": np.array(out_s, np.int64)})


def topk_inner_product(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50,
                       k: int = 5, scale: int = 256, block_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every query, exactly.

    Queries are the rows whose id is divisible by ``every``; candidates all rows with
    another id. Vectors that are null, or hold null or non-finite components, and rows
    of null id take no part. A vector is compared with those of its length; empty
    vectors meet none. Rows repeated under one id count once (the vector that sorts first, if
    they differ). Scores beyond a long are held at its ends. Ties go to the smaller id.
    An empty table gives an empty result; other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
            .filter(F.col("vec_id").isNotNull() & usable(F.col("x")))
            .select("vec_id", quantised(F.col("x"), scale).alias("x"))
            .groupBy("vec_id").agg(F.min("x").alias("x")))
    queries = rows.filter(F.col("vec_id") % every == 0)
    n_rows = rows.count()
    blocks = max(1, math.ceil(n_rows / block_rows))
    query_blocks = max(1, math.ceil(queries.count() / query_rows))

    spread = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    candidates = rows.withColumn("b", spread(blocks).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.withColumn("q", spread(query_blocks).cast("int")).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def cell(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        return _cell_hits(asking, offered, k)

    hits = asked.groupBy("q", "b").cogroup(candidates.groupBy("q", "b")).applyInPandas(cell, _HITS)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
