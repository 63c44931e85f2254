"""Exact dedup over content-defined chunk recipes.

Each normalised text is cut where a rolling gear hash of its last 32 bytes meets a
mask, so equal passages give equal chunks wherever they stand. Chunks are
deduplicated once across the corpus to verified identifiers: a chunk hash that
stands for exactly one byte string is that chunk's identifier; where several byte
strings share a hash, each gets an identifier of its own. A document is then its
recipe, the ordered identifiers, and equal texts are equal recipes. The
bytes of a chunk move once per map task that sees it; later steps move recipes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import SPACE_CLASS, binary_values, map_arrow, one_per, shielded, text_of

_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)
_WINDOW = 32
_PIECE = 1 << 20  # bytes hashed at once, whatever the text's length


def cut_points(data: np.ndarray, average: int = 2048, shortest: int = 512, longest: int = 8192) -> list[int]:
    """Ends of the chunks of one text. A cut depends on the 32 bytes before it and,
    through ``shortest`` and ``longest``, on the cut before."""
    n = len(data)
    if n <= shortest:
        return [n] if n else []
    candidates = []
    mask = np.uint32(average - 1) << np.uint32(20)
    for at in range(0, n, _PIECE):
        low = max(0, at - _WINDOW + 1)
        h = _GEAR[data[low: at + _PIECE]]
        step = 1
        while step < _WINDOW:  # hash of the last 2 * step bytes from two of the last step
            wide = h.copy()
            wide[step:] += h[:-step] << np.uint32(step)
            h, step = wide, step * 2
        hits = np.flatnonzero((h & mask) == 0) + low + 1
        candidates.append(hits[hits > at])
    cuts, last = [], 0
    for c in np.concatenate(candidates).tolist():
        while c - last > longest:
            last += longest
            cuts.append(last)
        if c - last >= shortest and c < n:
            cuts.append(c)
            last = c
    while n - last > longest:
        last += longest
        cuts.append(last)
    if last < n:
        cuts.append(n)
    return cuts


def _chunked(texts: DataFrame, with_bytes: bool, hash_bits: int, sizes: tuple[int, int, int]) -> DataFrame:
    """(_key, _text, _sha) -> (_key, _sha, _hash list[, _chunk list]), one row per document."""
    shift = 64 - hash_bits

    def run(batches):
        for batch in batches:
            data, offsets = binary_values(batch.column(1))
            hashes, bodies, ends = [], [], [0]
            for i in range(len(offsets) - 1):
                text = data[offsets[i]: offsets[i + 1]]
                raw, last = text.tobytes(), 0
                for c in cut_points(text, *sizes):
                    body = raw[last:c]
                    digest = hashlib.blake2b(body, digest_size=8).digest()
                    hashes.append((int.from_bytes(digest, "big") >> shift) - (1 << 63 if hash_bits == 64 else 0))
                    if with_bytes:
                        bodies.append(body)
                    last = c
                ends.append(len(hashes))
            ends = pa.array(ends, pa.int32())
            out = [batch.column(0), batch.column(2), pa.ListArray.from_arrays(ends, pa.array(hashes, pa.int64()))]
            if with_bytes:
                out.append(pa.ListArray.from_arrays(ends, pa.array(bodies, pa.binary())))
            yield pa.RecordBatch.from_arrays(out, names=["_key", "_sha", "_hash", "_chunk"][: len(out)])

    schema = "_key long, _sha string, _hash array<long>" + (", _chunk array<binary>" if with_bytes else "")
    return map_arrow(texts, run, schema)


def _told_apart(texts: DataFrame, shared: DataFrame, hash_bits: int, sizes: tuple[int, int, int]) -> DataFrame:
    """Recipes where several byte strings share a hash: such a chunk's identifier is
    its hash and its place among the distinct byte strings of that hash."""
    chunks = (_chunked(texts, True, hash_bits, sizes)
              .withColumn("_row", F.monotonically_increasing_id())
              .select("_row", "_key", "_sha", F.posexplode_outer(F.arrays_zip("_hash", "_chunk")).alias("_pos", "_c"))
              .select("_row", "_key", "_sha", "_pos", F.col("_c._hash").alias("_hash"), F.col("_c._chunk").alias("_chunk")))
    chunks = materialize(chunks, "chunks")  # row numbers are fixed by the written table
    numbered = (chunks.join(shared, "_hash", "left_semi").select("_hash", "_chunk").distinct()
                .withColumn("_n", F.row_number().over(Window.partitionBy("_hash").orderBy("_chunk"))))
    return (chunks.join(numbered, ["_hash", "_chunk"], "left")
            .groupBy("_row", "_key", "_sha")
            .agg(F.sort_array(F.collect_list(F.when(F.col("_hash").isNotNull(), F.struct(
                "_pos", "_hash", F.coalesce("_n", F.lit(0)).alias("_n"))))).alias("_recipe"))
            .drop("_row"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hash_bits: int = 64, sizes: tuple[int, int, int] = (2048, 512, 8192)) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after every run of the six white-space
    bytes is replaced by one space; null counts as empty, and empty texts form one
    group (of the empty recipe). The row with the smallest id of a group stays; rows
    repeated under that same id share its decision. Null ids count as larger than
    all others; in a group of null ids only, ``keep_id`` is null and the rows are
    kept. An empty table gives an empty result. Only the two named columns are
    read, so extra columns of any name do no harm.

    ``sizes`` are the average (a power of two), shortest and longest chunk.
    ``hash_bits`` shortens the chunk hash; the result stays exact, as chunks that
    share a hash are told apart by their bytes (tests use it).
    """
    text = F.regexp_replace(text_of(text_col), SPACE_CLASS, " ")
    texts = docs.select(F.col(id_col).cast("long").alias("_key"), text.cast("binary").alias("_text"),
                        F.sha2(text.cast("binary"), 256).alias("_sha"))

    # every distinct chunk once; a hash that stands for several byte strings is shared
    chunks = _chunked(texts, True, hash_bits, sizes).select(F.explode(F.arrays_zip("_hash", "_chunk")).alias("_c"))
    distinct = chunks.select("_c._hash", "_c._chunk").distinct()
    shared = distinct.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_hash")
    shared = materialize(shared, "shared-chunk-hashes")
    if shared.isEmpty():  # each hash is verified: it stands for one byte string, and is its identifier
        recipes = _chunked(texts, False, hash_bits, sizes).withColumnRenamed("_hash", "_recipe")
    else:
        recipes = _told_apart(texts, shared, hash_bits, sizes)
    recipes = materialize(recipes, "recipes")

    groups = recipes.groupBy(F.col("_recipe").alias("_group")).agg(
        F.min("_key").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # a group may hold a third of all rows: between two written tables AQE can split its partition
    groups = materialize(groups, "recipe-groups")
    out = recipes.join(groups, F.col("_recipe") == F.col("_group"))
    return out.select(F.col("_key").alias(id_col), "keep_id", "group_size",
                      F.coalesce(F.col("_key") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
                      F.col("_sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per group of equal texts, with all its columns, whatever their names: that of the smallest id, null ids
    last. Of rows repeated under that id (a table loaded twice), or of a group of null ids only, the first by text and content stays.
    An empty table stays empty."""
    keep = materialize(exact_duplicates(docs, id_col, text_col).filter("kept").groupBy(
        F.col(id_col).alias("_keep"), F.col("text_sha256").alias("_keep_sha")).agg(F.count(F.lit(1)).alias("_copies")), "kept-texts")
    sha = F.sha2(F.regexp_replace(text_of(text_col), SPACE_CLASS, " ").cast("binary"), 256)
    rows = shielded(docs, _id=F.col(id_col).cast("long"), _sha=sha)
    match = F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_sha") == F.col("_keep_sha"))
    kept = rows.join(keep.filter("_copies = 1"), match, "left_semi").select("_row.*")
    several = keep.filter("_copies > 1")
    if several.isEmpty():
        return kept
    return kept.union(one_per(rows.join(several, match, "left_semi"), ["_id", "_sha"], text_col).select("_row.*"))
