"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Features of a text are its lower-cased words, word pairs, word shapes (character
classes and the closing mark), shape pairs and repeats of the word before, each
hashed to one of 2**bits places; a place's value is log(1 + count), the vector is
scaled to length one, and a bias is added. Training runs in a few shards of a
bounded labelled sample, whose weights are averaged; scoring is a sparse dot
product per document where it lies.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import _BYTE_VALUES, binary_values, blocks_of, hashed_words, map_arrow, mix64, ship, text_of

BITS = 18
_BLOCK = 1 << 19


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """crc32 of the id as text leaves ``fold`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _class_bits() -> np.ndarray:
    bits = np.full(256, 8, np.uint8)  # marks
    bits[48:58], bits[65:91], bits[97:123], bits[128:] = 4, 2, 1, 16
    bits[[9, 10, 11, 12, 13, 32]] = 0
    return bits


_CLASS = _class_bits()


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row starts, places, values) of a block of texts in compressed sparse rows; place 0
    is the bias, present in every row."""
    n = len(offsets) - 1
    words, start, end, row = hashed_words(data, offsets, lower=True)
    mask = np.uint64((1 << bits) - 1)
    keys = [np.arange(n, dtype=np.uint64) << np.uint64(bits)]
    if len(words):
        shape = np.bitwise_or.reduceat(_CLASS[data], start).astype(np.uint64)
        close = data[end - 1]
        shape = shape * np.uint64(512) + np.where(_CLASS[close] == 8, close, 0).astype(np.uint64)
        shape = shape * np.uint64(2) + (_CLASS[data[start]] == 2).astype(np.uint64)
        same_row = row[1:] == row[:-1]
        again = np.zeros(len(words), np.uint64)
        again[1:] = same_row & (words[1:] == words[:-1])
        b = _BYTE_VALUES
        pair = words[:-1] * b[1] + words[1:] * b[2]
        shape_pair = shape[:-1] * b[3] + shape[1:] * b[4]
        row = row.astype(np.uint64)
        for hashes, rows in ((words, row), (pair[same_row], row[1:][same_row]),
                             (shape * b[5] + b[6], row), (shape_pair[same_row] + b[7], row[1:][same_row]),
                             (again * b[8] + b[9], row)):
            place = mix64(hashes) >> np.uint64(64 - bits)
            keys.append((rows << np.uint64(bits)) | np.maximum(place, np.uint64(1)))
    found, counts = np.unique(np.concatenate(keys), return_counts=True)
    place = (found & mask).astype(np.int64)
    starts = np.searchsorted(found, np.arange(n + 1, dtype=np.uint64) << np.uint64(bits))
    values = np.log1p(counts)
    values[place == 0] = 0.0
    norm = np.sqrt(np.add.reduceat(values * values, starts[:-1])) if n else np.zeros(0)
    values /= np.repeat(np.where(norm > 0, norm, 1.0), np.diff(starts))
    values[place == 0] = 1.0
    return starts, place, values


def _blocks(column, bits: int):
    data, offsets = binary_values(column)
    for i, j in blocks_of(offsets, _BLOCK):
        yield features(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], bits)


def train_ftrl(texts: list[bytes], labels: np.ndarray, bits: int = BITS, min_updates: int = 20_000,
               alpha: float = 1.0, beta: float = 1.0, l1: float = 0.0, l2: float = 0.01) -> np.ndarray:
    """Weights after 4 to 20 passes in the given order, enough for ``min_updates`` updates if 20 do."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    epochs = min(20, max(4, -(-min_updates // max(1, len(texts)))))
    rows = []
    for starts, place, values in _blocks(pa.array(texts, pa.binary()), bits):
        rows += [(place[a:b].astype(np.int32), values[a:b].astype(np.float32)) for a, b in zip(starts[:-1], starts[1:])]

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for (at, x), y in zip(rows, labels):
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            more = ni + g * g
            z[at] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / alpha * w
            n[at] = more
    return weights(z, n)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", max_fit_rows: int = 20_000, shard_rows: int = 2_500, bits: int = BITS,
                **params) -> np.ndarray:
    """Weights learnt from labelled rows outside the held-out fold.

    At most ``max_fit_rows`` labelled ids are used, those of smallest hash, which
    bounds what is broadcast; they are trained in shards of some ``shard_rows``, so that no task
    holds more, and averaged. Scoring and all else cover every row. Null labels are ignored, an id labelled twice takes its larger label, an id
    repeated in ``docs`` its smallest text. Without labelled rows all weights are 0.
    """
    ids = F.col(id_col).cast("long")
    sample = (labels.select(ids.alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .filter(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
              .groupBy("_id").agg(F.max("_y").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_fit_rows))
    sample = materialize(sample, "labelled")
    shards = max(1, sample.count() // shard_rows)
    rows = (docs.select(ids.alias("_id"), text_of(text_col).cast("binary").alias("_text"))
            .join(F.broadcast(sample), "_id")  # max_fit_rows pairs of numbers
            .groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
            .withColumn("_shard", F.pmod(F.xxhash64("_id"), F.lit(shards))))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[np.argsort(mix64(pdf["_id"].to_numpy().astype(np.uint64)))]
        w = train_ftrl(pdf["_text"].tolist(), (pdf["_y"].to_numpy() > 0).astype(float), bits, **params)
        return pd.DataFrame({"rows": [len(pdf)], "weights": [w.astype(np.float32).tobytes()]})

    ship(docs.sparkSession)
    # one vector of 2**bits numbers per shard: a bound that the table's size doesn't enter
    trained = rows.groupBy("_shard").applyInPandas(train, "rows long, weights binary").collect()
    if not trained:
        return np.zeros(1 << bits, np.float32)
    share = np.array([r["rows"] for r in trained], float)
    parts = np.stack([np.frombuffer(r["weights"], np.float32) for r in trained])
    return (share @ parts / share.sum()).astype(np.float32)


def score_quality(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` in (0, 1), ``predicted``.

    The score depends on the whole text and nothing else. Null text counts as empty;
    an empty text has the score of the bias alone. Null ids stay null and are not held
    out. Repeated rows score alike. An empty table gives an empty result; only the
    two named columns are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(weights)  # 2**bits numbers
    bits = int(len(weights)).bit_length() - 1

    def run(batches):
        w = model.value
        for batch in batches:
            scores = [np.zeros(0)]
            for starts, place, values in _blocks(batch.column(1), bits):
                scores.append(np.add.reduceat(w[place] * values, starts[:-1]))
            p = 1.0 / (1.0 + np.exp(-np.clip(np.concatenate(scores), -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))],
                names=["_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).cast("binary").alias("_text"),
                       held_out(F.col(id_col).cast("long")).alias("held_out"))
    return map_arrow(rows, run, "_id long, held_out boolean, score double, predicted int").withColumnRenamed("_id", id_col)


def keep_quality(docs: DataFrame, weights: np.ndarray, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns; they are
    filtered where they lie. Null texts score as empty."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(len(weights)).bit_length() - 1
    at = docs.columns.index(text_col)
    floor = float(np.log(least / (1 - least)))

    def run(batches):
        w = model.value
        for batch in batches:
            totals = [np.add.reduceat(w[place] * values, starts[:-1])
                      for starts, place, values in _blocks(batch.column(at).cast(pa.large_binary()), bits)]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *totals]) >= floor))

    return map_arrow(docs, run, docs.schema)
