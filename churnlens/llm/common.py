"""Helpers shared by the corpus operators: table reading, column shielding, word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import io
import os
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import churnlens
from churnlens.session import scratch_path, table_path

#: The six bytes that separate words in every contract here: space and \t \n \v \f \r.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application: as a zip in the
    shared folder, added like ``--py-files``. Workers need no path to the repository."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(churnlens.__file__))
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    target = sc._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "code") + "/churnlens.zip")
    stream = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(body.getvalue()))
    stream.close()
    sc.addPyFile(target.toString())
    _SHIPPED.add(sc.applicationId)


def release_memory() -> None:
    """Give freed memory of this process back to the machine: Python workers live on for later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers, which give their memory back at the end of a partition."""
    ship(df.sparkSession)

    def frugal(batches):
        yield from run(batches)
        release_memory()

    return df.mapInArrow(frugal, schema)


def shielded(df: DataFrame, **keys: Column) -> DataFrame:
    """(_row, keys...): the rows as one struct, so that no column of theirs meets a name of ours. ``keys`` are columns of ``df``."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in keys.items()])


def one_per(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Of shielded rows equal in ``keys`` (null meets null) the one that comes first by its text and then by its whole content:
    partial aggregates, so any number of copies may share a key."""
    order = F.struct(text_of(f"_row.`{text_col}`").alias("text"), F.to_json("_row", {"ignoreNullFields": "false"}).alias("all"))
    return rows.groupBy(*keys).agg(F.min_by("_row", order).alias("_row"))


def text_of(column: str = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: str = "text") -> Column:
    """The text's UTF-8 bytes, null as empty."""
    return text_of(column).cast("binary")


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``: separators are collapsed, so
    words are the remaining single spaces plus one, less those at the ends."""
    flat = F.regexp_replace(text, SPACE_CLASS, " ")
    trimmed = F.trim(flat)  # SQL trim removes plain spaces only
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.length(trimmed) - F.length(F.translate(trimmed, " ", "")) + 1).cast("long")


def binary_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes as uint8, n + 1 offsets) of a binary Arrow column, without a copy
    per value. Null values have length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def blocks_of(offsets: np.ndarray, limit: int):
    """Row ranges [i, j) of at most ``limit`` bytes each (one row at least), so that
    numpy work on a batch of texts stays bounded."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


# --- word hashing -----------------------------------------------------------------
# A word's hash is a polynomial over its bytes modulo 2**64, each byte first mapped to a random 64-bit
# value. Such polynomials have fixed collisions (the Thue-Morse words) from some hundred bytes on, so
# a word of more than _LONGEST_POLYNOMIAL bytes is hashed by blake2b instead.

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LONGEST_POLYNOMIAL = 128
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_BYTES = np.arange(256, dtype=np.uint8)
_LOWER_BYTES[65:91] += 32  # A-Z only
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1), modulo 2**64."""
    steps = np.full(n, np.uint64(base), np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_POWERS = powers(_BASE, _LONGEST_POLYNOMIAL)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer spreading every input bit over the 64 output bits (a bijection)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words never cross rows."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] |= inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] |= inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash, start, end, row) of every word in a block of texts."""
    start, end, row = word_spans(data, offsets)
    if len(start) == 0:
        return np.zeros(0, np.uint64), start, end, row
    length = end - start
    first = np.cumsum(length) - length  # of each word among the bytes of all words
    place = np.arange(int(length.sum()))
    inside = data[place + np.repeat(start - first, length)]
    if lower:
        inside = _LOWER_BYTES[inside]
    place -= np.repeat(first, length)
    np.minimum(place, _LONGEST_POLYNOMIAL - 1, out=place)
    hashes = mix64(np.add.reduceat(_BYTE_VALUES[inside] * _POWERS[place], first) + length.astype(np.uint64))
    for i in np.flatnonzero(length > _LONGEST_POLYNOMIAL).tolist():
        body = inside[first[i]: first[i] + length[i]].tobytes()
        hashes[i] = int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little")
    return hashes, start, end, row


def shingle_hashes(words: np.ndarray, row: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, row) of every ``width``-word shingle; a row of fewer words has its
    whole word sequence as one shingle. Not yet distinct."""
    counts = np.bincount(row, minlength=n_rows)
    ends = np.cumsum(counts)
    starts = ends - counts
    factors = [np.uint64(x) for x in _BYTE_VALUES[:width]]
    n = len(words)
    full = np.zeros(0, np.uint64)
    full_row = np.zeros(0, row.dtype)
    if n >= width:
        acc = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            acc += words[k: n - width + 1 + k] * factors[k]
        keep = row[: n - width + 1] == row[width - 1:]
        full, full_row = mix64(acc[keep]), row[: n - width + 1][keep]
    short = np.flatnonzero((counts > 0) & (counts < width))
    short_hash = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = counts[short] > k
        short_hash[has] += words[starts[short][has] + k] * factors[k]
    short_hash = mix64(short_hash + counts[short].astype(np.uint64))
    return np.concatenate([full, short_hash]), np.concatenate([full_row, short])


def hashed_words(data: np.ndarray, offsets: np.ndarray, lower: bool, limit: int = 1 << 22):
    """:func:`word_hashes` of a block; a text beyond ``limit`` bytes is hashed in pieces
    that end between words, so the temporaries stay bounded by the piece."""
    if len(data) <= limit or len(offsets) > 2:
        return word_hashes(data, offsets, lower)
    parts, at, n = [], 0, len(data)
    while at < n:
        end = min(n, at + limit)
        while end < n:
            spaces = np.flatnonzero(_IS_SPACE[data[end: end + limit]])
            if len(spaces):
                end += int(spaces[0])
                break
            end = min(n, end + limit)
        h, s, e, r = word_hashes(data[at:end], np.array([0, end - at]), lower)
        parts.append((h, s + at, e + at, r))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))
