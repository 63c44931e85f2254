"""Vector best-fit packing of tokenised documents into sequences.

Documents are tokenised where they lie; from then on only piece rows (a few
numbers each) move. Pieces are dealt into groups of bounded size, and each
group is packed best-fit in decreasing order: a bin has residual capacities of
tokens, documents and attention cost (sum of squared lengths), and among the bins
that meet every constraint a piece takes the one chosen by residual norm or by
weighted dot-product. A group leaves at most a few bins part full, so dealing
costs a fraction of a percent of the bins.
"""

from __future__ import annotations

import json
import math
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import map_arrow, text_of

END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of a ``tokenizers`` file, without special tokens.

    A byte-level BPE file whose ids follow its merge order is also run by tiktoken
    with the same vocabulary as ranks, some five times faster. That is used only for
    texts that hold none of the file's added tokens, and only if both agree on
    a probe; everything else goes through ``tokenizers`` itself.
    """

    _PROBE = "Probe, it's 12,345 words: naïve  日本語 \n\n\t x y 🙂 don't WE'LL ---- foo_bar   "

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.fast = self._ranked(spec)
        if self.fast is not None and self.fast.encode_ordinary(self._PROBE) != self._plain(self._PROBE):
            self.fast = None

    def _plain(self, text: str) -> list[int]:
        return self.slow.encode(text, add_special_tokens=False).ids

    def _ranked(self, spec: dict):
        import public_tokenizers
        import tiktoken

        model = spec.get("model", {})
        before = spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") \
                or spec.get("normalizer"):
            return None
        # the byte-level alphabet: printable bytes stand for themselves, others are shifted
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(printable)]
        to_byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        added = set(self.added)
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        if any(c not in to_byte for t in vocab for c in t):
            return None
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.added):
            return self._plain(text)
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: whole if it fits, else pieces of ``capacity``, the
    first being what is left over."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def tokenised_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str | None) -> DataFrame:
    """One row per piece: id, piece, start, length, crc32 of its ids as little-endian
    unsigned 32-bit numbers. A document is its ids and one end id."""
    def run(batches):
        encode = encoder(tokenizer or default_tokenizer())
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):  # piece rows of 256 documents at a time
                part = batch.slice(lo, 256)
                out: list[list] = [[], [], [], [], []]
                for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = np.array([*encode(text.as_py()), END_ID], "<u4")
                    start = 0
                    for piece, length in enumerate(cut_lengths(len(ids), capacity)):
                        body = ids[start: start + length]
                        for column, value in zip(out, (key, piece, start, length, zlib.crc32(body.tobytes()))):
                            column.append(value)
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
        encoder.cache_clear()  # some 100 MB that a reused worker would hold through later stages

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_arrow(rows, run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int, max_documents: int, max_attention: float,
             rule: str = "norm", weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; ``lengths`` in decreasing order.

    A piece's demand is (tokens, 1 document, tokens squared), each as a share of the
    capacity. ``norm`` takes the feasible bin whose residual after placing has
    the smallest weighted norm, ``dot`` the one with the largest weighted product of demand and
    residual; ties go to the oldest bin. A piece that fits no bin opens one; one
    that alone breaks a constraint is an error.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule is 'norm' or 'dot', not {rule!r}")
    n = len(lengths)
    limits = np.array([capacity, max_documents, max_attention], float)
    w = np.asarray(weights, float)
    if n and (lengths[0] > capacity or max_documents < 1 or float(lengths[0]) ** 2 > max_attention):
        raise ValueError("a piece exceeds a capacity on its own")
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    whole = int(np.searchsorted(-lengths, -capacity, side="right"))  # pieces that fill a bin
    bins[:whole] = np.arange(whole)
    least = lengths[-1] if n else 0
    room = np.zeros((3, max(16, n - whole)))  # residuals of the open bins
    name = np.zeros(max(16, n - whole), np.int64)
    used, made = 0, whole
    for i in range(whole, n):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        r = room[:, :used]
        fits = np.flatnonzero((r[0] >= need[0]) & (r[1] >= need[1]) & (r[2] >= need[2]))
        if len(fits):
            left = (r[:, fits] - need[:, None]) / limits[:, None]
            if rule == "norm":
                at = fits[int(np.argmin(w @ (left * left)))]
            else:
                at = fits[int(np.argmax((w * need / limits) @ (r[:, fits] / limits[:, None])))]
        else:
            at, used = used, used + 1
            room[:, at], name[at] = limits, made
            made += 1
        bins[i], offsets[i] = name[at], capacity - room[0, at]
        room[:, at] -= need
        if i % 512 == 0:  # bins that not even the smallest piece fits are done
            keep = np.flatnonzero((room[0, :used] >= least) & (room[1, :used] >= 1))
            room[:, : len(keep)], name[: len(keep)] = room[:, keep], name[keep]
            used = len(keep)
    return bins, offsets


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
                   max_documents: int | None = None, max_attention: float | None = None, rule: str = "norm",
                   weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3), tokenizer: str | None = None,
                   group_rows: int = 12_000) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset``.

    Null text counts as empty; an empty document is its end id alone. A repeated row is
    packed each time it occurs. Null ids stay null. An empty table gives an empty
    result. Only the two named columns are read. Without limits of its own, a
    sequence may hold ``capacity`` documents and the attention cost of one whole document,
    which every set of pieces within the token capacity meets.

    ``tokenizer`` is the path of a ``tokenizers`` file on every executor.
    ``group_rows`` bounds the pieces packed together in one task.
    """
    documents = max_documents or capacity
    attention = float(max_attention or capacity ** 2)
    pieces = materialize(tokenised_pieces(docs, id_col, text_col, capacity, tokenizer), "pieces")
    groups = max(1, math.ceil(pieces.count() / group_rows))
    # dealt by row, not by id, so that rows repeated under one id spread as well
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["_group"].iloc[0])
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity, documents, attention, rule, weights)
        return rows.drop(columns="_group").assign(sequence_id=bins + (group << 32), offset=offsets)

    out = dealt.groupBy("_group").applyInPandas(pack, PIECES + ", sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", id_col)
