"""Suffix-array dedup of repeated byte strings: anchors, then deep-shallow sorting.

A byte goes when a ``length``-byte string that also starts earlier covers it. Every such
string (a window) has an anchor, the place of the smallest hash among its
``anchor``-byte grams; equal windows have equal anchors at equal places. So only
windows whose anchor gram occurs twice in the corpus can repeat:

1. Anchors are hashed where the texts lie. Consecutive windows of one anchor form a
   segment. An anchor row holds the gram's hash, the segment's hash and its place.
2. Rows meet by gram. Of segments with equal bytes the earliest represents the rest,
   which are repeats as a whole. Grams with one distinct segment are done.
3. What is left (segments that share a gram but differ around it) is cut out of the texts
   and its windows are suffix-sorted: multikey quicksort on 8-byte digits to a shallow
   depth, where most windows are already alone, then blind tries for the groups that stay
   together. Windows that meet at one leaf are equal; all but the earliest are repeats.
4. Repeated spans return to their documents, are merged and cut out.

Grams whose segments are too many for one task have their windows dealt by content, so
that only equal windows share a key.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import materialize

from .common import _BASE, _BASE_INVERSE, _BYTE_VALUES, binary_values, blocks_of, map_arrow, mix64, powers, utf8

_PIECE = 1 << 22  # bytes of one text hashed at once
_BLOCK = 1 << 24  # bytes of texts whose equal segments meet before the shuffle
_LOC = 1 << 16    # place, left and run of an anchor in one number


_KNOWN: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of ``base``, kept for the texts to come up to a piece's length."""
    have = _KNOWN.get(base)
    if have is None or len(have) < n:
        have = powers(base, max(n, 1 << 16))
        if n <= _PIECE + 1024:
            _KNOWN[base] = have
    return have[:n]


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys, from running minima of blocks."""
    n = len(keys)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1: n])


def anchors(text: np.ndarray, length: int, gram: int):
    """(gram hash, segment hash, place, left, run) of a text's anchors: ``run`` windows start
    from place - left on and have their anchor at place."""
    n, width = len(text), length - gram + 1
    out = [[] for _ in range(5)]
    for low in range(0, max(0, n - length + 1), _PIECE):  # window starts low .. low + _PIECE - 1
        part = text[low: low + _PIECE + length - 1]
        m = len(part)
        total = np.zeros(m + 1, np.uint64)
        np.add.accumulate(_BYTE_VALUES[part] * _powers(_BASE, m), out=total[1:])
        down = _powers(_BASE_INVERSE, m)
        grams = mix64((total[gram:] - total[:-gram]) * down[: m - gram + 1])
        # ties of the leading 40 bits go to the leftmost place, whatever stands before the window
        keys = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
        place = (window_minima(keys, width) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        run = np.diff(np.append(first, len(place)))
        at = place[first]
        end = first + run - 1 + length
        seg = mix64((total[end] - total[first]) * down[first] + ((at - first) * 1024 + run).astype(np.uint64))
        for column, values in zip(out, (grams[at], seg, at + low, at - first, run)):
            column.append(values)
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]


_ROWS = "kind int, h long, seg long, doc long, loc long"


def _anchor_batch(kind, h, seg, doc, loc) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(h.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(doc, pa.int64()),
         pa.array(loc, pa.int64())], names=["kind", "h", "seg", "doc", "loc"])


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """kind 1: an anchor to compare; kind 0: one whose segment stands earlier in the same block
    of texts, a repeat for certain, under a key of its own so that it spreads."""
    def run(batches):
        for batch in batches:
            data, offsets = binary_values(batch.column(1))
            ids = batch.column(0).to_numpy()
            for lo, hi in blocks_of(offsets, _BLOCK):
                found = [[] for _ in range(4)]
                for i in range(lo, hi):
                    h, seg, place, left, windows = anchors(data[offsets[i]: offsets[i + 1]], length, gram)
                    if len(h):
                        for column, values in zip(found, (h, seg, np.full(len(h), ids[i]), (place * 256 + left) * 256 + windows)):
                            column.append(values)
                if not found[0]:
                    continue
                h, seg, doc, loc = (np.concatenate(c) for c in found)
                order = np.lexsort((loc, doc, seg, h))
                h, seg, doc, loc = h[order], seg[order], doc[order], loc[order]
                repeat = np.concatenate([[False], (h[1:] == h[:-1]) & (seg[1:] == seg[:-1])])
                h[repeat] = mix64((doc[repeat] * 1_000_003 + loc[repeat]).astype(np.uint64))
                yield _anchor_batch(np.where(repeat, 0, 1), h, seg, doc, loc)

    return map_arrow(docs, run, _ROWS)


def _meet(rows: DataFrame) -> DataFrame:
    """Sorted anchor rows -> kind 0 (repeated segments) and kind 1 (the earliest of each
    distinct segment, of grams that have several)."""
    def run(batches):
        gram = segment = None   # of the last row so far
        pending = None          # the only segment of the last gram so far, not yet given out
        for batch in batches:
            kind, h, seg, doc, loc = (batch.column(i).to_numpy() for i in range(5))
            done = kind == 0
            out = [[np.zeros(done.sum(), np.int32), h[done], seg[done], doc[done], loc[done]]]
            h, seg, doc, loc = h[~done], seg[~done], doc[~done], loc[~done]
            if len(h):
                new_h = np.concatenate([[gram is None or h[0] != gram], h[1:] != h[:-1]])
                new_seg = new_h | np.concatenate([[segment is None or seg[0] != segment], seg[1:] != seg[:-1]])
                rest = ~new_seg
                out.append([np.zeros(rest.sum(), np.int32), h[rest], seg[rest], doc[rest], loc[rest]])
                first = np.flatnonzero(new_seg)
                fh = h[first]
                group = np.cumsum(new_h)[first]  # 0: the gram of the batch before
                several = np.zeros(len(first), bool)
                several[1:] |= group[1:] == group[:-1]
                several[:-1] |= group[1:] == group[:-1]
                several |= group == 0
                if pending is not None and (group == 0).any():
                    out.append(pending)
                    pending = None
                if new_h.any():
                    pending = None
                    last = first[-1]
                    if new_h[last] and not several[-1]:  # alone as yet; the next batch may go on
                        pending = [np.ones(1, np.int32), h[last: last + 1], seg[last: last + 1], doc[last: last + 1], loc[last: last + 1]]
                take = first[several]
                out.append([np.ones(len(take), np.int32), fh[several], seg[take], doc[take], loc[take]])
                gram, segment = h[-1], seg[-1]
            kind, h, seg, doc, loc = (np.concatenate(c) for c in zip(*out))
            yield _anchor_batch(kind, h, seg, doc, loc)

    return map_arrow(rows, run, _ROWS)


# --- deep-shallow sorting ---------------------------------------------------------

class BlindTrie:
    """Strings of one length ordered by a trie that keeps branching places only. A string
    goes down blind, comparing the branching bytes alone, is compared with the leaf it
    comes to, and branches off where they first differ."""

    def __init__(self):
        self.root = None  # leaf: (string, members); node: [place, {byte: child}]

    def add(self, string: bytes, member: int) -> None:
        node, path = self.root, []
        if node is None:
            self.root = (string, [member])
            return
        while isinstance(node, list):
            path.append(node)
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        if node[0] == string:
            node[1].append(member)
            return
        differ = (int.from_bytes(node[0], "big") ^ int.from_bytes(string, "big")).bit_length()
        place = len(string) - (differ + 7) // 8
        above = None
        below = self.root
        for step in path:  # the first node beyond the place where they differ
            if step[0] >= place:
                break
            above, below = step, step[1].get(string[step[0]])
        leaf = (string, [member])
        if below is not None and isinstance(below, list) and below[0] == place:
            below[1][string[place]] = leaf
        else:
            fork = [place, {node[0][place]: below, string[place]: leaf}]
            if above is None:
                self.root = fork
            else:
                above[1][string[above[0]]] = fork

    def groups(self):
        """Lists of members of equal strings, in the order of the strings."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def equal_runs(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int, shallow: int = 32) -> np.ndarray:
    """Class of each window data[start: start + length] within its group: windows of equal bytes share
    a number, others have none in common; numbers of windows that stay together follow their
    order. Deep-shallow: windows are split on 8-byte digits down to ``shallow`` bytes,
    then each group still together is ordered by a blind trie."""
    n = len(starts)
    classes = np.zeros(n, np.int64)
    if n == 0:
        return classes
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    digits = np.zeros(len(data), np.uint64)
    for j in range(8):
        digits |= padded[j: j + len(data)] << np.uint64(56 - 8 * j)
    _, tied = np.unique(group, return_inverse=True)
    tied = tied.astype(np.int64)
    rows = np.arange(n)
    fresh = 0
    for depth in range(0, min(shallow, length), 8):
        digit = digits[starts[rows] + depth]
        if length - depth < 8:
            digit = digit >> np.uint64(8 * (8 - (length - depth)))
        order = np.lexsort((digit, tied))
        rows, digit, tied = rows[order], digit[order], tied[order]
        edge = np.concatenate([[True], (tied[1:] != tied[:-1]) | (digit[1:] != digit[:-1])])
        tied = np.cumsum(edge) - 1
        alone = edge & np.append(edge[1:], True)
        classes[rows[alone]] = fresh + np.arange(alone.sum())
        fresh += int(alone.sum())
        rows, tied = rows[~alone], tied[~alone]
        if not len(rows):
            return classes
    if length <= shallow:
        edge = np.concatenate([[True], tied[1:] != tied[:-1]])
        classes[rows] = fresh + np.cumsum(edge) - 1
        return classes
    # windows equal in all that is left are put together first: the tries see distinct strings
    rest = length - shallow
    total = np.zeros(len(data) + 1, np.uint64)
    np.add.accumulate(_BYTE_VALUES[data] * _powers(_BASE, len(data)), out=total[1:])
    at = starts[rows] + shallow
    hashes = (total[at + rest] - total[at]) * _powers(_BASE_INVERSE, len(data))[at]
    order = np.lexsort((hashes, tied))
    rows, tied, at = rows[order], tied[order], at[order]
    first = np.concatenate([[True], tied[1:] != tied[:-1]])
    for depth in [*range(0, rest - 7, 8), max(0, rest - 8)] if rest >= 8 else []:
        digit = digits[at + depth]
        first[1:] |= digit[1:] != digit[:-1]
    if rest < 8:
        first[:] = True
    string = np.cumsum(first) - 1
    heads, head_tied = at[first], tied[first]
    edge = np.concatenate([[True], head_tied[1:] != head_tied[:-1]])
    alone = edge & np.append(edge[1:], True)
    head_class = np.zeros(len(heads), np.int64)
    head_class[alone] = fresh + np.arange(alone.sum())
    fresh += int(alone.sum())
    several = np.flatnonzero(~alone)
    if len(several):
        body = data.tobytes()
        places = heads[several].tolist()
        cut = np.append(np.flatnonzero(edge[several]), len(several))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            trie = BlindTrie()
            for i in range(a, b):
                trie.add(body[places[i]: places[i] + rest], i)
            for members in trie.groups():
                head_class[several[members]] = fresh
                fresh += 1
    classes[rows] = head_class[string]
    return classes


_SEGMENTS = "g long, doc long, start long, body binary"


def _segments(texts: DataFrame, length: int) -> DataFrame:
    """(doc, z, places of (h, loc)) -> one row per segment with its bytes."""
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], []]
            size = 0
            for doc, z, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = unzip.decompress(z.as_py())
                for p in places:
                    place, left, windows = p["loc"] // _LOC, p["loc"] // 256 % 256, p["loc"] % 256
                    start = place - left
                    body = text[start: start + windows - 1 + length]
                    for column, value in zip(out, (p["h"], doc, start, body)):
                        column.append(value)
                    size += len(body)
                if size > 1 << 23:
                    yield _segment_batch(*out)
                    out, size = [[], [], [], []], 0
            yield _segment_batch(*out)

    return map_arrow(texts, run, _SEGMENTS)


def _segment_batch(g, doc, start, body) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()),
                                       pa.array(body, pa.binary())], names=["g", "doc", "start", "body"])


def _single_windows(segments: DataFrame, length: int) -> DataFrame:
    """Segments of one window each, under a key of their content."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                out: list[list] = [[], [], [], []]
                for r in batch.slice(lo, 4096).to_pylist():
                    for i in range(len(r["body"]) - length + 1):
                        window = r["body"][i: i + length]
                        key = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)
                        for column, value in zip(out, (key, r["doc"], r["start"] + i, window)):
                            column.append(value)
                yield _segment_batch(*out)

    return map_arrow(segments, run, _SEGMENTS)


def _repeated_windows(segments: DataFrame, length: int, most: int, chunk_rows: int = 4_000) -> DataFrame:
    """Segments sorted by (g, doc, start) -> (doc, start, end) spans of windows that stand
    earlier under the same key. Keys are taken in chunks of whole groups. Only windows dealt by
    content come in groups of more than ``most`` rows: there the first of each distinct window
    stands for those so far."""
    def spans(g, doc, start, body):
        data, offsets = binary_values(pa.array(body, pa.large_binary()))
        sizes = np.diff(offsets)
        windows = sizes - length + 1
        row = np.repeat(np.arange(len(g)), windows)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        classes = equal_runs(data, offsets[:-1][row] + inner, np.asarray(g, np.int64)[row], length)
        doc, at = np.asarray(doc, np.int64)[row], np.asarray(start, np.int64)[row] + inner
        order = np.lexsort((at, doc, classes))
        again = np.zeros(len(row), bool)
        again[order[1:]] = classes[order[1:]] == classes[order[:-1]]
        # runs of repeated windows in a segment, as spans
        hit = np.flatnonzero(again)
        edge = np.concatenate([[True], (row[hit][1:] != row[hit][:-1]) | (hit[1:] != hit[:-1] + 1)]) if len(hit) else np.zeros(0, bool)
        begin = hit[edge]
        end = hit[np.append(edge[1:], True)] if len(hit) else hit
        return pa.RecordBatch.from_arrays([pa.array(doc[begin]), pa.array(at[begin]), pa.array(at[end] + length)],
                                          names=["doc", "start", "end"]), row, inner, again

    def run(batches):
        held: list[list] = [[], [], [], []]
        for batch in batches:
            for lo in range(0, batch.num_rows, chunk_rows):
                part = batch.slice(lo, chunk_rows)
                for column, values in zip(held, part.columns):
                    column += values.to_pylist()
                g = held[0]
                if len(g) < chunk_rows:
                    continue
                cut = len(g)
                while cut and g[cut - 1] == g[-1]:
                    cut -= 1
                if cut:
                    yield spans(*[c[:cut] for c in held])[0]
                    held = [c[cut:] for c in held]
                if len(held[0]) > most:
                    found, row, inner, again = spans(*held)
                    yield found
                    keep = np.flatnonzero(~again)
                    r, i = row[keep].tolist(), inner[keep].tolist()
                    held = [[held[0][0]] * len(keep), [held[1][x] for x in r], [held[2][x] + y for x, y in zip(r, i)],
                            [held[3][x][y: y + length] for x, y in zip(r, i)]]
        if held[0]:
            yield spans(*held)[0]

    return map_arrow(segments, run, "doc long, start long, end long")


def _squeezed(docs: DataFrame) -> DataFrame:
    """(doc, z): texts compressed before they move."""
    def run(batches):
        for batch in batches:
            press = zstandard.ZstdCompressor(level=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([press.compress(t.as_py()) for t in batch.column(1)], pa.binary())], names=["doc", "z"])

    return map_arrow(docs, run, "doc long, z binary")


def kept_pieces(text: bytes, spans: list[tuple[int, int]]) -> tuple[list[bytes], int, int]:
    """(pieces left, bytes removed, maximal removed runs) of a text."""
    pieces, removed, runs, last = [], 0, 0, 0
    reach = -1
    for a, b in sorted(spans):
        if a > reach:
            pieces.append(text[last:a])
            runs += 1
            removed += b - a
            reach = last = b
        elif b > reach:
            removed += b - reach
            reach = last = b
    pieces.append(text[last:])
    return pieces, removed, runs


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = 24,
                   hot_segments: int = 8_000) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes left).

    Texts are their UTF-8 bytes, null empty; strings never cross documents. A byte goes if a
    ``length``-byte string that also starts earlier (in a smaller id, or earlier in the same document)
    covers it; strings are judged on the input. Texts shorter than ``length`` stay whole. Rows repeated
    under one id are documents of their own, in the order of their texts' SHA-256; null ids come last. An empty
    table gives an empty result; other columns are not read.

    Grams with more than ``hot_segments`` distinct segments have their windows dealt by content.
    """
    if not 1 <= gram <= length <= 255:
        raise ValueError("1 <= gram <= length <= 255")
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), utf8(text_col).alias("_text"))
    plain = docs.groupBy("_id").count().filter("count > 1 OR _id IS NULL").isEmpty()
    if plain:
        docs = docs.withColumn("doc", F.col("_id"))
    else:  # numbers of their own, in the order of (id, hash of the text)
        # the ranges are found from samples of these short keys, no text goes to the driver; the place of a row
        # in the input parts equal rows, so that many of them don't meet in one task
        key = ["_void", "_id", "_sha", "_place"]
        docs = docs.withColumns({"_void": F.col("_id").isNull(), "_sha": F.unhex(F.sha2("_text", 256)),
                                 "_place": F.monotonically_increasing_id()})
        docs = materialize(docs.repartitionByRange(*key).sortWithinPartitions(*key)
                           .withColumn("doc", F.monotonically_increasing_id()).drop("_void", "_sha", "_place"), "numbered")
    texts = docs.select("doc", "_text")

    rows = _anchor_rows(texts, length, gram).repartition("h").sortWithinPartitions("h", "seg", "doc", "loc")
    met = materialize(_meet(rows), "anchors")
    places = met.filter("kind = 1").groupBy("doc").agg(F.collect_list(F.struct("h", "loc")).alias("places"))
    segments = _segments(_squeezed(texts).join(places, "doc").select("doc", "z", "places"), length)
    segments = materialize(segments, "segments")
    hot = segments.groupBy("g").count().filter(F.col("count") > hot_segments).select("g")
    dealt = segments.join(hot, "g", "left_anti").union(
        _single_windows(segments.join(hot, "g", "left_semi").select("g", "doc", "start", "body"), length))
    sorted_ = dealt.repartition("g").sortWithinPartitions("g", "doc", "start")
    place = F.floor(F.col("loc") / _LOC) - F.floor(F.col("loc") / 256) % 256
    whole = met.filter("kind = 0").select("doc", place.alias("start"), (place + F.col("loc") % 256 - 1 + length).alias("end"))
    spans = whole.union(_repeated_windows(sorted_, length, hot_segments)).groupBy("doc").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out: list[list] = [[], [], [], []]
                for z, found in zip(part.column(1), part.column(2).to_pylist()):
                    text = unzip.decompress(z.as_py())
                    pieces, removed, runs = kept_pieces(text, [(s["start"], s["end"]) for s in found or ()])
                    for column, value in zip(out, (len(text), removed, runs, b"".join(pieces))):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())],
                                                 names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    packed = _squeezed(texts).join(spans, "doc", "left").select("doc", "z", "spans")
    out = map_arrow(packed, cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    out = out.withColumn("_id", F.col("doc")) if plain else out.join(docs.select("doc", "_id"), "doc")
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
