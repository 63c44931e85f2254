"""BPE encoding by a streaming transducer with bounded lookahead, and incremental decoding.

The transducer reads the symbols of one word (a pre-token) from left to right, keeps a
bounded buffer and emits tokens once no later symbol can change them. How far a symbol
can reach back is computed from the merge list: whether the boundary before a symbol
disappears by the merge (u, v) depends on v, and on what lies behind v only if a
stronger merge takes the end of v away first. Such a merge starts with a piece that v
ends in while it is built, so every step of a chain of dependences has a smaller rank, and
the longest chain is found in one pass over the merges in order of rank.

Texts go through in pieces cut where neither normalisation nor the split into words
looks across, so nothing but the text itself and the result grows with its length.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, blocks_of, map_arrow, utf8

_PIECE = 1 << 16  # characters normalised at once
_BLOCK = 1 << 20  # bytes of texts per batch of results
_SHORT = 48  # symbols up to which a plain search for the next merge is faster than a heap
_AHEAD = 1024  # symbols gathered beyond the lookahead before the buffer is merged
_WORDS = 1 << 18  # words of a turn; a worker remembers the ids of those of two turns
_LONGEST_KNOWN = 64  # characters of such a word

# The normaliser and the splitting pattern that this transducer knows.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]

_SPLIT = regex.compile(WORD_PATTERN)
_SPLIT_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")  # the same for lower-case ASCII
_LETTERS, _MARKS, _SPACE = regex.compile(r"\p{L}+"), regex.compile(r"[^\s\p{L}\p{N}]+"), regex.compile(r"\s")
_SHADOW = {"letter": "a", "number": "1", "mark": "!", "space": " "}


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others from U+0100 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int:
    """Symbols behind a boundary that decide whether it stays, for a merge list whose tokens are all
    different and built before they are used (else ``ValueError``).

    The reach of a merge (u, v) is the length of v plus the longest reach of a smaller-ranked
    merge whose left part is v, or a piece that v ends in until the rank that swallows it.
    """
    rank: dict[str, int] = {}
    by_left: dict[str, tuple[list[int], list[int]]] = {}  # left part -> ranks, longest reach up to each
    longest = 0
    for r, (u, v) in enumerate(merges):
        if u + v in rank:
            raise ValueError(f"two merges build {u + v!r}")
        beyond, end, before = 0, v, r
        while True:
            ranks, reach = by_left.get(end, ((), ()))
            known = bisect_left(ranks, before)
            if known:
                beyond = max(beyond, reach[known - 1])
            if end not in rank:
                break
            before = rank[end]
            end = merges[before][1]
        length = len(v) - len(suffix) if suffix and v.endswith(suffix) else len(v)
        ranks, reach = by_left.setdefault(u, ([], []))
        ranks.append(r)
        reach.append(max(length + beyond, reach[-1] if reach else 0))
        longest = max(longest, reach[-1])
        rank[u + v] = r
    for r, pair in enumerate(merges):
        if any(rank.get(side, -1) >= r for side in pair):
            raise ValueError(f"merge {pair!r} uses a token that is built later")
    return longest


class Merges:
    """A merge list over bytes: ids of single bytes (inside and at the end of a word), what two
    neighbouring ids become, and the sufficient lookahead."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        alphabet = byte_alphabet()
        self.inside = [vocab[c] for c in alphabet]
        self.last = [vocab[c + suffix] for c in alphabet]
        self.pairs = {(vocab[u], vocab[v]): (r, vocab[u + v]) for r, (u, v) in enumerate(merges)}
        self.steps = {a << 24 | b: r << 24 | new for (a, b), (r, new) in self.pairs.items()}  # the same in plain numbers
        self.lookahead = sufficient_lookahead(merges, suffix)

    def short(self, ids: list[int]) -> list[int]:
        """The tokens of a few symbols."""
        get, none = self.steps.get, 1 << 62
        found = [get(a << 24 | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            ids[i] = new = best & 0xFFFFFF
            del ids[i + 1], found[i]
            if i < len(found):
                found[i] = get(new << 24 | ids[i + 1], none)
            if i:
                found[i - 1] = get(ids[i - 1] << 24 | new, none)
        return ids

    def merged(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """(tokens, where each ends) of a run of symbols: the smallest rank first, of equal ones the leftmost."""
        n = len(ids)
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        heap = [(*pairs[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        heap = [(r, i, new, a, b) for r, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged by now
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := pairs.get((new, ids[k]))) is not None:
                    heapq.heappush(heap, (found[0], i, found[1], new, ids[k]))
            if (h := before[i]) >= 0 and (found := pairs.get((ids[h], new))) is not None:
                heapq.heappush(heap, (found[0], h, found[1], ids[h], new))
        at = [i for i in range(n) if ids[i] >= 0]
        return [ids[i] for i in at], [after[i] for i in at]


class Transducer:
    """Tokens of one word, fed in parts. The buffer never holds more than the lookahead, a fixed
    block and the part just fed."""

    def __init__(self, merges: Merges, block: int = _AHEAD):
        self.merges, self.block = merges, block
        self.buffer: list[int] = []
        self.held: int | None = None  # the last byte: only the next one tells that the word goes on

    def feed(self, data: bytes) -> list[int]:
        """The tokens that are stable with ``data`` known."""
        out: list[int] = []
        for byte in data:
            if self.held is not None:
                self.buffer.append(self.merges.inside[self.held])
                if len(self.buffer) >= self.merges.lookahead + self.block:
                    out += self._stable()
            self.held = byte
        return out

    def _stable(self) -> list[int]:
        ids, ends = self.merges.merged(self.buffer)
        final = len(self.buffer) - self.merges.lookahead
        count = next((i for i, end in enumerate(ends) if end > final), len(ends))
        if count:
            self.buffer = self.buffer[ends[count - 1]:]
        return ids[:count]

    def finish(self) -> list[int]:
        """What is left, the word being at its end."""
        ids = [*self.buffer] + ([] if self.held is None else [self.merges.last[self.held]])
        self.buffer, self.held = [], None
        return self.merges.short(ids) if len(ids) <= _SHORT else self.merges.merged(ids)[0]

    def whole(self, data: bytes) -> list[int]:
        """The tokens of a word that is known whole; one within the lookahead and the block never emits before its end."""
        if len(data) <= self.block:
            inside = self.merges.inside
            self.buffer, self.held = [inside[b] for b in data[:-1]], data[-1]
            return self.finish()
        return self.feed(data) + self.finish()


class StreamingEncoder:
    """Ids of a ``tokenizers`` BPE file with end-of-word symbols, without special tokens added.

    The file must have the normaliser and splitting pattern above (else ``ValueError``). Added tokens in a
    text are their ids, as the library has it. Characters are compared once per worker with the
    library's own normaliser and splitter; where the Unicode versions of the two differ, the library's view
    of the character holds.
    """

    def __init__(self, path: str, piece: int = _PIECE, block: int = _AHEAD):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        steps = before.get("pretokenizers", [])
        known = (model.get("type") == "BPE" and not model.get("byte_fallback") and not model.get("ignore_merges")
                 and not model.get("continuing_subword_prefix") and model.get("dropout") is None
                 and (spec.get("normalizer") or {}).get("normalizers") == NORMALIZERS and len(steps) == 2
                 and steps[0].get("pattern") == {"Regex": WORD_PATTERN} and steps[0].get("behavior") == "Removed"
                 and steps[0].get("invert") is True and steps[1].get("type") == "ByteLevel"
                 and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex", True)
                 and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]))
        if not known:
            raise ValueError(f"{path} is no BPE file with the normaliser and pattern of this transducer")
        library = Tokenizer.from_file(path)
        self._normalize, self._split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self._added = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.piece, self.block = piece, block
        self._ids: dict[str, list[int]] = {}
        self._older: dict[str, list[int]] = {}
        self._plain: set[str] = set(map(chr, range(128)))
        self._odd: dict[int, str] = {}

    def encode(self, text: str) -> list[int]:
        return [i for part in self.stream(text) for i in part]

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of the text, piece by piece."""
        at = 0
        if self._added is not None and any(t in text for t in self.added):
            for hit in self._added.finditer(text):
                yield from self._section(text, at, hit.start())
                yield [self.added[hit.group()]]
                at = hit.end()
        yield from self._section(text, at, len(text))

    def _section(self, text: str, at: int, end: int) -> Iterator[list[int]]:
        word: Transducer | None = None
        more = None  # how an open word goes on
        while at < end:
            cut = self._cut(text, at, end)
            piece, shadow = self._prepared(text[at:cut])
            out: list[int] = []
            start = 0
            if word is not None:
                run = more.match(shadow)
                if run:
                    start = run.end()
                    out += word.feed(piece[:start].encode())
                if start < len(shadow):
                    out += word.finish()
                    word = None
            if start < len(shadow):
                if shadow is piece:
                    words = (_SPLIT_ASCII if piece.isascii() else _SPLIT).findall(shadow, start)
                else:
                    words = [piece[m.start(): m.end()] for m in _SPLIT.finditer(shadow, start)]
                goes_on = cut < end and not _SPACE.match(text[cut]) and words and (
                    _LETTERS.match(shadow[-1]) or _MARKS.match(shadow[-1]))
                last = words.pop() if goes_on else None
                for w in words:
                    known = self._ids.get(w)
                    out += self._word(w) if known is None else known
                if last is not None:
                    more = _LETTERS if _LETTERS.match(shadow[-1]) else _MARKS
                    word = Transducer(self.merges, self.block)
                    out += word.feed(last.encode())
            yield out
            at = cut
        if word is not None:
            yield word.finish()

    def _word(self, word: str) -> list[int]:
        ids = self._older.get(word) or Transducer(self.merges, self.block).whole(word.encode())
        if len(word) <= _LONGEST_KNOWN:
            if len(self._ids) >= _WORDS:  # words not met since the last turn are forgotten
                self._older, self._ids = self._ids, {}
            self._ids[word] = ids
        return ids

    def _cut(self, text: str, at: int, end: int) -> int:
        """End of the piece that starts at ``at``: before a white-space character, else inside a word where the
        character behind the cut joins with none before it and no apostrophe stands close; without
        either the piece grows."""
        limit = at + self.piece
        if limit >= end:
            return end
        cut = max(text.rfind(" ", at + 1, limit + 1), text.rfind("\n", at + 1, limit + 1))
        if cut > at:
            return cut
        for cut in chain(range(limit, at + 4, -1), range(limit + 1, end)):
            if "'" not in text[cut - 3: cut] and _starts_afresh(ord(text[cut])):
                return cut
        return end

    def _prepared(self, piece: str) -> tuple[str, str]:
        """(normalised text, the same with odd characters shown as their class)."""
        if piece.isascii():
            piece = piece.lower()
            return piece, piece
        letters = set(piece)
        if not letters <= self._plain:
            for c in letters - self._plain:
                self._learn(c)
        if self._odd and not letters.isdisjoint(map(chr, self._odd)):
            piece = self._normalize(piece)
            for c in set(piece) - self._plain:
                self._learn(c)
            return piece, piece.translate(self._odd)
        piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()  # no final sigma
        return piece, piece

    def _learn(self, c: str) -> None:
        if ord(c) in self._odd:
            return
        probes = [c]
        if unicodedata.combining(c):
            probes += ["xͅ" + c, "x" + c + "̴"]
        own = [_normalised(p) for p in probes]
        kind = self._kind(c)
        if unicodedata.category(c) != "Cn" and own == [self._normalize(p) for p in probes] and kind == _kind(c):
            self._plain.add(c)
        else:
            self._odd[ord(c)] = _SHADOW[kind]

    def _kind(self, c: str) -> str:
        parts = [span[1] - span[0] for _, span in self._split("a" + c + "!")]
        return {(2, 1): "letter", (1, 2): "mark", (1, 1, 1): "number", (1, 1): "space"}[tuple(parts)]


def _kind(c: str) -> str:
    return ("letter" if _LETTERS.match(c) else "number" if regex.match(r"\p{N}", c)
            else "space" if _SPACE.match(c) else "mark")


def _normalised(text: str) -> str:
    return regex.sub(r"\s+", " ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()


def _starts_afresh(code: int) -> bool:
    """Whether the character never joins with one before it in normalisation (a safe choice of ranges)."""
    return code < 0x300 or 0x370 <= code < 0x483 or 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xD7A4


class StreamingDecoder:
    """Ids to text, fed in parts: the state is what the next id needs (whether one came before) and
    the bytes of an unfinished character.

    As the library decodes a file without a decoder, tokens are joined by one space; with ``surface`` the bytes
    that tokens stand for are put together and an end of word becomes a space. Ids that
    the file does not hold are left out.
    """

    def __init__(self, path: str, surface: bool = False):
        self._parts, self._between = _byte_parts(path, surface)
        self._first = True
        self._text = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        parts = self._parts
        found = [parts[i] for i in ids if i in parts]
        if not found:
            return ""
        data = self._between.join(found)
        if not self._first:
            data = self._between + data
        self._first = False
        return self._text.decode(data)

    def finish(self) -> str:
        """The mark of an unfinished character, if one is left."""
        self._first = True
        return self._text.decode(b"", final=True)


@lru_cache(maxsize=2)
def _byte_parts(path: str, surface: bool) -> tuple[dict[int, bytes], bytes]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec.get("decoder") is not None:
        raise ValueError(f"{path} has a decoder of its own")
    tokens = {i: t for t, i in spec["model"]["vocab"].items()}
    added = {t["id"]: t["content"] for t in spec["added_tokens"]}
    if not surface:
        return {i: t.encode() for i, t in {**tokens, **added}.items()}, b" "
    of = {c: b for b, c in enumerate(byte_alphabet())}
    suffix = spec["model"].get("end_of_word_suffix") or ""

    def body(token: str) -> bytes:
        ended = bool(suffix) and token.endswith(suffix)
        return bytes(of[c] for c in (token[: -len(suffix)] if ended else token)) + (b" " if ended else b"")

    return {**{i: body(t) for i, t in tokens.items()}, **{i: t.encode() for i, t in added.items()}}, b""


@lru_cache(maxsize=1)
def _encoder(path: str) -> StreamingEncoder:
    return StreamingEncoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def bpe_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                   surface: bool = False) -> DataFrame:
    """One row per document: id, ``ids`` (array of int) and ``decoded`` (the text of the ids).

    Whole texts are encoded. Null text counts as empty; an empty or blank one has no ids and decodes to "".
    Null ids stay null, repeated rows are encoded each time they occur, an empty table gives an empty result. A text
    of any length goes through in pieces, so memory beyond the text and its ids is bounded. Bytes that are
    no UTF-8 count as U+FFFD. Only the two named columns are read. ``tokenizer`` is a path on every executor.
    """
    def run(batches):
        path = tokenizer or default_tokenizer()
        encoder = _encoder(path)
        for batch in batches:
            data, offsets = binary_values(batch.column(1))
            for i, j in blocks_of(offsets, _BLOCK):
                rows, decoded = [], []
                for r in range(i, j):
                    text = data[offsets[r]: offsets[r + 1]].tobytes().decode("utf-8", "replace")
                    ids, back, machine = [], [], StreamingDecoder(path, surface)
                    for part in encoder.stream(text):
                        ids += part
                        back.append(machine.feed(part))
                    back.append(machine.finish())
                    rows.append(pa.array(ids, pa.int32()))
                    decoded.append("".join(back))
                ends = [0]
                for ids in rows:
                    ends.append(ends[-1] + len(ids))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays([pa.array([], pa.int32()), *rows]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists, pa.array(decoded, pa.string())],
                                                 names=["_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), utf8(text_col).alias("_text"))
    return map_arrow(rows, run, "_id long, ids array<int>, decoded string").withColumnRenamed("_id", id_col)
