"""Plain Python forms of the operators, and awkward rows, for the tests."""

from __future__ import annotations

import hashlib
import random
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "Re", "sä", "ti", "Vo") for b in ("ba", "den", "fir", "gus", "hel", "")]


def sentence(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(VOCABULARY) for _ in range(words))


def edited(rng: random.Random, text: str, share: float) -> str:
    """The text with a share of its words replaced."""
    words = text.split(" ")
    for i in rng.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def awkward_documents(seed: int = 5, bases: int = 8) -> list[tuple]:
    """Texts with exact and near copies, shared passages, nulls, empties, one long text."""
    rng = random.Random(seed)
    passage = sentence(rng, 60)
    texts: list[str | None] = []
    for i in range(bases):
        base = sentence(rng, rng.choice((3, 7, 30, 80, 200)))
        texts += [base, base, base.replace(" ", "\t\n"), edited(rng, base, 0.01), edited(rng, base, 0.04),
                  f"{sentence(rng, 25)} {passage} {sentence(rng, 25)}"]
    texts += [None, None, "", " \t ", "one", "ONE", "a b c d e", "a b c d e f", "x" * 300, "x" * 450, "é" * 120]
    texts.append(sentence(rng, 4000))
    rng.shuffle(texts)
    return [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]


def exact_groups(rows):
    """doc_id -> (keep_id, group_size, kept, sha) for unique ids."""
    groups: dict[str, list[int]] = {}
    norm = {d: SPACE.sub(" ", t or "") for d, t, *_ in rows}
    for d, t in norm.items():
        groups.setdefault(t, []).append(d)
    return {d: (min(groups[t]), len(groups[t]), d == min(groups[t]), hashlib.sha256(t.encode()).hexdigest())
            for d, t in norm.items()}


def shingles(text: str | None, width: int = 5) -> frozenset:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i: i + width]) for i in range(len(words) - width + 1))


def jaccard_components(rows):
    """doc_id -> (n_shingles, component_id), every pair compared."""
    sets = {d: shingles(t) for d, t, *_ in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def repeats_removed(rows, length: int = 100):
    """doc_id -> (n_bytes, n_removed, n_spans, sha of the rest)."""
    seen, out = set(), {}
    for d, t, *_ in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i: i + length]
            if window in seen:
                gone[i: i + length] = b"\x01" * length
            seen.add(window)
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out
