import random

import pytest
from tokenizers import Tokenizer

from churnlens.llm.streaming_bpe import (Merges, StreamingDecoder, StreamingEncoder, Transducer, bpe_round_trip, default_tokenizer,
                                         sufficient_lookahead)

from . import brute


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


def test_lookahead_of_small_lists():
    assert sufficient_lookahead([("a", "b")]) == 1
    # ab | c d: whether b joins a hangs on b alone; whether "ab" joins "cd" on c, d and what takes d away
    assert sufficient_lookahead([("d", "e"), ("a", "b"), ("c", "d"), ("ab", "cd")]) == 3
    with pytest.raises(ValueError):
        sufficient_lookahead([("a", "bc"), ("b", "c")])
    with pytest.raises(ValueError):
        sufficient_lookahead([("b", "c"), ("a", "b"), ("a", "bc"), ("ab", "c")])


def test_transducer_equals_whole_words_for_random_merge_lists():
    rng = random.Random(2)
    for _ in range(60):
        tokens, merges = list("abc"), []
        while len(merges) < 14:
            u, v = rng.choice(tokens), rng.choice(tokens)
            if u + v not in tokens and len(u + v) < 9:
                merges.append((u, v))
                tokens.append(u + v)
        merges_of = Merges.__new__(Merges)
        ids = {t: i for i, t in enumerate(tokens)}
        merges_of.inside = merges_of.last = {ord(c): ids[c] for c in "abc"}
        merges_of.pairs = {(ids[u], ids[v]): (r, ids[u + v]) for r, (u, v) in enumerate(merges)}
        merges_of.steps = {a << 24 | b: r << 24 | new for (a, b), (r, new) in merges_of.pairs.items()}
        merges_of.lookahead = sufficient_lookahead(merges)
        for _ in range(12):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 120))).encode()
            run, out = Transducer(merges_of, block=1), []
            for byte in word:
                out += run.feed(bytes([byte]))
                assert len(run.buffer) <= merges_of.lookahead + 9
            assert out + run.finish() == merges_of.merged([ids[chr(b)] for b in word])[0]


def test_encoder_equals_the_library_in_tiny_pieces(library):
    rng = random.Random(1)
    path = default_tokenizer()
    encoders = (StreamingEncoder(path), StreamingEncoder(path, piece=7, block=3))
    pool = list("aaabbehlmnrstdv'''!!!..  \t\ṇ́ΣσςİıſéàüK한글각日本1٣½<>|ͅ​\x1c\x85\xa0\U00010d50Ɤ")
    for i in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(60)))
        if i % 10 == 0:
            text += "<|endoftext|>" + text[:5]
        want = library.encode(text, add_special_tokens=False).ids
        assert all(e.encode(text) == want for e in encoders), repr(text)


@pytest.mark.parametrize("text", ["x" * 5000, "hahaha" * 900, "😂" * 700, "é" * 3000, "ha😂!" * 500, "the" * 70_000, "!" * 3000, "'" * 400, "1" * 999])
def test_words_of_any_length_and_their_decoding(library, text):
    path = default_tokenizer()
    want = library.encode(text, add_special_tokens=False).ids
    assert StreamingEncoder(path, piece=1000, block=50).encode(text) == want == StreamingEncoder(path).encode(text)
    machine = StreamingDecoder(path)
    parts = [machine.feed(want[i: i + 7]) for i in range(0, len(want), 7)]
    assert "".join(parts) + machine.finish() == library.decode(want, skip_special_tokens=False)
    surface = StreamingDecoder(path, surface=True)
    assert "".join([surface.feed([i]) for i in want]).replace(" ", "") == text


def test_documents_with_nulls_empties_repeats_clashes_and_long_texts(spark, library):
    rows = [*brute.awkward_documents(), (None, "null id", "en", "s", 1), (0, None, None, None, None), (0, None, None, None, None)]
    rows = [(*r, "mine") for r in rows]
    docs = spark.createDataFrame(rows, brute.DOCS + ", ids string").withColumnRenamed("lang", "_id").withColumnRenamed("source", "decoded")
    out = [(r["doc_id"], r["ids"], r["decoded"]) for r in bpe_round_trip(docs).collect()]
    want = []
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(repr, out)) == sorted(map(repr, want))
    assert bpe_round_trip(spark.createDataFrame([], brute.DOCS)).collect() == []


def test_query_equals_the_library(spark, library):
    import hashlib

    from churnlens.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = QUERIES["op11_bpe_streaming"](spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
