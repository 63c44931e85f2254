import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from churnlens.llm.common import read_table
from churnlens.llm.packing import Encoder, best_fit, cut_lengths, default_tokenizer, pack_documents

from .brute import DOCS, awkward_documents


def check(rows, out, capacity=1024):
    slow = Tokenizer.from_file(default_tokenizer())
    ids = {d: slow.encode(t or "", add_special_tokens=False).ids + [2] for d, t, *_ in rows}
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(ids)
    for d, found in pieces.items():
        found.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(len(found)))
        assert [r["length"] for r in found] == cut_lengths(len(ids[d]), capacity)
        at = 0
        for r in found:
            body = np.array(ids[d][at: at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(body)
            at += r["length"]
        assert at == len(ids[d])
    for found in sequences.values():
        found.sort(key=lambda r: r["offset"])
        at = 0
        for r in found:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(sequences), -(-sum(map(len, ids.values())) // capacity)


def test_pieces_sequences_and_bound(spark):
    rows = awkward_documents() + [(900, "<|endoftext|> in a text", "en", "s", 0), (901, "日本語 🙂 \x00 don't", "en", "s", 0)]
    used, least = check(rows, pack_documents(spark.createDataFrame(rows, DOCS)).collect())
    assert used <= least + 2


def test_real_documents_pack_tightly(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").filter("doc_id < 300")
    used, least = check([tuple(r) for r in docs.collect()], pack_documents(docs).collect())
    assert used <= 1.02 * least + 1


def test_many_groups_repeated_rows_null_ids_empty_table(spark):
    docs = spark.createDataFrame([(1, "a few words", 1)] * 30 + [(None, None, 2)], "doc_id long, text string, offset int")
    out = pack_documents(docs, group_rows=4).collect()
    assert len(out) == 31 and len({(r["sequence_id"], r["offset"]) for r in out}) == 31
    assert [r["length"] for r in out if r["doc_id"] is None] == [1]
    assert pack_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    rng = random.Random(0)
    lengths = np.array(sorted((rng.randint(1, 64) for _ in range(700)), reverse=True))
    bins, offsets = best_fit(lengths, 64, 3, 2500.0 + 64 ** 2 / 2, rule, (1.0, 0.5, 0.5))
    for b in set(bins.tolist()):
        mine = lengths[bins == b]
        assert mine.sum() <= 64 and len(mine) <= 3 and (mine.astype(float) ** 2).sum() <= 2500 + 2048
        assert sorted(offsets[bins == b].tolist()) == np.concatenate([[0], np.cumsum(mine)[:-1]]).tolist()
    loose, _ = best_fit(lengths, 64, 64, 64.0 ** 2, rule)
    assert loose.max() + 1 <= 1.02 * np.ceil(lengths.sum() / 64) + 1
    assert best_fit(np.zeros(0, int), 64, 3, 4096.0)[0].tolist() == []
    with pytest.raises(ValueError):
        best_fit(np.array([65]), 64, 3, 1e9)


def test_fast_ids_equal_the_tokenizers_ids():
    encode, slow = Encoder(default_tokenizer()), Tokenizer.from_file(default_tokenizer())
    assert encode.fast is not None
    rng = random.Random(7)
    alphabet = "abcdefghij ETAOIN  \n\t\r'.,!?-_0123456789éüñßçαβγ中文字日本🙂​  \x00\x7f"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert encode(text) == slow.encode(text, add_special_tokens=False).ids, repr(text)
    text = "<|endoftext|>x<|endoftext|>"
    assert encode(text) == slow.encode(text, add_special_tokens=False).ids


def test_only_longer_documents_are_cut():
    assert cut_lengths(1, 8) == [1] and cut_lengths(8, 8) == [8] and cut_lengths(9, 8) == [1, 8] and cut_lengths(24, 8) == [8, 8, 8]
