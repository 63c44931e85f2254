import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm.suffix_dedup import BlindTrie, equal_runs, kept_pieces, remove_repeats, window_minima

from .brute import DOCS, awkward_documents, repeats_removed


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()}


@pytest.mark.parametrize("hot_segments", [8_000, 2])
def test_matches_brute_force(spark, hot_segments):
    rows = awkward_documents()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert result(remove_repeats(docs, hot_segments=hot_segments)) == repeats_removed(rows)


def test_runs_of_one_byte_and_matches_at_the_limit(spark):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdef") for _ in range(100))
    rows = [(1, shared + "1"), (2, "2" + shared), (3, shared[:99] + "!"), (4, "z" * 250), (5, "z" * 99), (6, "y" + "z" * 100)]
    assert result(remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == repeats_removed(rows)


def test_repeated_and_null_ids_and_empty_table(spark):
    text = " ".join(str(i) for i in range(200))
    docs = spark.createDataFrame([(2, text, 1), (2, text, 2), (None, text, 3), (1, "short", 4), (9, None, 5)],
                                 "doc_id long, text string, kept int")
    out = sorted((r["doc_id"] or 99, r["n_removed"], r["n_spans"], len(r["kept"])) for r in remove_repeats(docs).collect())
    n = len(text)
    assert out == [(1, 0, 0, 5), (2, 0, 0, n), (2, n, 1, 0), (9, 0, 0, 0), (99, n, 1, 0)]
    assert remove_repeats(docs.limit(0)).collect() == []


def test_many_repeated_rows_and_texts_of_one_id(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdef") for _ in range(150)) for _ in range(4)]
    rows = [(None, texts[i % 4]) for i in range(60)] + [(i, texts[3] + str(i)) for i in range(6)] + [(3, texts[0]), (3, texts[1])]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(out) == len(rows)
    # the texts first met (ids 0 and 3, then the one text that only null ids have) stay once, all others go but for their digit
    assert sum(bytes(r["kept"]) == t.encode() for r in out for t in texts[:3]) == 3
    assert sum(r["n_removed"] == 150 for r in out if r["doc_id"] is None) == 59
    assert sorted(r["n_removed"] for r in out if r["doc_id"] is not None) == [0, 0, 0, 150, 150, 150, 150, 150]


def test_equal_runs_group_equal_windows_of_one_group():
    rng = random.Random(1)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(300)) * 3 + b"x" * 150, np.uint8)
    for length in (12, 32, 40, 100):
        starts = np.arange(len(data) - length + 1)
        group = starts % 2
        classes = equal_runs(data, starts, group, length)
        seen = {}
        for s, g, c in zip(starts, group, classes):
            seen.setdefault((g, data[s: s + length].tobytes()), set()).add(c)
        assert all(len(c) == 1 for c in seen.values())
        assert len({next(iter(c)) for c in seen.values()}) == len(seen)


def test_blind_trie_orders_strings():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(400)]
    trie = BlindTrie()
    for i, s in enumerate(strings):
        trie.add(s, i)
    groups = list(trie.groups())
    assert [strings[g[0]] for g in groups] == sorted(set(strings))
    assert all(len({strings[i] for i in g}) == 1 for g in groups) and sum(map(len, groups)) == 400


def test_window_minima_and_cutting():
    keys = np.random.default_rng(0).integers(0, 1 << 40, 1000).astype(np.uint64)
    assert (window_minima(keys, 77) == np.lib.stride_tricks.sliding_window_view(keys, 77).min(1)).all()
    assert kept_pieces(b"0123456789", [(6, 8), (1, 3), (3, 4), (2, 3)]) == ([b"0", b"45", b"89"], 5, 2)
