import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from churnlens.llm.common import _BASE, _BYTE_VALUES, read_table
from churnlens.llm.queries import QUERIES
from churnlens.llm.quality import features, fit_quality, keep_quality, score_quality, train_ftrl

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    weights = fit_quality(docs, labels)
    out = score_quality(docs, weights)
    rows = out.join(labels, "doc_id").collect()
    test = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert len(test) > 80 and np.mean([r["predicted"] == r["quality"] for r in test]) >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    # the fit sees no held-out label
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.allclose(fit_quality(docs, flipped), weights)
    kept = keep_quality(docs, weights)
    assert kept.columns == docs.columns
    assert {r[0] for r in kept.select("doc_id").collect()} == {r["doc_id"] for r in out.filter("predicted = 1").collect()}


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "word", "z"), (4, "w " * 400_000, "v"), (4, "w", "u")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    weights = fit_quality(docs, labels)
    out = score_quality(docs, weights).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (1, 2)}) == 1
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [False]
    assert keep_quality(docs, weights).columns == docs.columns
    none = fit_quality(docs, labels.limit(0))
    assert not none.any() and {r["predicted"] for r in score_quality(docs, none).collect()} == {1}
    assert score_quality(docs.limit(0), none).collect() == []


def test_features_are_the_same_in_any_block_and_for_long_texts():
    a, b = b"One two two three!", ("lorem ipsum " * 500_000).encode()
    both = np.frombuffer(a + b, np.uint8)
    starts, place, values = features(both, np.array([0, len(a), len(a) + len(b)]))
    for text, lo, hi in ((a, starts[0], starts[1]), (b, starts[1], starts[2])):
        s, p, v = features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert (p == place[lo:hi]).all() and np.allclose(v, values[lo:hi])


def test_ftrl_learns_a_word():
    texts = [(b"good text here" if i % 2 else b"bad text here") for i in range(60)]
    w = train_ftrl(texts, np.array([i % 2 for i in range(60)], float))
    score = lambda t: (lambda s, p, v: w[p] @ v)(*features(np.frombuffer(t, np.uint8), np.array([0, len(t)])))
    assert score(b"good text here") > 1 > -1 > score(b"bad text here")


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % 2**64
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def plain_features(text, bits=18):
    """{place: value} of a text, word by word."""
    b = [int(x) for x in _BYTE_VALUES]
    seen, before = Counter(), None
    for w in re.findall(rb"[^\x20\x09-\x0D]+", text):
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
        word = (plain_mix((sum(b[c] * pow(_BASE, i, 2**64) for i, c in enumerate(low)) + len(low)) % 2**64) if len(low) <= 128
                else int.from_bytes(hashlib.blake2b(low, digest_size=8).digest(), "little"))
        kinds = [16 if c >= 128 else 1 if 97 <= c <= 122 else 2 if 65 <= c <= 90 else 4 if 48 <= c <= 57 else 8 for c in w]
        shape = 0
        for k in kinds:
            shape |= k
        shape = (shape * 512 + (w[-1] if kinds[-1] == 8 else 0)) * 2 + (kinds[0] == 2)
        found = [word, shape * b[5] + b[6], (before is not None and before[0] == word) * b[8] + b[9]]
        if before is not None:
            found += [before[0] * b[1] + word * b[2], before[1] * b[3] + shape * b[4] + b[7]]
        seen.update(max(1, plain_mix(x % 2**64) >> 64 - bits) for x in found)
        before = (word, shape)
    size = math.sqrt(sum(math.log(1 + n) ** 2 for n in seen.values()))
    return {0: 1.0, **{place: math.log(1 + n) / size for place, n in seen.items()}}


def test_query_equals_plain_features_training_and_scores(spark):
    small = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: plain_features((r["text"] or "").encode()) for r in read_table(spark, small, "documents").collect()}
    judged = {}
    for r in read_table(spark, small, "labels").collect():
        if r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["doc_id"] in docs:
            judged[r["doc_id"]] = max(judged.get(r["doc_id"], 0), r["quality"])
    assert len(judged) > 50
    z, n = Counter(), Counter()
    weight = lambda i: -z[i] / (1.0 + math.sqrt(n[i]) + 0.01)
    for _ in range(min(20, max(4, -(-20_000 // len(judged))))):
        for d in sorted(judged, key=plain_mix):
            p = 1 / (1 + math.exp(-sum(weight(i) * x for i, x in docs[d].items())))
            for i, x in docs[d].items():
                g = (p - judged[d]) * x
                step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) * weight(i)
                z[i], n[i] = z[i] + g - step, n[i] + g * g
    got = {r["doc_id"]: r["score"] for r in QUERIES["op2_quality_classifier"](spark, small).collect()}
    assert got.keys() == docs.keys()
    want = {d: 1 / (1 + math.exp(-sum(weight(i) * x for i, x in f.items()))) for d, f in docs.items()}
    assert max(abs(got[d] - want[d]) for d in docs) < 1e-4
