import math
import random

import numpy as np
import pytest

from churnlens.llm.hard_negatives import mine_hard_negatives, reference_directions, relabelled, score_bounds


def brute(rows, every=10):
    good = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None
                               and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0], r[2]), reverse=True):
        good[i] = (label, [math.floor(256 * float(np.float32(x))) for x in v])
    out = set()
    for a, (label, x) in good.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in good.items() if i != a and len(y) == len(x) > 0)
        for s, p, _ in [t for t in scored if t[2] == label][:5]:
            inside = [t for t in scored if t[2] != label and -30 * s <= -100 * t[0] <= -90 * s][:10]
            out |= {(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(inside)}
    return out


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("sizes", [(8192, 1024, 16), (30, 4, 3), (50, 7, 1)])
def test_matches_brute_force(spark, sizes):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.4) for c in centres[i % 4]], rng.choice((i % 4, 5))) for i in range(400)]
    rows += [(i, rows[i - 400][1], rng.randrange(3)) for i in range(400, 460)]  # ties
    rows += [(1000, None, 1), (1010, [1.0] * 7 + [None], 1), (1020, [float("nan")] * 8, 1), (1030, [float("inf")] * 8, 1), (1040, [1.0] * 8, None),
             (None, [1.0] * 8, 1), (1050, [0.0] * 8, 1), (1060, [0.0] * 8, 2), (1070, [], 1), (-10, [3.0] * 8, 1), (1080, [1.0, 2.0], 1),
             (1081, [1.0, 2.5], 1), (1082, [1.0, 0.5], 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = mine_hard_negatives(vectors, every=10, block_rows=sizes[0], anchor_rows=sizes[1], references=sizes[2])
    got = [tuple(r) for r in out.select(COLUMNS).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_repeats_clashing_names_and_empty(spark):
    rows = [(0, [1.0, 2.0], 1, "a"), (0, [1.0, 2.0], 1, "b"), (1, [1.0, 1.0], 1, "c"), (2, [0.5, 0.5], 2, "d"), (2, [0.5, 0.5], 2, "d")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string").selectExpr("*", "1 AS b", "2 AS q", "3 AS home")
    out = [tuple(r) for r in mine_hard_negatives(vectors).select(COLUMNS).collect()]
    assert out == [(0, 1, 1, 2, 256 * 256 * 3, 256 * 128 * 3)]
    assert mine_hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []
    nothing = spark.createDataFrame([(3, [1.0], 1), (4, None, None)], "vec_id long, embedding array<float>, label int")
    assert mine_hard_negatives(nothing).collect() == []


def test_large_values_go_by_integers(spark):
    rows = [(0, [3e6, 1.0], 1), (1, [2e6, 1.0], 1), (2, [1e6, 2.0], 2), (3, [1.5e6, -2.0], 2)]
    out = mine_hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert {tuple(r) for r in out.select(COLUMNS).collect()} == brute(rows, 100)


def test_bounds_hold_and_narrow():
    rng = np.random.default_rng(0)
    x = rng.integers(-300, 300, (500, 12)).astype(float)
    x[0] = 0
    refs = np.array(reference_directions(x[1:60].tolist(), 6))
    assert np.allclose(np.linalg.norm(refs, axis=1), 1)
    norms = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ refs.T / np.where(norms > 0, norms, 1)[:, None], -1, 1))
    for i in range(0, 500, 17):
        low, high = score_bounds(norms[i], angles[i], norms, angles)
        exact = x @ x[i]
        assert (low <= exact).all() and (exact <= high).all()
    assert (high < norms[i] * norms).mean() > 0.9
    assert reference_directions([[0, 0], [1, 0], [2, 0]], 4)[0].tolist() == [1.0, 0.0]


def test_labels_move_on_every_seventh_row(spark):
    vectors = spark.createDataFrame([(7, 9), (14, None), (5, 9), (None, 3)], "vec_id long, label int")
    assert [r["label"] for r in relabelled(vectors).collect()] == [0, None, 9, 3]
