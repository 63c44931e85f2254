import pytest

from churnlens.llm.mixing import mix_sources, mixed_documents, source_targets

from .brute import WORD


def water_fill(sizes: dict, weights=(1, 2, 3), cap=3.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = cap * sizes[s]
            open_.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5000, "c": 40, None: 10}, {"a": 10, "b": 1, "c": 1}, {"z": 7}, {"a": 0, "b": 9}])
def test_targets_are_water_filled(spark, sizes):
    rows = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = water_fill(sizes)
    assert {r["source"]: pytest.approx(r["target"]) for r in rows} == want


def documents(spark):
    rows = [(i, "w " * (i * 7 % 90) if i % 11 else None, None if i % 5 == 0 else "ABCD"[i % 4]) for i in range(800)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    rows, docs = documents(spark)
    got = mix_sources(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix_sources(docs.repartition(7)).collect()), key=str)
    size = {d: len(WORD.findall(t or "")) for d, t, _ in rows}
    total: dict = {}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        total.setdefault(r["source"], [0, r["target"], r["source_size"]])[0] += r["taken"]
    for taken, target, source_size in total.values():
        assert abs(taken - target) <= 2 * max(size.values()) and target <= 3 * source_size
    assert sum(t for _, t, _ in total.values()) == pytest.approx(sum(size.values()))


def test_the_mix_repeats_documents(spark):
    _, docs = documents(spark)
    docs = docs.withColumnRenamed("source", "_src").selectExpr("*", "_src as source", "1 as copies", "2 as size")
    copies = {r["doc_id"]: r["copies"] for r in mix_sources(docs).collect()}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: c for d, c in copies.items() if c}


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "s")] * 5 + [(None, "c", None), (2, None, "t")], "doc_id long, text string, source string")
    out = mix_sources(docs).collect()
    assert len(out) == 7 and mixed_documents(docs).count() == sum(r["copies"] for r in out)
    assert mix_sources(docs.limit(0)).collect() == [] and mixed_documents(docs.limit(0)).collect() == []
