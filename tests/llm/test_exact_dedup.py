import numpy as np
import pytest

from churnlens.llm.exact_dedup import cut_points, drop_exact_duplicates, exact_duplicates

from .brute import DOCS, awkward_documents, exact_groups


def result(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("hash_bits", [64, 3])
def test_matches_brute_force_also_when_chunk_hashes_collide(spark, hash_bits):
    rows = awkward_documents()
    docs = spark.createDataFrame(rows, DOCS)
    assert result(exact_duplicates(docs, hash_bits=hash_bits, sizes=(64, 16, 256))) == exact_groups(rows)


def test_chunks_cover_the_text_and_follow_its_content():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 3 << 20).astype(np.uint8)
    cuts = cut_points(text)
    sizes = np.diff([0, *cuts])
    assert cuts[-1] == len(text) and sizes.max() <= 8192 and sizes[:-1].min() >= 512
    shifted = cut_points(np.concatenate([text[:100], text]))
    assert len(set(c + 100 for c in cuts) & set(shifted)) > 0.95 * len(cuts)
    assert cut_points(text[:0]) == [] and cut_points(text[:5]) == [5]


def test_null_ids_repeated_rows_extra_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a  b", 1), (3, "a b", 2), (3, "a b", 3), (None, "q", 4), (7, None, 5), (6, "", 6)],
                                 "doc_id long, text string, _key int").withColumnRenamed("_key", "keep_id")
    got = sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"], r["kept"]) for r in exact_duplicates(docs).collect())
    assert got == [(-1, -1, 1, True), (-1, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (6, 6, 2, True), (7, 6, 2, False)]
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or -1, r["keep_id"]) for r in kept.collect()) == [(-1, 4), (3, 2), (6, 6)]
    assert exact_duplicates(docs.limit(0)).collect() == []
