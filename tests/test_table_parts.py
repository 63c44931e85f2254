"""Tables laid out by month: one month replaced by reference, files by size, files sorted for readers of one customer."""

from __future__ import annotations

import glob
import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from churnlens.sources.tables import TableTarget

SCHEMA = "town string, visits long, month timestamp_ntz"


def visits(spark, months, n=10, add=0):
    rows = [(f"t{i}", i + add, datetime(2012, m, 1)) for m in months for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def target(spark, tmp_path, **kw):
    return TableTarget(f"{tmp_path}/t", schema=spark.createDataFrame([], SCHEMA).schema, partition_by=["month"], **kw)


def sums(df):
    return {r["month"].month: r["s"] for r in df.groupBy("month").agg(F.sum("visits").alias("s")).collect()}


def test_one_month_is_replaced_and_a_reader_sees_before_or_after(spark, tmp_path):
    t = target(spark, tmp_path)
    t.write(visits(spark, [1, 2, 3]))
    before = t.read(spark)
    seen, publish = [], t._publish

    def watched(session, version):
        seen.append(sums(target(spark, tmp_path).read(session)))  # written, not yet shown
        publish(session, version)
        seen.append(sums(target(spark, tmp_path).read(session)))
    t._publish = watched
    t.replace_parts(visits(spark, [2], add=100))
    assert seen == [{1: 45, 2: 45, 3: 45}, {1: 45, 2: 1045, 3: 45}]
    assert sums(before) == {1: 45, 2: 45, 3: 45}  # its files are kept
    assert t.read(spark).columns == ["town", "visits", "month"] and t.read(spark).schema == before.schema


def test_other_months_are_the_same_files(spark, tmp_path):
    t = target(spark, tmp_path)
    t.write(visits(spark, [1, 2, 3, 4]))
    old = set(t.read(spark).inputFiles())
    for step in range(1, 6):  # by far more versions than are kept whole
        t.replace_parts(visits(spark, [2, 5], add=step))
        now = set(t.read(spark).inputFiles())
        assert {f for f in old if "2012-02" not in f} < now
        assert sums(t.read(spark)) == {1: 45, 2: 45 + 10 * step, 3: 45, 4: 45, 5: 45 + 10 * step}
    versions = [v for v in os.listdir(f"{tmp_path}/t") if v.startswith("_v=")]
    assert len(versions) <= 3  # the first (referred to), the one before, the current one
    t.replace_parts(visits(spark, [1]).limit(0))
    assert sums(t.read(spark)) == {1: 45, 2: 95, 3: 45, 4: 45, 5: 95}
    t.write(visits(spark, [9]))
    assert sums(t.read(spark)) == {9: 45}


def test_month_folders_are_pruned_over_versions(spark, tmp_path):
    t = target(spark, tmp_path)
    t.write(visits(spark, [1, 2, 3]))
    t.replace_parts(visits(spark, [3, 4], add=1))
    one = t.read(spark).filter(F.col("month") == datetime(2012, 3, 1))
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()
    assert one.agg(F.sum("visits")).first()[0] == 55


def test_parts_of_a_new_table_and_a_write_that_dies(spark, tmp_path):
    t = target(spark, tmp_path)
    t.replace_parts(visits(spark, [1]).limit(0))
    assert t.read(spark).collect() == [] and t.read(spark).columns == ["town", "visits", "month"]
    t.replace_parts(visits(spark, [1, 2]))
    with pytest.raises(Exception):
        t.replace_parts(visits(spark, [2]).withColumn("visits", F.raise_error(F.lit("dies")).cast("long")))
    assert sums(t.read(spark)) == {1: 45, 2: 45}


def test_parts_are_refused_where_they_cannot_be_told(spark, tmp_path):
    for t in (TableTarget(f"{tmp_path}/a"), TableTarget(f"{tmp_path}/b", mode="append"),
              target(spark, tmp_path, mode="append"), TableTarget(f"{tmp_path}/c", partition_by=["month"])):
        with pytest.raises(ValueError):
            t.replace_parts(visits(spark, [1]))
    visits(spark, [1]).write.partitionBy("month").parquet(f"{tmp_path}/t")
    with pytest.raises(ValueError):
        target(spark, tmp_path).replace_parts(visits(spark, [1]))


def test_files_follow_the_size(spark, tmp_path):
    """One hot month is split over files of bounded size, small months have one file each."""
    hot = spark.range(300_000).select(F.sha2(F.col("id").cast("string"), 256).alias("town"), F.col("id").alias("visits"),
                                      F.lit(datetime(2012, 1, 1)).cast("timestamp_ntz").alias("month"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        t = target(spark, tmp_path)
        t.write(hot.repartition(16).unionByName(visits(spark, [2, 3, 4])))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {m: [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/t/_v=*/month=2012-{m:02d}*/*.parquet")] for m in (1, 2, 3, 4)}
    assert len(files[1]) >= 4 and max(files[1]) < 8 << 20
    assert all(len(files[m]) == 1 for m in (2, 3, 4))
    assert t.read(spark).count() == 300_030


def test_one_customer_skips_row_groups(spark, tmp_path):
    ids = spark.range(200_000).select(F.format_string("c%06d", F.pmod(F.col("id") * 7919, F.lit(20_011))).alias("town"),
                                      F.col("id").alias("visits"), F.lit(datetime(2012, 1, 1)).cast("timestamp_ntz").alias("month"))
    t = target(spark, tmp_path, files_per_partition=2, sort_by=["town"], options={"parquet.block.size": str(64 << 10)})
    t.write(ids)
    files = glob.glob(f"{tmp_path}/t/_v=*/month=*/*.parquet")
    assert len(files) == 2
    for f in files:
        meta = pq.ParquetFile(f).metadata
        spans = [(c.min, c.max) for c in (meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups))]
        assert len(spans) > 5 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))  # sorted: few groups can hold one value
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = t.read(spark).filter(F.col("town") == "c000777").select("town", "visits")
        got = one.collect()
        leaves = one._jdf.queryExecution().executedPlan().collectLeaves()
        read = leaves.apply(0).metrics().apply("numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(got) == ids.filter("town = 'c000777'").count() > 0
    assert 0 < read < 200_000 / 10
