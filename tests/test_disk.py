"""What is written once leaves no shuffle files, and a job's source copy goes when the job holds its rows."""

from __future__ import annotations

import glob
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from churnlens.queries import QUERIES
from churnlens.session import drop_scratch, freed_shuffles, materialize, scratch_path, scratch_root
from churnlens.sources.tables import TableTarget


def _shuffle_files(spark) -> set[str]:
    jvm = spark.sparkContext._jvm
    files = jvm.scala.jdk.javaapi.CollectionConverters.asJava(jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())
    return {f.getName() for f in files if f.getName().startswith("shuffle_")}


def _left(spark, before: set[str], seconds: float = 10.0) -> set[str]:
    """Shuffle files that are still there; they are dropped in the background."""
    until = time.time() + seconds
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    counts = lambda: spark.range(5_000).groupBy((F.col("id") % 70).alias("k")).agg(F.count("*").alias("n"))
    frames = [counts() for _ in range(3)]  # held, so that no collection of garbage frees them
    before = _shuffle_files(spark)
    TableTarget(f"{tmp_path}/replaced").write(frames[0])
    TableTarget(f"{tmp_path}/appended", mode="append").write(frames[1])
    table = materialize(frames[2])
    assert _left(spark, before) == set() and table.count() == 70
    assert [sorted(f.collect()) == sorted(counts().collect()) for f in frames] == [True] * 3


def test_a_cached_frame_outlives_its_write(spark, tmp_path):
    frame = spark.range(5_000).groupBy((F.col("id") % 70).alias("k")).agg(F.count("*").alias("n")).cache()
    for i in range(2):
        TableTarget(f"{tmp_path}/t{i}").write(frame)
        assert frame.count() == 70 and TableTarget(f"{tmp_path}/t{i}").read(spark).agg(F.sum("n")).first()[0] == 5_000
    frame.unpersist()


def test_the_setting_is_restored(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), freed_shuffles(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError
    assert spark.conf.get(key) == before


def test_only_scratch_is_dropped(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert glob.glob(f"{path}*") == []
    spark.range(3).write.parquet(f"{tmp_path}/kept")
    with pytest.raises(ValueError):
        drop_scratch(spark, f"{tmp_path}/kept")
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 3


def test_the_exported_source_goes_after_ingestion(spark, tmp_path):
    tables = {
        "nation": (["n_nationkey int", "n_name string"], [(1, "X")]),
        "customer": (["c_custkey bigint", "c_nationkey int"], [(k, 1) for k in range(1, 8)]),
        "part": (["p_partkey bigint", "p_name string", "p_retailprice double"], [(k, f"part {k}", 2.5) for k in range(1, 5)]),
        "orders": (["o_orderkey bigint", "o_custkey bigint", "o_orderdate timestamp_ntz"],
                   [(k, 1 + k % 7, datetime(1995 + k % 6, 1 + k % 12, 1 + k % 28)) for k in range(1, 121)]),
        "lineitem": (["l_orderkey bigint", "l_partkey bigint", "l_quantity double", "l_returnflag string"],
                     [(k, 1 + j, float(k % 9 + 1), "R" if k % 4 == 0 else "N") for k in range(1, 121) for j in range(3)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, ", ".join(schema)).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    exports = f"{scratch_root(spark).removeprefix('file:')}/raw_export-*"
    before = set(glob.glob(exports))
    rows = {r["table"]: r for r in QUERIES["rowcount_check"](spark, str(tmp_path)).collect()}
    assert set(glob.glob(exports)) == before
    assert rows["raw_transactions"]["loaded_rows"] == 366 and all(r["matches"] for r in rows.values())  # two orders twice
    assert rows["customer_snapshots"]["loaded_rows"] > 0
