"""Tasks follow the size of the input; a stricter session keeps its settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens.session import bound_tasks
from churnlens.sources.tables import file_bytes

KEYS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")


def test_more_input_makes_more_tasks(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in KEYS}
    try:
        bound_tasks(spark, 1 << 20)
        assert spark.conf.get(KEYS[0]) == before[KEYS[0]]
        bound_tasks(spark, 6 << 30)
        assert int(spark.conf.get(KEYS[0])) == 1536
        wide = spark.range(10).repartition(F.col("id"))
        assert "1536" in wide._jdf.queryExecution().executedPlan().toString()
        bound_tasks(spark, 1 << 20)  # other frames of the session may still need them
        assert int(spark.conf.get(KEYS[0])) == 1536
        assert [spark.conf.get(k) for k in KEYS[1:]] == ["16777216b", "33554432b"]
        spark.conf.set(KEYS[1], "16k")
        bound_tasks(spark, 1 << 20)
        assert spark.conf.get(KEYS[1]) == "16k"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    assert file_bytes(spark, f"{tmp_path}/t") >= sum(f.stat().st_size for f in (tmp_path / "t").glob("part-*"))
