"""Table targets and JSON reports."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from churnlens.plans.jobs import run_feature_engineering, run_validation
from churnlens.schemas import PANEL_REPORT_SCHEMA, VALIDATION_REPORT_SCHEMA
from churnlens.sources.parts import verify_row_count
from churnlens.sources.tables import TableTarget, read_report_json, write_report_json


def parcels(spark, n):
    """n rows of mixed types, one of them null."""
    return spark.range(n).select(F.col("id").alias("parcel"), F.sqrt("id").alias("weight"),
                                 F.when(F.col("id") % 3 != 0, F.concat(F.lit("to "), F.col("id"))).alias("address"))


def path():
    return tempfile.mkdtemp(prefix="tbl-") + "/t"


def test_what_is_written_is_read(spark):
    t = TableTarget(path())
    t.write(parcels(spark, 25))
    assert sorted(map(str, t.read(spark).collect())) == sorted(map(str, parcels(spark, 25).collect()))


def test_replace_leaves_the_last_frame_and_append_all(spark):
    replaced, appended = TableTarget(path(), mode="replace"), TableTarget(path(), mode="append")
    for n in (8, 0, 2):
        replaced.write(parcels(spark, n))
        appended.write(parcels(spark, n))
    assert replaced.read(spark).count() == 2 and appended.read(spark).count() == 10
    replaced.write(parcels(spark, 4).limit(0))
    assert replaced.read(spark).collect() == [] and replaced.read(spark).columns == ["parcel", "weight", "address"]


def test_a_table_of_many_partitions(spark):
    t = TableTarget(path())
    t.write(parcels(spark, 50_000).repartition(9))
    assert tuple(t.read(spark).agg(F.count("*"), F.sum("parcel"), F.count("address")).first()) == (50_000, 1_249_975_000, 33_333)


def test_readers_see_a_whole_table_while_it_is_replaced(spark):
    """A frame read before a replace, and reads after every step of one, hold one version."""
    t = TableTarget(path())
    t.write(parcels(spark, 30))
    before = t.read(spark)
    seen = []
    publish = t._publish

    def watched(session, version):
        seen.append(TableTarget(t.path).read(session).count())  # the new version is written, not yet shown
        publish(session, version)
        seen.append(TableTarget(t.path).read(session).count())
    t._publish = watched
    t.write(parcels(spark, 12))
    assert seen == [30, 12] and before.count() == 30
    with pytest.raises(Exception):
        t.write(parcels(spark, 5).select(F.raise_error(F.lit("broken")).alias("parcel")))
    assert t.read(spark).count() == 12


def test_errors(spark):
    with pytest.raises(ValueError):
        TableTarget(path(), mode="upsert")
    with pytest.raises(TypeError):
        TableTarget(path()).write([1, 2, 3])
    with pytest.raises(KeyError):
        TableTarget.from_config({"mode": "replace"})
    assert TableTarget.from_config({"path": "/x", "mode": "append"}).describe() == {
        "path": "/x", "mode": "append", "format": "parquet"}


def test_verify_never_raises(caplog):
    assert verify_row_count("t", 5, 5)["matches"]
    bad = verify_row_count("t", 4, 5)
    assert not bad["matches"] and bad["loaded_rows"] == 4


def test_jobs_write_reports_and_verify(spark, make_clean):
    from tests.test_snapshots import LINES, N, START, usable_months
    base = tempfile.mkdtemp(prefix="jobs-")
    clean_t = TableTarget(f"{base}/clean")
    clean_t.write(make_clean(LINES))
    panel_t = TableTarget(f"{base}/panel")
    out = run_feature_engineering(spark, clean_t, panel_t, f"{base}/fe.json", START, N)
    assert out["check"]["matches"] and out["report"]["rows_total"] == panel_t.read(spark).count() > 0
    back = read_report_json(spark, f"{base}/fe.json", PANEL_REPORT_SCHEMA).first()
    assert [p["snapshot_date"][:10] for p in back["per_snapshot"]] == [str(t.date()) for t in usable_months(LINES, START, N)]


def test_feature_job_raises_when_a_customer_is_missing_from_the_panel(spark, make_clean, monkeypatch):
    from churnlens.plans import jobs
    from tests.test_snapshots import LINES, N, START
    base = tempfile.mkdtemp(prefix="jobs-")
    clean_t = TableTarget(f"{base}/clean")
    clean_t.write(make_clean(LINES))
    whole = jobs.S.snapshot_panel
    monkeypatch.setattr(jobs.S, "snapshot_panel", lambda *a: whole(*a).filter("customer_id != '61'"))
    with pytest.raises(ValueError, match="population"):
        run_feature_engineering(spark, clean_t, TableTarget(f"{base}/panel"), f"{base}/fe.json", START, N)


def test_validation_job_counts(spark):
    from churnlens.schemas import RAW_SCHEMA
    from tests.test_clean import REF, raw_rows
    base = tempfile.mkdtemp(prefix="val-")
    raw_t = TableTarget(f"{base}/raw")
    raw_t.write(spark.createDataFrame(raw_rows(), RAW_SCHEMA))
    out = run_validation(spark, raw_t, TableTarget(f"{base}/clean"), f"{base}/vr.json", REF)
    rep = out["report"]
    assert (rep["source_rows"], rep["duplicate_rows_dropped"], rep["rows_without_customer_id_excluded"],
            rep["clean_transactions_rows"]) == (15, 2, 2, 11)
    assert rep["flags"]["has_null_invoice_date"] == 1
    assert out["check"]["matches"]
    stored = read_report_json(spark, f"{base}/vr.json", VALIDATION_REPORT_SCHEMA).first()
    assert stored["flags"]["is_cancellation"] == 1


def test_report_json_round_trip(spark):
    p = path()
    df = spark.createDataFrame([{"source_rows": 1, "duplicate_rows_dropped": 0,
                                 "rows_without_customer_id_excluded": 0, "clean_transactions_rows": 1,
                                 "reference_date_used": "2011-01-15T00:00:00",
                                 "flags": {"is_cancellation": 0, "has_non_positive_quantity": 0,
                                           "has_non_positive_price": 0, "has_null_invoice_date": 0,
                                           "has_future_invoice_date": 0}}], VALIDATION_REPORT_SCHEMA)
    write_report_json(df, p)
    assert read_report_json(spark, p, VALIDATION_REPORT_SCHEMA).collect() == df.collect()


def test_replace_from_its_own_table(spark):
    t = TableTarget(path())
    t.write(parcels(spark, 9))
    t.write(t.read(spark).filter("address IS NULL"))
    assert sorted(r["parcel"] for r in t.read(spark).collect()) == [0, 3, 6]


def test_missing_table_with_schema_reads_empty(spark):
    from churnlens.schemas import SNAPSHOT_SCHEMA
    t = TableTarget(path() + "/never_written", schema=SNAPSHOT_SCHEMA)
    back = t.read(spark)
    assert back.count() == 0 and back.schema == SNAPSHOT_SCHEMA


def test_a_store_assigned_key_is_left_out_on_read(spark):
    p = path()
    parcels(spark, 3).withColumn("_id", F.uuid()).write.parquet(p)
    assert TableTarget(p).read(spark).columns == ["parcel", "weight", "address"]


def test_partitioned_panel_keeps_naive_snapshot_dates_and_prunes(spark, make_clean):
    from churnlens.functions.columns import ntz
    from churnlens.plans import snapshots as S
    from churnlens.schemas import SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA
    from tests.test_snapshots import LINES, N, START
    panel, _, _ = S.build_customer_snapshots(make_clean(LINES), START, N)
    t = TableTarget(path(), schema=SNAPSHOT_SCHEMA, partition_by=["snapshot_date"], files_per_partition=2)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        t.write(panel)
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        back = t.read(spark)
        assert back.columns == SNAPSHOT_COLUMNS
        assert sorted(map(str, back.collect())) == sorted(map(str, panel.collect()))
        march = back.filter(F.col("snapshot_date") == ntz("2012-03-01"))
        assert "PartitionFilters: [isnotnull(snapshot_date" in march._jdf.queryExecution().executedPlan().toString()
        assert march.count() == panel.filter(F.col("snapshot_date") == ntz("2012-03-01")).count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_appends_that_gain_fields_are_read_whole(spark, tmp_path):
    target = TableTarget(str(tmp_path / "t"), mode="append")
    target.write(spark.createDataFrame([(1, "x")], "a int, b string"))
    target.write(spark.createDataFrame([(2.5, "y", 2)], "c double, b string, a int"))
    target.write(spark.createDataFrame([("z",)], "b string"))
    out = target.read(spark)
    assert out.columns == ["a", "b", "c"]
    assert sorted(out.collect(), key=lambda r: r["b"]) == [(1, "x", None), (2, "y", 2.5), (None, "z", None)]
    assert TableTarget(str(tmp_path / "t"), mode="append").read(spark).count() == 3  # by any reader of the table


@pytest.mark.parametrize("clash", ["a string", "A int", "a long", "b array<string>"])
def test_a_field_that_changes_is_refused_and_nothing_is_written(spark, tmp_path, clash):
    target = TableTarget(str(tmp_path / "t"), mode="append")
    target.write(spark.createDataFrame([(1, "x")], "a int, b string"))
    with pytest.raises(ValueError, match="clashes"):
        target.write(spark.createDataFrame([], clash + ", d int"))
    assert target.read(spark).columns == ["a", "b"] and target.read(spark).count() == 1


def test_a_table_of_earlier_appends_gains_fields_too(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "a int").write.parquet(path)
    spark.createDataFrame([(2, "n")], "a int, b string").write.mode("append").parquet(path)  # written without the fields file
    target = TableTarget(path, mode="append")
    assert target.read(spark).columns == ["a", "b"]
    target.write(spark.createDataFrame([(True,)], "c boolean"))
    assert target.read(spark).columns == ["a", "b", "c"] and target.read(spark).count() == 3


def test_nested_fields_and_a_declared_schema(spark, tmp_path):
    target = TableTarget(str(tmp_path / "n"), mode="append")
    target.write(spark.sql("SELECT 1 AS a, named_struct('x', 1) AS s"))
    with pytest.raises(ValueError):
        target.write(spark.sql("SELECT 1 AS a, named_struct('x', 1, 'y', 2) AS s"))
    declared = TableTarget(str(tmp_path / "d"), mode="append", schema=spark.createDataFrame([], "a int, b string").schema)
    declared.write(spark.createDataFrame([(1, "x")], "a int, b string"))
    with pytest.raises(ValueError):
        declared.write(spark.createDataFrame([(1, "x", 2)], "a int, b string, c int"))
    assert declared.read(spark).count() == 1
