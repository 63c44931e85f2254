"""Named source parts -> raw table and the ingestion job."""

from __future__ import annotations

import logging
import os
import tempfile
from datetime import datetime

import pytest

from churnlens.plans.jobs import run_ingestion
from churnlens.schemas import RAW_SCHEMA
from churnlens.sources.parts import load_parts, part_row_counts
from churnlens.sources.tables import TableTarget

SCHEMA = RAW_SCHEMA
NAMES = ("Year 2009-2010", "Year 2010-2011")


def _rows(n, start):
    return [(str(start + i), "A", "d", 1, datetime(2010, 1, 1 + i), 1.0, 17850.0, "UK") for i in range(n)]


@pytest.fixture
def part_dirs(spark):
    base = tempfile.mkdtemp(prefix="parts-")
    paths = {}
    for name, n, start in [(NAMES[0], 3, 100), (NAMES[1], 2, 200)]:
        p = os.path.join(base, name)
        spark.createDataFrame(_rows(n, start), SCHEMA).write.parquet(p)
        paths[name] = p
    return paths


def test_expected_parts_union_and_counts(spark, part_dirs):
    tagged, names, fallback = load_parts(spark, part_dirs, NAMES)
    assert names == list(NAMES) and not fallback
    counts = {r["part"]: r["rows"] for r in part_row_counts(tagged).collect()}
    assert counts == {NAMES[0]: 3, NAMES[1]: 2, "total": 5}
    assert [c for c in tagged.columns if not c.startswith("_")] == SCHEMA.names


def test_no_part_is_dropped_when_names_do_not_match(spark, caplog):
    parts = {str(y): spark.createDataFrame([(y,)], "col long") for y in (2009, 2010, 2011, 2012)}
    with caplog.at_level(logging.WARNING):
        tagged, names, fallback = load_parts(spark, parts, NAMES)
    assert fallback and names == list(parts)
    assert sorted(r["col"] for r in tagged.collect()) == [2009, 2010, 2011, 2012]
    assert any("all parts are read" in r.getMessage() for r in caplog.records)


def test_parts_left_out_are_named(spark, caplog):
    parts = {n: spark.createDataFrame([(1,)], "col long") for n in (*NAMES, "notes")}
    with caplog.at_level(logging.WARNING):
        _, names, fallback = load_parts(spark, parts, NAMES)
    assert names == list(NAMES) and not fallback
    assert any("left out" in r.getMessage() and "notes" in r.getMessage() for r in caplog.records)


def test_fewer_than_two_parts_raises(spark):
    with pytest.raises(ValueError):
        load_parts(spark, {"only": spark.createDataFrame([(1,)], "col long")}, NAMES)


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([(2,)], "a long")
    tagged, _, _ = load_parts(spark, {NAMES[0]: a, NAMES[1]: b}, NAMES)
    got = sorted((r["a"], r["b"]) for r in tagged.collect())
    assert got == [(1, "x"), (2, None)]


def test_ingestion_job_observes_counts_and_verifies(spark, part_dirs):
    target = TableTarget(tempfile.mkdtemp(prefix="raw-") + "/raw")
    out = run_ingestion(spark, part_dirs, NAMES, target)
    assert out["row_counts"] == {NAMES[0]: 3, NAMES[1]: 2, "total": 5}
    assert out["check"]["matches"] and out["check"]["loaded_rows"] == 5
    assert "_source_part" not in target.read(spark).columns


def test_csv_parts_with_declared_schema(spark):
    base = tempfile.mkdtemp(prefix="csvparts-")
    paths = {}
    for name, n, start in [(NAMES[0], 3, 100), (NAMES[1], 2, 200)]:
        p = os.path.join(base, name.replace(" ", "_"))
        spark.createDataFrame(_rows(n, start), SCHEMA).write.option("header", True).csv(p)
        paths[name] = p
    tagged, _, _ = load_parts(spark, paths, NAMES, fmt="csv", schema=SCHEMA, options={"header": "true"})
    counts = {r["part"]: r["rows"] for r in part_row_counts(tagged).collect()}
    assert counts == {NAMES[0]: 3, NAMES[1]: 2, "total": 5}
    row = tagged.filter("Invoice = '100'").first()
    assert row["Customer ID"] == 17850.0 and row["InvoiceDate"] == datetime(2010, 1, 1)


def test_list_parts_skips_markers_and_reads_partition_folders(spark):
    from churnlens.sources.parts import list_parts
    base = tempfile.mkdtemp(prefix="listparts-")
    spark.createDataFrame(_rows(2, 1), SCHEMA).write.parquet(os.path.join(base, "b_part"))
    spark.createDataFrame(_rows(1, 5), SCHEMA).write.parquet(os.path.join(base, "part=a_part"))
    open(os.path.join(base, "_SUCCESS"), "w").close()
    open(os.path.join(base, ".hidden"), "w").close()
    found = list_parts(spark, base)
    assert list(found) == ["a_part", "b_part"]
    assert found["a_part"].endswith("part=a_part")


LINES = ["1,A,d,3,2010-01-02 08:26:00,1.5,17850.0,UK", "2,A,d,1.0,2010-01-02 08:26:00,1.5,17850.0,UK", '3,A,d,"1,000",2010-01-02 08:26:00,1.5,17850.0,UK',
         "4,A,d,3,01/12/2010 08:26,1.5,17850.0,UK", "5,A,d,3,2010-01-02 08:26:00,£3.5,17850.0,UK", "6,A,,,,,,"]


@pytest.fixture
def csv_dirs(spark):
    base = tempfile.mkdtemp(prefix="csv-")
    for name, lines in [(NAMES[0], LINES[:3]), (NAMES[1], LINES[3:])]:
        os.makedirs(f"{base}/{name}")
        with open(f"{base}/{name}/lines.csv", "w", encoding="utf-8") as f:
            f.write("\n".join([",".join(SCHEMA.names), *lines]) + "\n")
    return base, {n: f"{base}/{n}" for n in NAMES}


def test_values_that_types_do_not_hold_are_put_aside(spark, csv_dirs):
    base, paths = csv_dirs
    raw, aside = TableTarget(f"{base}/raw"), TableTarget(f"{base}/aside", mode="append")
    for run in (1, 2):
        res = run_ingestion(spark, paths, NAMES, raw, "csv", SCHEMA, {"header": "true"}, aside)
        assert res["row_counts"] == {NAMES[0]: 1, NAMES[1]: 1, "total": 2} and res["check"]["matches"]
        assert res["quarantined"] == {NAMES[0]: 2, NAMES[1]: 2, "total": 4}
        good = {r["Invoice"]: r for r in raw.read(spark).collect()}
        assert set(good) == {"1", "6"} and good["1"]["Quantity"] == 3 and good["6"]["Price"] is None
        assert good["1"]["InvoiceDate"] == datetime(2010, 1, 2, 8, 26) and raw.read(spark).columns == SCHEMA.names
        kept = aside.read(spark).collect()
        assert len(kept) == 4 * run and sorted({r["record"] for r in kept}) == LINES[1:5]
        assert all('"Invoice"' in r["read_as"] and r["part"] in NAMES for r in kept)
    with pytest.raises(ValueError):
        run_ingestion(spark, paths, NAMES, raw, "csv", SCHEMA, {"header": "true"}, TableTarget(f"{base}/other", mode="replace"))


def test_without_a_quarantine_such_values_fail_the_job(spark, csv_dirs):
    base, paths = csv_dirs
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        run_ingestion(spark, paths, NAMES, TableTarget(f"{base}/raw2"), "csv", SCHEMA, {"header": "true"})
    assert not TableTarget(f"{base}/raw2")._current(spark)


def test_json_and_typed_parts_with_a_quarantine(spark, part_dirs):
    base = tempfile.mkdtemp(prefix="json-")
    with open(f"{base}/a.json", "w") as f:
        f.write('{"Invoice": "1", "Quantity": 2}\n{"Invoice": "2", "Quantity": "many"}\n{broken\n')
    aside = TableTarget(f"{base}/aside", mode="append")
    res = run_ingestion(spark, {"x": f"{base}/a.json", "y": f"{base}/a.json"}, ("x", "y"), TableTarget(f"{base}/raw"), "json", SCHEMA, None, aside)
    assert res["row_counts"]["total"] == 2 and res["quarantined"] == {"x": 2, "y": 2, "total": 4}
    res = run_ingestion(spark, part_dirs, NAMES, TableTarget(f"{base}/typed"), quarantine_target=aside)
    assert res["row_counts"]["total"] == 5 and res["quarantined"]["total"] == 0 and aside.read(spark).count() == 4
