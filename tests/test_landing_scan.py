"""The landing scan: row numbers and headers over splits and many files, skipped rows, the audit's totals."""

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.schema import RAW_COLUMNS
from ledgerflow.sources import landing
from ledgerflow.sources.tables import Warehouse
from tests.test_landing import put

HEAD = "rate_date,currency,rate_to_eur,source"


def plain(root, name, text):
    (root / "fx_rates").mkdir(parents=True, exist_ok=True)
    path = root / "fx_rates" / name
    path.write_text(text)
    return str(path)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_of_a_file_in_many_splits_keep_exact_numbers(spark, tmp_path, small_splits):
    names = {"fx_rates_20250101.csv": 1500, "fx_rates_20250102.csv": 7, "fx_rates_20250103.csv": 400}
    paths = [plain(tmp_path, name, HEAD + "\n" + "".join(f"2025-01-01,C{i},{i}.5,\n" + ("\n" if i % 9 == 0 else "") for i in range(1, n + 1))) for name, n in names.items()]
    lines = landing.landed_lines(spark, paths)
    assert lines.select("_path", "_start").distinct().count() > 12
    got = landing.read_landing(spark, paths, "fx_rates").collect()
    assert {(r["_source_file"], r["_source_row"], r["currency"]) for r in got} == {(f"fx_rates/{f}", i, f"C{i}") for f, n in names.items() for i in range(1, n + 1)}
    assert len(got) == sum(names.values())


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_many_files_take_no_more_jobs(spark, tmp_path):
    paths = [plain(tmp_path, f"fx_rates_202501{i:02d}.csv", f"{HEAD}\n2025-01-{i:02d},USD,0.{i},ECB\n" if i % 2 else f"﻿currency,note,RATE_TO_EUR,\"rate_date\"\r\nUSD,x,0.{i},2025-01-{i:02d}\r\n") for i in range(1, 25)]
    few, jobs_few = jobs_of(spark, "few", lambda: landing.read_landing(spark, paths[:2], "fx_rates").collect())
    many, jobs_many = jobs_of(spark, "many", lambda: landing.read_landing(spark, paths, "fx_rates").collect())
    assert jobs_many <= jobs_few and len(few) == 2
    assert sorted((r["rate_date"], r["currency"], r["rate_to_eur"], r["source"]) for r in many) == [(f"2025-01-{i:02d}", "USD", f"0.{i}", "ECB" if i % 2 else None) for i in range(1, 25)]


def test_quotes_and_rows_that_do_not_end(spark, tmp_path):
    lines = ['2025-01-01,"US""D",1,"a, b"', '2025-01-02,"USD,2,x', '2025-01-03,5" pipe,3,y', '2025-01-04,USD,4,"z""', '"",,"",""', "2025-01-06,USD", '2025-01-07,USD,7,x,more', '2025-01-08,USD,8,"c"""']
    path = plain(tmp_path, "fx_rates_20250101.csv", "\n".join([HEAD, *lines]))
    got = {r["_source_row"]: r for r in landing.read_landing(spark, [path], "fx_rates").collect()}
    assert {n for n, r in got.items() if r["_malformed"]} == {2, 4} and got[2]["_corrupt"] == lines[1]
    assert {n for n, r in got.items() if r["_corrupt"] is not None} == {2, 4, 6, 7}
    assert got[1]["currency"] == 'US"D' and got[8]["source"] == 'c"'
    assert (got[1]["source"], got[3]["currency"], got[6]["currency"], got[7]["source"]) == ("a, b", '5" pipe', "USD", "x")
    by_name = {n: next(csv.reader([lines[n - 1]])) for n in (1, 3, 5, 8)}
    assert {n: [got[n][c] or "" for c in HEAD.split(",")] for n in by_name} == by_name


def test_skipped_rows_are_counted_and_kept_aside(spark, tmp_path):
    put(tmp_path / "in", "fx_rates", "20250101", f'{HEAD}\n2025-01-01,USD,0.9,ECB\n2025-01-02,"USD,0.9,ECB\n2025-01-03,USD\n')
    put(tmp_path / "in", "fx_rates", "20250102", f"{HEAD}\n")
    put(tmp_path / "in", "fx_rates", "20250103", "")
    w = Warehouse(spark, str(tmp_path / "wh"))
    audit = landing.load_entity(spark, str(tmp_path / "in"), w, "fx_rates", loaded_at=dt.datetime(2025, 1, 4), run_id="r")
    assert {(r["file_name"][-15:-7], r["rows_parsed"], r["rows_loaded"], r["errors_seen"], r["first_error"]) for r in audit.collect()} == {
        ("20250101", 3, 2, 2, '2025-01-02,"USD,0.9,ECB'), ("20250102", 0, 0, 0, None), ("20250103", 0, 0, 0, None)
    }
    assert [r["_source_row"] for r in w.read("raw_fx_rates").orderBy("_source_row").collect()] == [1, 3]
    assert [(r["entity"], r["_source_row"], r["_corrupt"]) for r in w.read("load_rejects").collect()] == [("fx_rates", 2, '2025-01-02,"USD,0.9,ECB')]
    again = landing.load_entity(spark, str(tmp_path / "in"), w, "fx_rates", run_id="s")
    assert [r["status"] for r in again.collect()] == ["NO_NEW_FILES"]  # files without rows count as loaded, too
    totals = {(r["run_id"], r["entity"]): r for r in landing.load_summary(w.read("load_audit")).collect()}
    got = totals["r", "fx_rates"]
    assert (got["files"], got["rows_parsed"], got["rows_loaded"], got["errors_seen"], got["first_error"]) == (3, 3, 2, 2, '2025-01-02,"USD,0.9,ECB')
    assert (totals["s", "fx_rates"]["files"], totals["s", "fx_rates"]["rows_parsed"]) == (0, 0)
    w.drop_batch("load_audit", "r-fx_rates")  # a crash before the audit: skipped rows are taken back, too
    landing.load_entity(spark, str(tmp_path / "in"), w, "fx_rates", run_id="t")
    assert w.read("load_rejects").count() == 1 and w.read("raw_fx_rates").count() == 2


def test_long_rows_with_many_quotes(spark, tmp_path):
    note = '""' * 20_000
    path = plain(tmp_path, "fx_rates_20250101.csv", f'{HEAD}\n2025-01-01,USD,1,"{note}"\n2025-01-02,USD,1,"{note}\n')
    got = landing.read_landing(spark, [path], "fx_rates").select("_source_row", "_malformed", F.length("source").alias("n")).orderBy("_source_row").collect()
    assert [r["_malformed"] for r in got] == [False, True] and got[0]["n"] == 20_000
    assert list(RAW_COLUMNS["fx_rates"]) == HEAD.split(",")
