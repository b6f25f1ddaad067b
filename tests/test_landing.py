import datetime as dt
import gzip
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators.change import symmetric_diff
from ledgerflow.operators.quality import ChecksFailed, require_passed, run_checks
from ledgerflow.plans.build import build
from ledgerflow.plans.checks import model_checks
from ledgerflow.schema import LOAD_ORDER, RAW_COLUMNS
from ledgerflow.sources import landing
from ledgerflow.sources.tables import Warehouse, month_partition, write_table
from ledgerflow.streaming.events import decode_events, encode_events
from ledgerflow.streaming.landing import exactly_once, land_stream, latency, missed_alerts, screen_large, screen_stream, trailing_alerts


def put(root, entity, day, text):
    folder = root / entity
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"{entity}_{day}.csv.gz", "wt") as f:
        f.write(text)


def small_bank(root):
    put(root, "customers", "20250101", "customer_id,first_name,last_name,email,birth_date,country_code,segment,risk_rating,kyc_status,created_at,updated_at\nC1,Ann,Lee,A@X.org,1980-01-01,de,retail,low,verified,2025-01-01 00:00:00,2025-01-01 00:00:00\n")
    put(root, "accounts", "20250101", "account_id,customer_id,iban,account_type,currency,status,opened_date,closed_date,opening_balance,updated_at\nA1,C1,DE00 1234,CHECKING,EUR,ACTIVE,2024-01-01,,100.00,2025-01-01 00:00:00\n")
    put(root, "merchants", "20250101", "mcc,merchant_id,merchant_name,country_code\n5411,M1,Shop,de\n")
    put(root, "fx_rates", "20250101", "rate_date,currency,rate_to_eur,source\n2025-01-01,USD,0.9,ECB\n2025-01-02,USD,0.91,ECB\n")
    head = ",".join(c for c in RAW_COLUMNS["transactions"] if c != "device_id")
    put(root, "transactions", "20250102", f"{head}\nT1,A1,2025-01-01 10:00:00,10.00,EUR,DR,CARD_PAYMENT,POSTED,CARD,M1,,,coffee\nT2,A1,bad,5,EUR,DR,FEE,POSTED,,,,,\nT3,A1,2025-01-01 11:00:00\n")


def more_of_it(root):
    cols = [c.upper() for c in reversed(RAW_COLUMNS["transactions"])]
    row = dict(TXN_ID="T4", ACCOUNT_ID="A1", TXN_TS="02/01/2025 09:00:00", AMOUNT='"7,50"', CURRENCY="eur", DIRECTION="CR", TXN_TYPE="SALARY", STATUS="POSTED", DEVICE_ID="d1")
    again = dict(TXN_ID="T1", ACCOUNT_ID="A1", TXN_TS="2025-01-01 10:00:00", AMOUNT="12.00", CURRENCY="EUR", DIRECTION="DR", TXN_TYPE="CARD_PAYMENT", STATUS="POSTED", MERCHANT_ID="M1")
    put(root, "transactions", "20250103", ",".join(cols) + "\n" + "".join(",".join(r.get(c, "") for c in cols) + "\n" for r in (row, again)))


def test_columns_are_found_by_name_and_rows_are_numbered(spark, tmp_path):
    small_bank(tmp_path)
    more_of_it(tmp_path)
    paths = [r["path"] for r in landing.list_files(spark, str(tmp_path), "transactions").collect()]
    got = {(r["_source_file"][-15:-7], r["_source_row"]): r for r in landing.read_landing(spark, paths, "transactions").collect()}
    assert got["20250102", 1]["device_id"] is None and got["20250103", 1]["device_id"] == "d1"
    assert got["20250103", 1]["amount"] == "7,50" and got["20250103", 2]["txn_id"] == "T1"
    ragged = got["20250102", 3]
    assert ragged["txn_id"] == "T3" and ragged["amount"] is None and ragged["_corrupt"] is not None
    merchants = [r["path"] for r in landing.list_files(spark, str(tmp_path), "merchants").collect()]
    m = landing.read_landing(spark, merchants, "merchants").first()
    assert (m["merchant_id"], m["mcc"]) == ("M1", "5411")


def test_loading_twice_adds_nothing_and_incremental_equals_rebuild(spark, tmp_path):
    small_bank(tmp_path / "in")
    w = Warehouse(spark, str(tmp_path / "wh"))
    first = landing.load_all(spark, str(tmp_path / "in"), w, through=dt.date(2025, 1, 2), loaded_at=dt.datetime(2025, 1, 2, 6))
    assert {(r["entity"], r["rows_loaded"], r["errors_seen"]) for r in first.collect() if r["status"] == "LOADED"} == {("customers", 1, 0), ("accounts", 1, 0), ("merchants", 1, 0), ("fx_rates", 2, 0), ("transactions", 3, 1)}
    again = landing.load_all(spark, str(tmp_path / "in"), w)
    assert {r["status"] for r in again.collect()} == {"NO_NEW_FILES"}
    build(w)
    more_of_it(tmp_path / "in")
    landing.load_all(spark, str(tmp_path / "in"), w, loaded_at=dt.datetime(2025, 1, 3, 6))
    step = build(w)
    full = Warehouse(spark, str(tmp_path / "full"))
    for e in LOAD_ORDER:
        full.append(w.read(f"raw_{e}"), f"raw_{e}", "all")
    whole = build(full, full_refresh=True)
    for name in ("fct_transactions", "dq_rejected_transactions", "fct_account_daily_balance", "rpt_monthly_customer_summary"):
        assert symmetric_diff(step[name], whole[name], ("source_loaded_through",)).count() == 0, name
    assert {(r["txn_id"], float(r["amount"])) for r in step["fct_transactions"].collect()} == {("T1", 12.0), ("T4", 7.5)}
    assert w.versions("dim_account")[0] != w.versions("dim_account")[1]


def test_versions_only_grow(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    for n in range(3):
        w.replace(spark.range(n, n + 1), "t")
    w.drop_older(keep=1)
    assert len(w.versions("t")) == 1
    assert [r[0] for r in w.replace(spark.range(99, 100), "t").collect()] == [99] == [r[0] for r in w.read("t").collect()]


def files(table):
    """The files that a table consists of, and when they were written."""
    paths = [Path(f.removeprefix("file://")) for f in table.inputFiles()]
    return {p: p.stat().st_mtime_ns for p in paths}


def test_only_touched_months_are_written_again(spark, tmp_path):
    small_bank(tmp_path / "in")
    head = ",".join(RAW_COLUMNS["transactions"])
    line = lambda t, at, amount: f"{t},A1,{at} 10:00:00,{amount},EUR,DR,FEE,POSTED,,,,,,d\n"
    put(tmp_path / "in", "transactions", "20250301", head + "\n" + line("M1", "2025-02-10", 1) + line("M2", "2025-03-01", 2) + line("M3", "2025-03-01", 3))
    put(tmp_path / "in", "fx_rates", "20250301", "rate_date,currency,rate_to_eur,source\n2025-04-30,USD,0.9,ECB\n")
    w = Warehouse(spark, str(tmp_path / "wh"))
    landing.load_all(spark, str(tmp_path / "in"), w, loaded_at=dt.datetime(2025, 3, 2, 6))
    build(w)
    before, held = files(w.read("fct_transactions")), files(w.read("fct_account_daily_balance"))
    # M2 moves from March to April and M3 changes; nothing else does
    put(tmp_path / "in", "transactions", "20250402", head + "\n" + line("M2", "2025-04-01", 2) + line("M3", "2025-04-01", 4))
    put(tmp_path / "in", "accounts", "20250402", "account_id,customer_id,iban,account_type,currency,status,opened_date,closed_date,opening_balance,updated_at\nA9,C1,DE1,CHECKING,EUR,ACTIVE,2025-01-01,,0,2025-04-01 00:00:00\n")
    landing.load_all(spark, str(tmp_path / "in"), w, loaded_at=dt.datetime(2025, 4, 3, 6))
    step = build(w)
    after, kept = files(w.read("fct_transactions")), files(w.read("fct_account_daily_balance"))
    month = lambda found: {p.parent.name for p in found}
    assert month(before) == {"txn_month=2025-01", "txn_month=2025-02", "txn_month=2025-03"} and month(after) == {"txn_month=2025-01", "txn_month=2025-02", "txn_month=2025-04"}
    assert {p: t for p, t in after.items() if p in before} == {p: t for p, t in before.items() if p.parent.name < "txn_month=2025-03"}
    assert {p: t for p, t in kept.items() if p in held} == {p: t for p, t in held.items() if p.parent.name < "txn_month=2025-03"}
    full = Warehouse(spark, str(tmp_path / "full"))
    for e in LOAD_ORDER:
        full.append(w.read(f"raw_{e}"), f"raw_{e}", "all")
    whole = build(full, full_refresh=True, check=False)
    for name in ("fct_transactions", "dq_rejected_transactions"):
        assert symmetric_diff(step[name], whole[name]).count() == 0, name
    same = symmetric_diff(step["fct_account_daily_balance"].where("account_id = 'A1'"), whole["fct_account_daily_balance"].where("account_id = 'A1'"), ("source_loaded_through",))
    assert same.count() == 0


def test_quarantined_rows_are_released_when_their_account_arrives(spark, tmp_path):
    small_bank(tmp_path / "in")
    head = ",".join(RAW_COLUMNS["transactions"])
    put(tmp_path / "in", "transactions", "20250103", f"{head}\nQ1,A5,2025-01-02 10:00:00,5,EUR,DR,FEE,POSTED,,,,,,d\n")
    w = Warehouse(spark, str(tmp_path / "wh"))
    landing.load_all(spark, str(tmp_path / "in"), w, loaded_at=dt.datetime(2025, 1, 3, 6))
    assert "Q1" in {r["txn_id"] for r in build(w)["dq_rejected_transactions"].collect()}
    put(tmp_path / "in", "accounts", "20250120", "account_id,customer_id,iban,account_type,currency,status,opened_date,closed_date,opening_balance,updated_at\nA5,C1,DE1,CHECKING,EUR,ACTIVE,2024-01-01,,0,2025-01-19 00:00:00\n")
    landing.load_all(spark, str(tmp_path / "in"), w, loaded_at=dt.datetime(2025, 1, 20, 6))
    step = build(w)
    assert "Q1" not in {r["txn_id"] for r in step["dq_rejected_transactions"].collect()} and "Q1" in {r["txn_id"] for r in step["fct_transactions"].collect()}


def test_rows_of_a_crashed_load_are_loaded_once(spark, tmp_path):
    small_bank(tmp_path / "in")
    w = Warehouse(spark, str(tmp_path / "wh"))
    landing.load_entity(spark, str(tmp_path / "in"), w, "fx_rates", run_id="crashed")
    w.drop_batch("load_audit", "crashed-fx_rates")  # the rows were written, their audit wasn't
    landing.load_entity(spark, str(tmp_path / "in"), w, "fx_rates", run_id="again")
    assert w.read("raw_fx_rates").count() == 2


def test_a_failing_check_stops_a_build(spark):
    good = spark.createDataFrame([(1, dt.date(2025, 1, 1))], "i int, date_day date")
    require_passed(run_checks(model_checks({"dim_date": good})))
    with pytest.raises(ChecksFailed, match="dim_date.unique.date_day"):
        require_passed(run_checks(model_checks({"dim_date": good.unionByName(good)})))


def test_tables_in_any_format(spark, tmp_path):
    write_table(month_partition(spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 2, 1),)], "d date"), "d"), str(tmp_path / "o"), "d", "txn_month", "orc")
    got = spark.read.format("orc").load(str(tmp_path / "o"))
    assert got.where("txn_month = '2025-02'").count() == 1 and got.count() == 2


def test_unknown_entity_and_replay(spark, tmp_path):
    small_bank(tmp_path)
    more_of_it(tmp_path)
    with pytest.raises(ValueError):
        landing.list_files(spark, str(tmp_path), "planets")
    rows = landing.replay_files(spark, str(tmp_path), dt.date(2025, 1, 3), dt.date(2025, 1, 9)).collect()
    assert [r["txn_id"] for r in rows] == ["T4", "T1"]
    audit = landing.audit_rows(landing.read_landing(spark, [], "fx_rates"), "fx_rates", "r", dt.datetime(2025, 1, 1))
    assert [(r["status"], r["rows_parsed"]) for r in audit.collect()] == [("NO_NEW_FILES", 0)]


def messages(spark, values):
    rows = [("t", i % 3, i // 3, 1_735_689_600_000 + i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp_ms long, value binary")


def test_encode_and_decode(spark):
    row = {c: None for c in RAW_COLUMNS["transactions"]} | {"txn_id": "T1", "account_id": "A7", "amount": "12.50", "device_id": ""}
    one = encode_events(spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))).first()
    assert one["key"] == "A7" and '"device_id":null' in one["value"] and one["headers"][0]["key"] == "schema"
    good = one["value"].encode()
    bad = [None, b"", good[:20], b"[1]", b"\xff\xfe", good + b" tail", b'"text"', good + good, good + b"," + good, good + b" x}", good + b"]"]
    got = decode_events(messages(spark, [good, *bad])).orderBy("_kafka_timestamp_ms").collect()
    assert got[0]["txn_id"] == "T1" and got[0]["_parse_error"] is None and got[0]["device_id"] is None
    assert all(r["txn_id"] is None and r["_parse_error"] for r in got[1:])
    assert got[1]["_parse_error"] == "empty message" and got[3]["_raw_value"] == good[:20].decode()


def test_each_message_lands_once_after_a_crash(spark, tmp_path):
    values = [f'{{"txn_id":"T{i}"}}'.encode() for i in range(1050)]
    values[3] = b"{broken"
    source, schema = tmp_path / "topic", "topic string, partition int, offset long, timestamp_ms long, value binary"
    messages(spark, values[:400]).coalesce(1).write.parquet(str(source / "a"))
    w = Warehouse(spark, str(tmp_path / "wh"))
    read = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(source))
    land_stream(read(), w, "landed", str(tmp_path / "cp")).awaitTermination()
    for f in (tmp_path / "cp" / "commits").iterdir():  # the batch was written but its commit was lost
        f.unlink()
    messages(spark, values).where("timestamp_ms >= 1735689600400").coalesce(1).write.parquet(str(source / "b"))
    land_stream(read(), w, "landed", str(tmp_path / "cp")).awaitTermination()
    messages(spark, values[:50]).coalesce(1).write.parquet(str(source / "c"))  # sent again
    land_stream(read(), w, "landed", str(tmp_path / "cp2"), run_id="second").awaitTermination()
    landed = w.read("landed")
    expected = spark.createDataFrame([(p, 0, 350) for p in range(3)], "partition int, low long, high long")
    assert [r["ok"] for r in exactly_once(landed, expected).collect()] == [True] * 3
    assert landed.where("_parse_error is not null").select("_kafka_partition", "_kafka_offset").collect() == [(0, 1)]
    lost = exactly_once(landed.where("_kafka_offset <> 349"), expected).collect()
    assert not any(r["ok"] for r in lost)
    empty = spark.createDataFrame([(9, 5, 5)], "partition int, low long, high long")
    assert exactly_once(landed.limit(0), empty).first()["ok"]


ROWS = "txn_id string, account_id string, amount decimal(18,2), status string, ingest_path string, produced_at timestamp_ntz, landed_at timestamp_ntz, currency string, txn_type string, txn_ts_raw string, _source_file string"


def large(txn, path, hour, amount="20000.00", status="POSTED"):
    at = dt.datetime(2025, 1, 1) + dt.timedelta(hours=hour)
    return (txn, "A", Decimal(amount), status, path, at if path == "KAFKA" else None, at, "EUR", "FEE", "x", "f")


def test_a_screened_stream_alerts_once_across_restarts(spark, tmp_path):
    source, w = tmp_path / "rows", Warehouse(spark, str(tmp_path / "wh"))
    put_rows = lambda name, *rows: spark.createDataFrame(list(rows), ROWS).coalesce(1).write.parquet(str(source / name))
    read = lambda: spark.readStream.schema(ROWS).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(source))
    run = lambda: screen_stream(read(), w, "alerts", str(tmp_path / "cp"), delay="12 hours").awaitTermination()
    put_rows("a", large("T1", "KAFKA", 1), large("T1", "KAFKA", 1), large("T2", "KAFKA", 1, "5.00"), large("T3", "KAFKA", 1, status="DECLINED"))
    run()
    for f in (tmp_path / "cp" / "commits").iterdir():  # written, but its commit was lost
        f.unlink()
    put_rows("b", large("T1", "KAFKA", 3), large("T1", "FILE", 2), large("T4", "KAFKA", 2), large(None, "FILE", 2))
    run()
    put_rows("c", large("T4", "KAFKA", 4), large("T1", "FILE", 5), large("T5", "FILE", 1))  # repeats, and one that is late but in time
    run()
    found = lambda: sorted((r["txn_id"], r["ingest_path"]) for r in w.read("alerts").collect())
    assert found() == [("T1", "FILE"), ("T1", "KAFKA"), ("T4", "KAFKA"), ("T5", "FILE")]
    same = screen_large(spark.read.option("recursiveFileLookup", True).parquet(str(source)), None)
    assert sorted((r["txn_id"], r["ingest_path"]) for r in same.collect()) == found()
    put_rows("d", large("T6", "KAFKA", 60))
    put_rows("e", large("T7", "KAFKA", 61))
    query = screen_stream(read(), w, "alerts", str(tmp_path / "cp"), delay="12 hours")
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2  # what the watermark has passed is forgotten


def test_bursts_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "rows")
    at = lambda minute: dt.datetime(2025, 1, 1) + dt.timedelta(minutes=minute)
    rows = [("A", "t1", at(10)), ("A", "t2", at(11)), ("A", "t2", at(11)), ("A", "t3", at(14)), ("B", "t4", at(10)), ("B", "t5", at(30)), ("B", "t6", at(50)), (None, "t7", at(1)), ("Z", "t8", at(900))]
    kinds = "account_id string, txn_id string, txn_ts timestamp_ntz"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(kinds).parquet(source)
    out = trailing_alerts(stream, minutes=6, least=3, delay="10 minutes")
    out.writeStream.format("memory").queryName("bursts").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = spark.table("bursts").collect()
    assert {r["account_id"] for r in got} == {"A"} and {r["n"] for r in got} == {3} and {r["window_start"].minute for r in got} == {9, 10}


def test_load_summary_adds_up_a_run(spark, tmp_path):
    small_bank(tmp_path / "in")
    more_of_it(tmp_path / "in")
    w = Warehouse(spark, str(tmp_path / "wh"))
    landing.load_entity(spark, str(tmp_path / "in"), w, "transactions", run_id="r")
    landing.load_entity(spark, str(tmp_path / "in"), w, "transactions", run_id="s")
    got = {(r["run_id"], r["entity"]): (r["files"], r["rows_parsed"], r["rows_loaded"], r["errors_seen"]) for r in landing.load_summary(w.read("load_audit")).collect()}
    assert got == {("r", "transactions"): (2, 5, 5, 1), ("s", "transactions"): (0, 0, 0, 0)}
    assert w.read("raw_transactions").where("_corrupt is not null").count() == 1


def test_large_transactions_alert_once_a_path(spark):
    at = lambda h: dt.datetime(2025, 1, 1, h)
    rows = spark.createDataFrame(
        [("T1", "A", 20000.0, "POSTED", "FILE", None, at(3)), ("T1", "A", 20000.0, "POSTED", "KAFKA", at(0), at(2)), ("T1", "A", 20000.0, "POSTED", "KAFKA", at(0), at(1)), ("T2", "A", 9999.0, "POSTED", "FILE", None, at(1)), ("T3", "A", 10000.0, "DECLINED", "FILE", None, at(1)), ("T4", "A", 10000.0, "POSTED", "FILE", None, at(1))],
        "txn_id string, account_id string, a double, status string, ingest_path string, produced_at timestamp_ntz, landed_at timestamp_ntz",
    ).select("*", F.col("a").cast("decimal(18,2)").alias("amount"), F.lit("EUR").alias("currency"), F.lit("FEE").alias("txn_type"), F.lit("x").alias("txn_ts_raw"), F.lit("f").alias("_source_file"))
    first = screen_large(rows, None, detected_at=at(5))
    assert {(r["txn_id"], r["ingest_path"], r["landed_at"].hour) for r in first.collect()} == {("T1", "FILE", 3), ("T1", "KAFKA", 1), ("T4", "FILE", 1)}
    assert screen_large(rows, first).count() == 0
    legs = {r["leg"]: r["max_s"] for r in latency(first).collect()}
    assert legs == {"produced_to_landed": 3600.0, "landed_to_alert": 14400.0, "produced_to_alert": 18000.0}
    streamed = spark.createDataFrame([("T1",), ("T4",)], "txn_id string")
    assert [r["txn_id"] for r in missed_alerts(first, streamed).collect()] == ["T4"]
