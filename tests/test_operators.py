"""Literal fixtures: given rows, expected rows."""

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.functions.columns import full_match, mask_email, mask_iban, parse_ts, surrogate_key
from ledgerflow.operators import change, quality
from ledgerflow.operators.temporal import as_of_join, explode_days, forward_fill, island_members, latest_by, rolling_zscore, trailing_count
from ledgerflow.plans import aml, controls, core

FCT = "account_id string, txn_id string, txn_ts timestamp_ntz, amount_eur decimal(18,2), txn_type string, is_posted boolean"


def ts(text):
    return dt.datetime.fromisoformat(text)


def facts(spark, rows, kind):
    from decimal import Decimal

    return spark.createDataFrame([(a, t, ts(at), Decimal(str(x)), kind, posted) for a, t, at, x, posted in rows], FCT)


def test_weekend_uses_fridays_rate(spark):
    rates = spark.createDataFrame([(dt.date(2025, 1, 3), "USD", 0.92), (dt.date(2025, 1, 6), 'USD', 0.95)], "rate_date date, currency string, r double").select("rate_date", "currency", F.col("r").cast("decimal(18,8)").alias("rate_to_eur"))
    got = core.fx_daily(rates, replace(Params(), fx_forward_fill_days=0)).orderBy("currency", "rate_date").collect()
    usd = [(r["rate_date"].day, float(r["rate_to_eur"]), r["published_date"].day, r["is_carried_forward"]) for r in got if r["currency"] == "USD"]
    assert usd == [(3, 0.92, 3, False), (4, 0.92, 3, True), (5, 0.92, 3, True), (6, 0.95, 6, False)]
    assert [float(r["rate_to_eur"]) for r in got if r["currency"] == "EUR"] == [1.0] * 4


def test_days_before_the_first_value_stay_null(spark):
    df = spark.createDataFrame([("A", dt.date(2025, 1, 1), 1), ("B", dt.date(2025, 1, 2), 2)], "k string, d date, v int")
    got = {(r["k"], r["d"].day): r["v"] for r in forward_fill(df, "k", "d", "v", 1).collect()}
    assert got == {("A", 1): 1, ("A", 2): 1, ("A", 3): 1, ("B", 1): None, ("B", 2): 2, ("B", 3): 2}


def feed(spark, rows):
    return spark.createDataFrame([(c, ts(at), risk, f"f{n}", n) for n, (c, at, risk) in enumerate(rows)], "customer_id string, updated_at timestamp_ntz, risk string, _source_file string, _source_row long")


def test_history_ignores_versions_that_change_nothing(spark):
    rows = feed(spark, [("C1", "2025-01-01", "LOW"), ("C1", "2025-02-01", "LOW"), ("C1", "2025-03-01", "HIGH")])
    got = change.scd2_from_feed(rows, "customer_id", "updated_at", ["risk"], ["_source_file"]).orderBy("valid_from").collect()
    assert [(r["risk"], r["valid_from"].month, r["valid_to"] and r["valid_to"].month, r["is_current"]) for r in got] == [("LOW", 1, 3, False), ("HIGH", 3, None, True)]


def test_history_keeps_a_return_to_an_old_state(spark):
    rows = feed(spark, [("C1", "2025-01-01", "A"), ("C1", "2025-02-01", "B"), ("C1", "2025-03-01", "A"), ("C1", "2025-03-01", "B")])
    got = change.scd2_from_feed(rows, "customer_id", "updated_at", ["risk"], ["_source_file"]).orderBy("valid_from").collect()
    assert [r["risk"] for r in got] == ["A", "B"]  # the later delivery of 1 March is B again
    got = change.scd2_from_feed(rows.where("_source_row < 3"), "customer_id", "updated_at", ["risk"], ["_source_file"]).collect()
    assert len(got) == 3


def test_spliced_histories_equal_those_of_the_whole_feed(spark):
    """Any order of deliveries: late versions, repeated ones, and one that parts two equal states."""
    rng = random.Random(5)
    rows = [(f"C{rng.randrange(4)}", dt.datetime(2025, 1, 1) + dt.timedelta(days=rng.randrange(12)), rng.choice("AB"), f"f{rng.randrange(6)}", n) for n in range(60)] + [("C9", dt.datetime(2025, 1, 1), None, "f1", 99)]
    feed = spark.createDataFrame(rows, "customer_id string, updated_at timestamp_ntz, risk string, _source_file string, _source_row long").cache()
    tie, args = ["_source_file", "_source_row"], ("customer_id", "updated_at", ["risk"])
    want = sorted(map(tuple, change.scd2_from_feed(feed, *args, tie).collect()))
    versions = history = None
    for n in (2, 0, 3, 1):
        news = feed.where(F.pmod(F.hash("_source_row"), F.lit(4)) == n)
        versions = change.splice_versions(versions, news, "customer_id", "updated_at", tie).cache()
        history = (change.scd2_from_versions(versions, *args) if history is None else change.splice_scd2(history, versions, news, *args)).cache()
    assert sorted(map(tuple, history.collect())) == want


def test_checksums_find_what_a_full_comparison_finds(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, n % 50]), rng.choice([None, "x", "y"]), n) for n in range(400)]
    make = lambda rows: spark.createDataFrame(rows, "k int, v string, loaded int").repartition(3)
    a, spoilt = make(rows + rows[:5]), make([(None, "x", 0), (7, None, 0), *rows[3:], rows[10], rows[10]])
    for b in (a, spoilt, a.limit(0), make(rows)):
        for buckets in (1, 16, 4096):
            got, want = change.checksum_diff(a, b, ("loaded",), buckets), change.symmetric_diff(a, b, ("loaded",))
            assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))


def test_structuring_needs_three_deposits_in_24_hours(spark):
    rows = [
        ("A1", "T1", "2025-01-01 22:00:00", 9500, True), ("A1", "T2", "2025-01-02 09:00:00", 9400, True), ("A1", "T3", "2025-01-02 17:00:00", 9900, True),
        ("A2", "T4", "2025-01-01 10:00:00", 9500, True), ("A2", "T5", "2025-01-01 11:00:00", 9500, True), ("A2", "T6", "2025-01-01 12:00:00", 12000, True),
        ("A3", "T7", "2025-01-01 10:00:00", 9500, True), ("A3", "T8", "2025-01-01 20:00:00", 9500, True), ("A3", "T9", "2025-01-02 11:00:00", 9500, True),
    ]
    got = aml.structuring(facts(spark, rows, "CASH_DEPOSIT")).collect()
    assert {(r["account_id"], r["alert_anchor_txn_id"], r["txn_id"]) for r in got} == {("A1", "T3", t) for t in ("T1", "T2", "T3")}


def test_velocity_needs_ten_attempts_in_an_hour_and_crosses_midnight(spark):
    start = ts("2025-01-01 23:30:00")
    rows = [("A1", f"V{i}", str(start + dt.timedelta(minutes=5 * i)), 10, i != 3) for i in range(10)] + [("A2", f"W{i}", str(start + dt.timedelta(minutes=i)), 10, True) for i in range(9)]
    got = aml.velocity(facts(spark, rows, "CARD_PAYMENT")).collect()
    assert {(r["account_id"], r["alert_anchor_txn_id"]) for r in got} == {("A1", "V9")} and {r["txn_id"] for r in got} == {f"V{i}" for i in range(10)}


def test_window_is_open_at_its_old_end(spark):
    at = ts("2025-01-02 00:00:00")
    rows = [("A", "1", str(at), 1, True), ("A", "2", str(at + dt.timedelta(minutes=60)), 1, True), ("B", "3", str(at + dt.timedelta(microseconds=1)), 1, True), ("B", "4", str(at + dt.timedelta(minutes=60)), 1, True), ("B", "5", str(at + dt.timedelta(minutes=60)), 1, True)]
    df = facts(spark, rows, "X")
    got = {r["txn_id"]: r["n"] for r in df.withColumn("n", trailing_count(df, ["account_id"], "txn_ts", 60)).collect()}
    assert got == {"1": 1, "2": 1, "3": 1, "4": 3, "5": 3}
    marked = df.withColumn("anchor", F.col("txn_id").isin("2", "5"))
    held = {r["txn_id"]: r["island_anchor"] for r in island_members(marked, ["account_id"], "txn_ts", "txn_id", "anchor", 60).collect()}
    assert held == {"1": None, "2": "2", "3": "5", "4": "5", "5": "5"}


def test_islands_split_where_anchors_are_a_window_apart(spark):
    at = ts("2025-01-01 00:00:00")
    rows = [("A", str(i), str(at + dt.timedelta(minutes=m)), 1, True) for i, m in enumerate((0, 59, 118, 178))]
    got = {r["txn_id"]: r["island_anchor"] for r in island_members(facts(spark, rows, "X").withColumn("anchor", F.lit(True)), ["account_id"], "txn_ts", "txn_id", "anchor", 60).collect()}
    assert got == {"0": "0", "1": "0", "2": "0", "3": "3"}


def test_members_equal_brute_force(spark):
    import random

    rng, start = random.Random(5), ts("2025-01-01 00:00:00")
    rows = [(a, f"{i:03d}", start + dt.timedelta(minutes=rng.randrange(900)), rng.random() < 0.3) for a in "AB" for i in range(80)]
    df = spark.createDataFrame(rows, "account_id string, txn_id string, txn_ts timestamp_ntz, anchor boolean")
    got = {(r["account_id"], r["txn_id"]): r["island_anchor"] for r in island_members(df, ["account_id"], "txn_ts", "txn_id", "anchor", 20).collect()}
    window, want = dt.timedelta(minutes=20), {}
    for a in "AB":
        anchors, last, first = {}, None, None
        for _, i, at, own in sorted((r for r in rows if r[0] == a), key=lambda r: (r[2], r[1])):
            if own:
                first = first if last is not None and at - last < window else i
                anchors[i], last = (at, first), at
        for _, i, at, _ in (r for r in rows if r[0] == a):
            # of anchors at one instant one sees as much as another; the earliest island that sees a row has it
            seen = sorted((t, f) for t, f in anchors.values() if at <= t < at + window)
            want[a, i] = seen[0][1] if seen else None
    assert got == want


def test_a_hot_account_takes_linear_work(spark):
    events = spark.range(20_000).select(F.lit("A").alias("account_id"), F.col("id").cast("string").alias("txn_id"), F.timestamp_add("SECOND", (F.col("id") % 3000).cast("int"), F.lit(ts("2025-01-01")).cast("timestamp_ntz")).alias("txn_ts"),
                                        F.lit(10).cast("decimal(18,2)").alias("amount_eur"), F.lit("CARD_PAYMENT").alias("txn_type"), F.lit(True).alias("is_posted"))
    got = aml.velocity(events)
    assert got.count() == 20_000 and got.select("alert_anchor_txn_id").distinct().count() == 1


def test_blank_ids_and_times_are_not_missing(spark):
    rows = [("T1", None, None), ("T2", " ", None), (" ", "2025-01-01 00:00:00", ts("2025-01-01")), (None, "2025-01-01 00:00:00", ts("2025-01-01"))]
    txns = spark.createDataFrame([(t, "A", raw, at, "DR", "EUR", "FEE", None) for t, raw, at in rows], "txn_id string, account_id string, txn_ts_raw string, txn_ts timestamp_ntz, direction string, currency string, txn_type string, merchant_id string").withColumn("amount", F.lit(1))
    accounts = spark.createDataFrame([("A", "EUR", "C")], "account_id string, currency string, customer_id string")
    got = {(r["txn_id"], r["txn_ts_raw"]): r["rejection_reason"] for r in core.validate(txns, accounts).collect()}
    assert list(got.values()) == ["MISSING_TIMESTAMP", "INVALID_TIMESTAMP", None, "MISSING_TXN_ID"]


def test_rows_without_an_id_repeat_the_first_of_them(spark):
    rows = [(None, f"transactions/transactions_2025010{d}.csv.gz", "2025-01-03 10:00:01", "2025-01-01 12:00:00") for d in (2, 3, 3)]
    got = {r["source_file"][-15:-7]: r["duplicate_rows"] for r in controls.file_summary(validated(spark, rows)).collect()}
    assert got == {"20250102": 0, "20250103": 2}


def test_zscore_is_null_without_variation(spark):
    df = spark.createDataFrame([("A", i, 5.0) for i in range(4)] + [("A", 4, 9.0)], "k string, i int, v double")
    got = rolling_zscore(df, ["k"], ["i"], F.col("v")).orderBy("i").collect()
    assert [r["history_count"] for r in got] == [0, 1, 2, 3, 4] and all(r["zscore"] is None for r in got)


def test_as_of_modes(spark):
    versions = spark.createDataFrame([("C", ts("2025-01-01"), ts("2025-02-01"), "A"), ("C", ts("2025-02-01"), None, "B")], "c string, valid_from timestamp_ntz, valid_to timestamp_ntz, s string")
    left = spark.createDataFrame([("C", ts("2025-02-01")), ("C", ts("2024-12-31")), ("D", ts("2025-02-01"))], "c string, at timestamp_ntz")
    instant = {(r["c"], r["at"]): r["s"] for r in as_of_join(left, versions, "c", F.col("at"), keep=("s",)).collect()}
    before = {(r["c"], r["at"]): r["s"] for r in as_of_join(left, versions, "c", F.col("at"), "before", ("s",)).collect()}
    assert instant == {("C", ts("2025-02-01")): "B", ("C", ts("2024-12-31")): None, ("D", ts("2025-02-01")): None}
    assert before[("C", ts("2025-02-01"))] == "A"
    with pytest.raises(ValueError):
        as_of_join(left, versions, "c", F.col("at"), "later")


def test_explode_days_of_an_empty_span(spark):
    df = spark.createDataFrame([("A", dt.date(2025, 1, 2), dt.date(2025, 1, 1)), ("B", None, dt.date(2025, 1, 1)), ("C", dt.date(2025, 1, 1), dt.date(2025, 1, 2))], "k string, a date, b date")
    assert [r["k"] for r in explode_days(df, "a", "b").collect()] == ["C", "C"]


def validated(spark, rows):
    return spark.createDataFrame([(t, f, n, ts(loaded), ts(at), None, None) for n, (t, f, loaded, at) in enumerate(rows)], "txn_id string, _source_file string, _source_row long, _loaded_at timestamp_ntz, txn_ts timestamp_ntz, rejection_reason string, warning_reason string")


def test_resent_copy_scanned_first_is_still_the_duplicate(spark):
    rows = [("T1", "transactions/transactions_20250103.csv.gz", "2025-01-03 10:00:01", "2025-01-01 12:00:00"), ("T1", "transactions/transactions_20250102.csv.gz", "2025-01-03 10:00:09", "2025-01-01 12:00:00")]
    got = {r["source_file"][-15:-7]: (r["duplicate_rows"], r["late_arriving_rows"]) for r in controls.file_summary(validated(spark, rows)).collect()}
    assert got == {"20250102": (0, 0), "20250103": (1, 0)}


def test_paths_are_compared_on_streamed_days_only(spark):
    make = lambda rows: spark.createDataFrame([(t, ts(at)) for t, at in rows], "txn_id string, txn_ts timestamp_ntz")
    stream = make([("T1", "2025-12-01 10:00:00"), ("T2", "2025-12-01 11:00:00"), ("T2", "2025-12-01 11:00:00")])
    batch = make([("T1", "2025-12-01 10:00:00"), ("T3", "2025-12-01 12:00:00"), ("T4", "2025-12-02 09:00:00")])
    got = controls.stream_vs_batch(stream, batch).collect()
    assert [(r["streamed_txns"], r["batch_txns"], r["in_both"], r["stream_only"], r["batch_only"], float(r["stream_coverage"])) for r in got] == [(2, 2, 1, 1, 1, 0.5)]


def test_upsert_ranks_old_and_new_deliveries_together(spark):
    target = spark.createDataFrame([("T1", "f2", 5)], "k string, f string, v int")
    late = spark.createDataFrame([("T1", "f1", 9), ("T2", "f1", 1)], "k string, f string, v int")
    assert {(r["k"], r["v"]) for r in change.upsert(target, late, ["k"], ["f"]).collect()} == {("T1", 5), ("T2", 1)}
    assert {(r["k"], r["v"]) for r in change.upsert(target, late, ["k"]).collect()} == {("T1", 9), ("T2", 1)}
    wider = late.withColumn("extra", F.lit("x"))
    assert {(r["k"], r["extra"]) for r in change.upsert(target, wider.where("k = 'T2'"), ["k"]).collect()} == {("T1", None), ("T2", "x")}


def test_loaded_since_looks_back(spark):
    rows = spark.createDataFrame([(i, ts(f"2025-01-01 {h:02d}:00:00")) for i, h in enumerate((1, 8, 9, 12))], "i int, _loaded_at timestamp_ntz")
    assert [r["i"] for r in change.loaded_since(rows, rows.where("i <= 2"), lookback_hours=3).collect()] == [1, 2, 3]
    assert change.loaded_since(rows, None).count() == 4 and change.loaded_since(rows, rows.limit(0)).count() == 4


def test_incremental_balances_equal_a_rebuild(spark, data):
    from ledgerflow.plans.catalog import Ledger

    l = Ledger(spark, data)
    early = l.fct.where(F.col("_loaded_at") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    moved = core.incremental_balance(core.daily_balance(early, l.accounts, l.fx), l.fct, l.accounts, l.fx, early)
    assert change.symmetric_diff(moved, l.balances, ("source_loaded_through",)).count() == 0
    same = core.incremental_balance(l.balances, l.fct, l.accounts, l.fx)
    assert change.symmetric_diff(same, l.balances).count() == 0


def test_latest_by_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 1, "n")], "k string, v int, w string")
    assert {(r["k"], r["w"]) for r in latest_by(df, ["k"], ["v", "w"]).collect()} == {("a", "y"), (None, "n")}


def test_scalar_helpers(spark):
    row = spark.sql("select '31/12/2025 23:59:59' a, 'nonsense' b, 'x@y.z' mail, 'DE001234567890' iban, cast(null as string) n").select(
        parse_ts(F.col("a"), "%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M:%S").alias("a"), parse_ts(F.col("b")).alias("b"), mask_email(F.col("mail")).alias("mail"), mask_iban(F.col("iban")).alias("iban"),
        full_match(F.col("iban"), "DE").alias("part"), full_match(F.col("iban"), "DE[0-9]+").alias("whole"), (surrogate_key(F.col("n")) == F.md5(F.lit("_null_"))).alias("key"),
    ).first()
    assert row["a"] == ts("2025-12-31 23:59:59") and row["b"] is None
    assert (row["mail"], row["iban"], row["part"], row["whole"], row["key"]) == ("x***@y.z", "DE00******7890", False, True, True)


def test_checks_find_what_fails(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", None), (None, "z", 50)], "k int, c string, v int")
    parent = spark.createDataFrame([("a",), ("b",)], "c string")
    results = quality.run_checks([
        quality.Check("nulls", quality.not_null(df, "k")), quality.Check("unique", quality.unique(df, "k")), quality.Check("values", quality.accepted_values(df, "c", ["a", "b", "z"])),
        quality.Check("parents", quality.relationships(df, "c", parent, "c"), "warn"), quality.Check("range", quality.within_range(df, "v", 1, 10)), quality.Check("true", quality.expression_is_true(df, "v < 10", "c = 'a'")),
    ])
    assert [(n, s) for _, _, n, s in results] == [(1, "error"), (1, "error"), (0, "pass"), (1, "warn"), (1, "error"), (0, "pass")]


def test_case_recall(spark):
    cases = spark.createDataFrame([("VELOCITY", "c1", "T1"), ("VELOCITY", "c2", "T2")], "rule string, case_id string, txn_id string")
    members = spark.createDataFrame([("VELOCITY", "T1", "a1"), ("VELOCITY", "T9", "a2")], "rule_code string, txn_id string, alert_id string")
    r = controls.case_recall(cases, members).first()
    assert (r["cases"], r["cases_found"], r["true_alerts"], r["alerts"], r["precision"]) == (2, 1, 1, 2, 0.5)


def test_ground_truth_counts_what_is_missing_and_extra(spark):
    rows = [  # txn_id, file, row, time, rejection
        ("T1", "20250102", 1, "2025-01-01", None), ("T1", "20250102", 2, "2025-01-01", None), ("T1", "20250103", 1, "2025-01-01", None), ("T2", "20250102", 3, None, "INVALID_TIMESTAMP"),
        ("T3", "20250109", 1, "2025-01-01", None), ("T4", "20250109", 2, "2025-01-01", "ZERO_AMOUNT"), ("T5", "20250102", 4, "2025-01-01", None), ("T6", "20250102", 5, "2025-01-01", "NEGATIVE_AMOUNT"), (None, "20250102", 6, None, "MISSING_TXN_ID"),
    ]
    data = [(t, f"transactions/transactions_{f}.csv.gz", n, at and ts(f"{at} 10:00:00"), r) for t, f, n, at, r in rows]
    validated = spark.createDataFrame(data, "txn_id string, _source_file string, _source_row long, txn_ts timestamp_ntz, rejection_reason string")
    fct = spark.createDataFrame([("T1", "EUR", None), ("T3", "usd", None), ("T5", "EUR", "MISSING_MERCHANT")], "txn_id string, currency string, warning_reason string")
    injected = [
        ("DUPLICATE_ROW", "T1"), ("DUPLICATE_ROW", "T1"), ("INVALID_TIMESTAMP", "T2"), ("ZERO_AMOUNT", "T2"), ("LATE_ARRIVAL", "T3"), ("LATE_ARRIVAL", "T4"), ("ZERO_AMOUNT", "T4"), ("MISSING_MERCHANT", "T5"), ("MISSING_MERCHANT", "T7"),
        ("LOWERCASE_CURRENCY", "T1"), ("CURRENCY_MISMATCH", None),
    ]
    report = controls.ground_truth(spark.createDataFrame(injected, "issue string, txn_id string"), validated, fct).collect()
    assert {r["issue"]: (r["injected"], r["found"], r["missing"], r["extra"], r["passed"]) for r in report} == {
        "DUPLICATE_ROW": (2, 2, 0, 0, True), "INVALID_TIMESTAMP": (1, 1, 0, 0, True), "ZERO_AMOUNT": (1, 1, 0, 0, True), "LATE_ARRIVAL": (1, 1, 0, 0, True), "MISSING_MERCHANT": (2, 1, 1, 0, False),
        "LOWERCASE_CURRENCY": (0, 1, 0, 1, False), "NEGATIVE_AMOUNT": (0, 1, 0, 1, False), "CURRENCY_MISMATCH": (0, 0, 0, 0, True),
    }
    nothing = controls.ground_truth(spark.createDataFrame([], "issue string, txn_id string"), validated.limit(0), fct.limit(0))
    assert nothing.count() == 0


def test_reconciliation_raises_on_failure(spark):
    with pytest.raises(controls.ReconciliationFailed):
        controls.require_reconciled(spark.createDataFrame([("FAIL",)], "status string"))
