"""Builds that are interrupted, late, out of order or partial end where a rebuild does."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.operators.change import symmetric_diff
from ledgerflow.operators.quality import ChecksFailed
from ledgerflow.plans import build as builds
from ledgerflow.plans.build import build, merge_by_partition
from ledgerflow.plans.controls import ReconciliationFailed
from ledgerflow.schema import LOAD_ORDER, RAW_COLUMNS
from ledgerflow.sources.tables import Warehouse

P = Params(structuring_floor_eur=20, structuring_ceiling_eur=100, structuring_min_count=2, structuring_window_minutes=1440, velocity_window_minutes=720, velocity_min_count=2, outlier_history=5, outlier_min_history=3, outlier_min_zscore=1.5, outlier_min_amount_eur=0)
DERIVED = ["dim_customer", "fct_transactions", "dq_rejected_transactions", "fct_account_daily_balance", "aml_alert_transactions", "rpt_aml_alerts", "rpt_monthly_customer_summary", "rpt_merchant_category_spend", "dq_transaction_file_summary", "int_reversals", "int_outlier_months", "int_monthly_spend"]


def land(warehouse, entity, batch, rows, loaded_at):
    """Rows (dicts; _source_file among them) as a landed batch."""
    spark, columns = warehouse.spark, RAW_COLUMNS[entity]
    data = [tuple(r.get(c) for c in columns) + (r["_source_file"], r["_source_row"], loaded_at) for r in rows]
    kinds = ", ".join(f"{c} string" for c in columns) + ", _source_file string, _source_row long, _loaded_at timestamp_ntz"
    warehouse.append(spark.createDataFrame(data, kinds).coalesce(1), f"raw_{entity}", batch)


def delivery(entity, day, rows):
    return [{**r, "_source_file": f"{entity}/{entity}_{day}.csv.gz", "_source_row": i} for i, r in enumerate(rows, 1)]


def account(i, opened="2023-06-01", currency="EUR"):
    return dict(account_id=f"A{i}", customer_id=f"C{i % 4}", iban=f"DE{i}", account_type="CHECKING", currency=currency, status="ACTIVE", opened_date=opened, closed_date="", opening_balance="100.00", updated_at="2023-06-01 00:00:00")


def customer(i, at, segment="RETAIL", risk="LOW"):
    return dict(customer_id=f"C{i}", first_name="a", last_name="b", email="a@b.c", birth_date="1980-01-01", country_code="DE", segment=segment, risk_rating=risk, kyc_status="VERIFIED", created_at="2023-01-01 00:00:00", updated_at=at)


def booking(rng, n, day, **changed):
    kind = rng.choice(["CARD_PAYMENT"] * 4 + ["CASH_DEPOSIT"] * 2 + ["SALARY", "FEE"])
    row = dict(txn_id=f"T{n}", account_id=f"A{rng.randrange(6)}", txn_ts=f"{day} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", amount=f"{rng.choice([30, 40, 55, 70, 400]) + rng.random():.2f}", currency="EUR", direction="CR" if kind in ("CASH_DEPOSIT", "SALARY") else "DR", txn_type=kind, status="POSTED", channel="CARD", merchant_id=f"M{rng.randrange(3)}")
    return row | changed


@pytest.fixture(scope="module")
def deliveries():
    """Three rounds of deliveries: the history; late, moved, changed, older and released rows; and a quiet day."""
    rng = random.Random(21)
    day = lambda: (dt.date(2024, 1, 3) + dt.timedelta(days=rng.randrange(120))).isoformat()
    first = [booking(rng, n, day()) for n in range(260)]
    first += [dict(first[5], txn_id="R5", txn_type="REVERSAL", original_txn_id="T5", direction="CR")]
    first += [booking(rng, 800 + n, day(), account_id="A8") for n in range(6)] + [booking(rng, 820, day(), txn_ts="nonsense"), booking(rng, 821, day(), amount="x")]
    alone = booking(rng, 900, "2023-12-20")  # the only row of its month
    second = [dict(first[n], txn_ts=f"{day()} 12:00:00") for n in (3, 17, 44)] + [dict(first[n], amount="77.77") for n in (60, 61)]
    second += [booking(rng, 500 + n, d) for n, d in enumerate(["2024-02-07", "2024-03-11", "2024-05-06", "2024-05-06"])] + [dict(first[70], txn_id="R70", txn_type="REVERSAL", original_txn_id="T70", direction="CR")]
    older = [dict(alone, txn_ts="2024-01-15 10:00:00", amount="1.00")]  # delivered late, dated before the file of `alone`
    third = [booking(rng, 600 + n, "2024-05-07") for n in range(3)]
    return dict(alone=[alone], first=first, second=second, older=older, third=third)


def land_reference(w, batch, at, accounts, customers):
    land(w, "accounts", batch, delivery("accounts", f"{at:%Y%m%d}", accounts), at)
    land(w, "customers", batch, delivery("customers", f"{at:%Y%m%d}", customers), at)


def start_bank(w, d):
    at = dt.datetime(2024, 5, 4, 6)
    land_reference(w, "one", at, [account(i) for i in range(6)], [customer(i, "2023-06-01 00:00:00") for i in range(4)] + [customer(1, "2024-02-10 00:00:00", "PRIVATE", "HIGH")])
    land(w, "merchants", "one", delivery("merchants", "20240101", [dict(merchant_id=f"M{i}", merchant_name="m", mcc="5411", country_code="DE") for i in range(3)]), at)
    land(w, "fx_rates", "one", delivery("fx_rates", "20240101", [dict(rate_date=x, currency="USD", rate_to_eur="0.9", source="s") for x in ("2023-12-01", "2024-06-10")]), at)
    land(w, "transactions", "one", delivery("transactions", "20240503", d["first"]) + delivery("transactions", "20240502", d["alone"]), at)


def second_round(w, d):
    at = dt.datetime(2024, 5, 6, 6)
    land_reference(w, "two", at, [account(8, "2024-01-20")], [customer(2, "2024-04-01 00:00:00", "BUSINESS")])
    land(w, "transactions", "two", delivery("transactions", "20240505", d["second"]) + delivery("transactions", "20231231", d["older"]), at)


def rebuilt(spark, w, folder):
    full = Warehouse(spark, str(folder))
    for e in LOAD_ORDER:
        full.append(w.read(f"raw_{e}"), f"raw_{e}", "all")
    return build(full, P, full_refresh=True)


def assert_same(step, whole):
    for name in DERIVED:
        assert symmetric_diff(step[name], whole[name], ("source_loaded_through",)).count() == 0, name


def test_interrupted_builds_end_where_a_rebuild_does(spark, tmp_path, deliveries, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "wh"))
    start_bank(w, deliveries)
    build(w, P)
    old = {name: w.versions(name)[-1] for name in DERIVED}
    reader = w.read("fct_account_daily_balance")
    seen = sorted(map(tuple, reader.collect()))
    second_round(w, deliveries)

    written = []

    def dying(df, name, *args, real=w.write, **more):
        if name == last:
            raise RuntimeError("died")
        written.append(name)
        return real(df, name, *args, **more)

    for last in ("fct_account_daily_balance", "rpt_merchant_category_spend"):  # after the fact; after nearly all
        written.clear()
        with monkeypatch.context() as m:
            m.setattr(w, "write", dying)
            with pytest.raises(RuntimeError, match="died"):
                build(w, P)
        assert "fct_transactions" in written and {name: w.versions(name)[-1] for name in DERIVED} == old
    again = Warehouse(spark, str(tmp_path / "wh"))  # another process, after the crash
    step = build(again, P)
    assert sorted(map(tuple, reader.collect())) == seen  # a reader keeps the tables it began with
    assert_same(step, rebuilt(spark, w, tmp_path / "full"))
    assert "Q" not in {r[0] for r in step["dq_rejected_transactions"].select("account_id").distinct().collect()}
    assert step["fct_transactions"].where("txn_id = 'T900'").count() == 1  # an older delivery neither replaces nor removes it
    assert step["fct_transactions"].where("account_id = 'A8'").count() == 6  # released with their account
    # a quiet day leaves the months before it as they are
    months = lambda name: {part: at for part, at in again.versions(name)[-1].folders.items()}
    kept = {name: months(name) for name in ("fct_transactions", "aml_alert_transactions", "rpt_monthly_customer_summary", "int_monthly_spend")}
    land(again, "transactions", "three", delivery("transactions", "20240507", deliveries["third"]), dt.datetime(2024, 5, 8, 6))
    quiet = build(again, P)
    for name, parts in kept.items():
        assert {p: at for p, at in months(name).items() if p < "txn_month=2024-04"} == {p: at for p, at in parts.items() if p < "txn_month=2024-04"}, name
    assert_same(quiet, rebuilt(spark, again, tmp_path / "full3"))
    again.drop_older(keep=1)
    assert again.read("fct_transactions").count() == quiet["fct_transactions"].count()


def test_failing_gates_leave_the_old_tables(spark, tmp_path, deliveries, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "wh"))
    start_bank(w, deliveries)
    with monkeypatch.context() as m:
        m.setattr(builds.staging, "stg_merchants", lambda raw, real=builds.staging.stg_merchants: real(raw).unionByName(real(raw)))
        with pytest.raises(ChecksFailed, match="dim_merchant.unique.merchant_id"):
            build(w, P)
    assert w.read("dim_merchant") is None and w.read("fct_transactions") is None
    with monkeypatch.context() as m:
        lossy = lambda news, *args, real=builds.core.fct_transactions: real(news.where("txn_id <> 'T7'"), *args)
        m.setattr(builds.core, "fct_transactions", lossy)
        with pytest.raises(ReconciliationFailed):
            build(w, P, check=False)
    assert w.versions("fct_transactions") == []


FACT = "txn_id string, txn_month string, amount int, _source_file string"


def test_a_month_whose_only_row_wins_stays(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    rows = lambda *r: spark.createDataFrame(list(r), FACT).coalesce(1)
    merge = lambda old, batch, removed=None: merge_by_partition(w, "t", old, batch, ["txn_id"], ["_source_file"], "txn_month", removed=removed)
    merge(None, rows(("T1", "2024-02", 1, "f0202"), ("T2", "2024-03", 2, "f0202")))
    w.publish()
    got, touched = merge(w.read("t"), rows(("T1", "2024-01", 9, "f0201")))  # loses
    assert touched == [] and sorted(map(tuple, got.select("txn_id", "txn_month", "amount").collect())) == [("T1", "2024-02", 1), ("T2", "2024-03", 2)]
    got, touched = merge(w.read("t"), rows(("T1", "2024-01", 9, "f0201"), ("T1", "2024-02", 3, "f0202"), ("T3", "2024-02", 3, "f0301")))
    assert touched == ["2024-02"] and {(r[0], r[1]) for r in got.select("txn_id", "txn_month").collect()} == {("T1", "2024-02"), ("T2", "2024-03"), ("T3", "2024-02")}
    w.publish()
    got, _ = merge(w.read("t"), rows(("T1", "2024-01", 9, "f0301")))  # now it wins, and moves
    w.publish()
    assert {r["txn_id"]: r["txn_month"] for r in w.read("t").collect()} == {"T1": "2024-01", "T2": "2024-03", "T3": "2024-02"}
    got, _ = merge(w.read("t"), rows(("T9", "2024-05", 1, "f")), removed=rows(("T2", "", 0, "")))
    assert {r[0] for r in got.select("txn_id").collect()} == {"T1", "T3", "T9"}


def test_nothing_counts_before_it_is_published(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    w.replace(spark.range(3).withColumn("m", F.lit("a")), "t", partition_by="m")
    pending = w.write(spark.range(5).withColumn("m", F.lit("b")), "t", "m", [])
    assert w.read("t").count() == 3 and pending.count() == 8
    w.discard()
    w.drop_older()
    assert w.read("t").count() == 3 and sum(p.name.startswith("write=") for p in (tmp_path / "t").iterdir()) == 1
    w.write(spark.range(7).withColumn("m", F.lit("a")), "t", "m", [])  # added to a partition, which keeps its files
    w.write(spark.range(1).select("id", F.lit(2).alias("more")), "u")
    other = Warehouse(spark, str(tmp_path))
    other.replace(spark.range(2), "v")
    with pytest.raises(RuntimeError, match="published"):
        w._lists = lambda: ["0000000000.json"]  # as this process saw it before the other one published
        w.publish()
    del w._lists
    w.publish()
    assert (w.read("t").count(), w.read("u").columns, w.read("v").count()) == (10, ["id", "more"], 2)
