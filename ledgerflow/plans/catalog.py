"""Registered queries over the driver's tables. Their DuckDB formulations are in `oracle`, written independently."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.functions.columns import mask_email, mask_iban, masked_view
from ledgerflow.operators import change, quality
from ledgerflow.operators.rank import percent_rank
from ledgerflow.operators.temporal import as_of_join, latest_by, trailing_counts
from ledgerflow.plans import aml, controls, core, finance, oracle, reports, staging
from ledgerflow.plans.checks import model_checks, stale_rates
from ledgerflow.sources import adapters
from ledgerflow.sources.scratch import hold
from ledgerflow.sources.seeds import mcc_codes, transaction_types
from ledgerflow.streaming.events import decode_events, encode_events
from ledgerflow.streaming.landing import exactly_once, latency, missed_alerts, screen_large

#: Thresholds that find something in the driver's small amounts.
PARAMS = Params(
    structuring_floor_eur=20, structuring_ceiling_eur=100, structuring_min_count=2, structuring_window_minutes=1440, velocity_window_minutes=720, velocity_min_count=3, outlier_min_history=10, outlier_min_zscore=2.0, outlier_min_amount_eur=0
)
LARGE = 400_000


class Ledger:
    """The tables of the ledger over one directory, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str, counted: bool = False):
        self.spark, self.dir, self.counted = spark, sf_dir, counted

    @cached_property
    def numbered(self) -> Ledger:
        """The same with transactions' row numbers counted along each file, for queries that return them."""
        return Ledger(self.spark, self.dir, counted=True)

    def table(self, name: str) -> DataFrame:
        return adapters.table(self.spark, self.dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return adapters.raw_transactions(self.spark, self.dir, self.counted)

    @cached_property
    def staged(self) -> DataFrame:
        return staging.stg_transactions(self.raw)

    @cached_property
    def accounts(self) -> DataFrame:
        return core.dim_account(core.current_accounts(staging.stg_accounts(adapters.raw_accounts(self.spark, self.dir))))

    @cached_property
    def customers(self) -> DataFrame:
        return core.dim_customer(staging.stg_customers(adapters.raw_customers(self.spark, self.dir)))

    @cached_property
    def merchants(self) -> DataFrame:
        return core.dim_merchant(staging.stg_merchants(adapters.raw_merchants(self.spark, self.dir)), mcc_codes(self.spark))

    @cached_property
    def fx(self) -> DataFrame:
        return core.fx_daily(staging.stg_fx_rates(adapters.raw_fx_rates(self.spark, self.dir)))

    @cached_property
    def validated(self) -> DataFrame:
        return core.validate(self.staged, self.accounts)

    @cached_property
    def quarantined(self) -> DataFrame:
        return core.quarantine(self.validated)

    @cached_property
    def fct(self) -> DataFrame:
        return core.fct_transactions(self.validated, self.fx, transaction_types(self.spark))

    @cached_property
    def held_fct(self) -> DataFrame:
        """The fact as a table, for queries that use it several times."""
        return hold(self.fct)

    @cached_property
    def balances(self) -> DataFrame:
        return core.daily_balance(self.fct, self.accounts, self.fx)

    @cached_property
    def members(self) -> DataFrame:
        return aml.alert_members(self.fct, PARAMS)

    @cached_property
    def messages(self) -> DataFrame:
        return adapters.raw_stream(self.spark, self.dir)

    @cached_property
    def landed(self) -> DataFrame:
        return decode_events(self.messages)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = oracle.ORACLE


def query(f: Callable[[Ledger], DataFrame]) -> Callable[[Ledger], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Ledger(spark, sf_dir))
    return f


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in names})


# ---- staging and validation
@query
def stg_transactions_typed(l: Ledger) -> DataFrame:
    return l.numbered.staged


@query
def stg_customers_typed(l: Ledger) -> DataFrame:
    return staging.stg_customers(adapters.raw_customers(l.spark, l.dir))


@query
def stg_fx_latest(l: Ledger) -> DataFrame:
    return staging.stg_fx_rates(adapters.raw_fx_rates(l.spark, l.dir)).select("rate_date", "currency", "rate_to_eur", "source")


@query
def stg_stream_typed(l: Ledger) -> DataFrame:
    return staging.stg_transactions_stream(l.landed).drop("_ingested_at", "_parse_error").withColumn("_kafka_partition", F.col("_kafka_partition").cast("long"))


@query
def txn_validated(l: Ledger) -> DataFrame:
    return l.numbered.validated.select("txn_id", "_source_file", "_source_row", "rejection_reason", "warning_reason")


@query
def txn_quarantine(l: Ledger) -> DataFrame:
    return l.numbered.quarantined


@query
def txn_reason_counts(l: Ledger) -> DataFrame:
    return l.quarantined.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def txn_latest_version(l: Ledger) -> DataFrame:
    return latest_by(l.staged, ["txn_id"], staging.BY_FILE).select("txn_id", "_source_file", "_loaded_at")


# ---- dimensions, rates, facts, balances
@query
def fx_daily_fill(l: Ledger) -> DataFrame:
    return l.fx


@query
def dim_date(l: Ledger) -> DataFrame:
    """The calendar over the years that the orders cover."""
    first, last = l.table("orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return longs(core.dim_date(l.spark, Params(calendar_start=dt.date(first, 1, 1), calendar_end=dt.date(last + 1, 1, 1))), "year_number", "quarter_number", "month_number", "day_of_month", "iso_day_of_week")


@query
def dim_account(l: Ledger) -> DataFrame:
    return l.accounts


@query
def dim_merchant(l: Ledger) -> DataFrame:
    return l.merchants


@query
def customer_scd2(l: Ledger) -> DataFrame:
    return l.customers


@query
def customer_scd2_incremental(l: Ledger) -> DataFrame:
    """The customers' histories from three deliveries, the last of which comes between the others in time."""
    feed = staging.stg_customers(adapters.raw_customers(l.spark, l.dir))
    key, at, tie = "customer_id", "updated_at", ["_source_file", "_source_row"]
    part = F.pmod(F.xxhash64(key, at), F.lit(3))
    versions = history = None
    for n in (0, 2, 1):
        news = feed.where(part == n)
        versions = hold(change.splice_versions(versions, news, key, at, tie))
        history = change.scd2_from_versions(versions, key, at, core.CUSTOMER_STATE) if history is None else change.splice_scd2(history, versions, news, key, at, core.CUSTOMER_STATE)
        history = hold(history)
    return core.customer_columns(history)


@query
def customer_as_of(l: Ledger) -> DataFrame:
    """The state of its customer at the moment of each order."""
    o = l.table("orders").select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey")).alias("customer_id"), F.timestamp_add("HOUR", F.lit(12), F.col("o_orderdate")).alias("at"))
    return as_of_join(o, l.customers, "customer_id", F.col("at"), keep=("segment", "risk_rating")).select("o_orderkey", "customer_id", "segment", "risk_rating")


@query
def customer_month_end(l: Ledger) -> DataFrame:
    """The state of its customer at the end of each order's month."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month_start")
    o = l.table("orders").select(F.concat(F.lit("C"), F.col("o_custkey")).alias("customer_id"), month).distinct()
    return as_of_join(o, l.customers, "customer_id", F.add_months("month_start", 1).cast("timestamp_ntz"), "before", ("segment", "risk_rating"))


@query
def fct_transactions(l: Ledger) -> DataFrame:
    return l.numbered.fct


@query
def account_daily_balance(l: Ledger) -> DataFrame:
    return l.balances


@query
def account_daily_balance_incremental(l: Ledger) -> DataFrame:
    """Balances built from what was loaded up to the 20th, then brought up to date with the rest."""
    cut = F.col("_loaded_at") < F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    early = core.fct_transactions(l.validated.where(cut), l.fx, transaction_types(l.spark))
    return core.incremental_balance(core.daily_balance(early, l.accounts, l.fx), l.fct, l.accounts, l.fx, early)


# ---- money laundering and finance
@query
def aml_structuring(l: Ledger) -> DataFrame:
    return aml.structuring(l.fct, PARAMS)


@query
def aml_velocity(l: Ledger) -> DataFrame:
    return aml.velocity(l.fct, PARAMS)


@query
def aml_outlier(l: Ledger) -> DataFrame:
    return aml.outlier(l.fct, PARAMS)


@query
def aml_alert_members(l: Ledger) -> DataFrame:
    return l.members


@query
def aml_alerts(l: Ledger) -> DataFrame:
    return aml.alerts(l.members, l.accounts, l.customers)


@query
def monthly_customer_summary(l: Ledger) -> DataFrame:
    fct = l.held_fct
    out = finance.monthly_customer_summary(fct, core.daily_balance(fct, l.accounts, l.fx), l.accounts, l.customers, hold)
    return out.withColumn("card_spend_percentile_in_segment", F.round("card_spend_percentile_in_segment", 6))


@query
def merchant_category_spend(l: Ledger) -> DataFrame:
    return finance.merchant_category_spend(l.held_fct, l.merchants)


# ---- controls
@query
def file_summary(l: Ledger) -> DataFrame:
    return controls.file_summary(l.validated)


@query
def stream_vs_batch(l: Ledger) -> DataFrame:
    """The stream having lost one event in four, and every event from 24 January on."""
    heard = l.messages.where((F.col("n") % 4 != 0))
    streamed = staging.stg_transactions_stream(decode_events(heard)).where(F.col("txn_ts") < F.lit("2024-01-24 00:00:00").cast("timestamp_ntz"))
    return controls.stream_vs_batch(streamed, l.staged, hold)


@query
def reconciliation(l: Ledger) -> DataFrame:
    return controls.reconcile(l.raw, l.quarantined, l.fct)


@query
def row_accounting(l: Ledger) -> DataFrame:
    return controls.row_accounting(l.raw, l.validated, l.quarantined, l.fct)


@query
def balance_identity(l: Ledger) -> DataFrame:
    """Accounts whose balances don't add up after one in nine balances was shifted."""
    number = F.substring("account_id", 2, 20).cast("long")
    shifted = l.balances.withColumn("closing_balance", (F.col("closing_balance") + F.when(number % 9 == 0, F.lit(1)).otherwise(F.lit(0))).cast("decimal(18,2)"))
    return controls.balance_identity(l.fct, shifted, l.accounts)


@query
def reversal_match(l: Ledger) -> DataFrame:
    """Reversals that match nothing, after one reversal in ten was given another amount."""
    number = F.substring("txn_id", 2, 20).cast("long")
    spoilt = F.when((F.col("txn_type") == "REVERSAL") & (number % 10 == 0), F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,2)")
    return controls.unmatched_reversals(l.fct.withColumn("amount", spoilt))


@query
def detection_report(l: Ledger) -> DataFrame:
    """Rows with a planted fault against rows rejected for it."""
    n = F.substring("txn_id", 2, 20).cast("long")
    plants = {"INVALID_AMOUNT": n % 331 == 1, "NEGATIVE_AMOUNT": n % 337 == 2, "ZERO_AMOUNT": n % 347 == 3, "UNKNOWN_ACCOUNT": n % 349 == 4, "MISSING_TIMESTAMP": n % 353 == 5, "INVALID_DIRECTION": n % 359 == 6, "INVALID_TIMESTAMP": n % 367 == 7}
    planted = l.staged.select("txn_id", F.explode(F.array_compact(F.array(*[F.when(t, k) for k, t in plants.items()]))).alias("rejection_reason"))
    out = controls.detection_report(planted, l.quarantined, "rejection_reason", "txn_id")
    return out.withColumns({c: F.round(c, 6) for c in ("recall", "precision")})


@query
def ground_truth_report(l: Ledger) -> DataFrame:
    """All that was planted in the delivered rows (faults, repeats, late files, card payments without a merchant, currencies in small letters) against what was found."""
    n = F.substring("txn_id", 2, 20).cast("long")
    card = F.col("txn_type") == "CARD_PAYMENT"
    plants = {"INVALID_AMOUNT": n % 331 == 1, "NEGATIVE_AMOUNT": n % 337 == 2, "ZERO_AMOUNT": n % 347 == 3, "UNKNOWN_ACCOUNT": n % 349 == 4, "MISSING_TIMESTAMP": n % 353 == 5, "INVALID_DIRECTION": n % 359 == 6, "INVALID_TIMESTAMP": n % 367 == 7}
    plants |= {"DUPLICATE_ROW": n % 97 == 0, "LATE_ARRIVAL": n % 50 == 1, "MISSING_MERCHANT": card & (n % 13 == 0), "LOWERCASE_CURRENCY": n % 11 == 0}
    sent = l.raw.select("txn_id", "txn_type").distinct()
    planted = sent.select("txn_id", F.explode(F.array_compact(F.array(*[F.when(t, k) for k, t in plants.items()]))).alias("issue"))
    return controls.ground_truth(planted, l.validated, l.fct)


@query
def aml_case_recall(l: Ledger) -> DataFrame:
    """Days of three card attempts or two deposits in the band, as injected cases, against the alerts that hold one of their transactions."""
    band = (F.col("amount_eur") >= PARAMS.structuring_floor_eur) & (F.col("amount_eur") < PARAMS.structuring_ceiling_eur)
    rule = F.when(F.col("txn_type") == "CARD_PAYMENT", "VELOCITY").when((F.col("txn_type") == "CASH_DEPOSIT") & F.col("is_posted") & band, "STRUCTURING")
    events = l.fct.select(rule.alias("rule"), F.concat_ws("|", "account_id", F.col("txn_date").cast("string")).alias("case_id"), "txn_id").where("rule is not null")
    dense = events.groupBy("rule", "case_id").count().where("count >= if(rule = 'VELOCITY', 3, 2)").drop("count")
    out = controls.case_recall(events.join(dense, ["rule", "case_id"], "left_semi"), l.members)
    return out.withColumn("precision", F.round("precision", 6))


@query
def fx_stale_rates(l: Ledger) -> DataFrame:
    return stale_rates(l.fx)


@query
def model_check_results(l: Ledger) -> DataFrame:
    """Failing rows of each check of the fact, its accounts and merchants, as one table."""
    every = model_checks({"fct_transactions": l.fct, "dim_account": l.accounts, "dim_merchant": l.merchants})
    return reduce(DataFrame.unionByName, map(quality.check_rows, every))


# ---- incremental layer
def _order_batches(l: Ledger) -> tuple[DataFrame, DataFrame]:
    """Orders in two deliveries: the second repeats one in five of the first with another status, and brings the rest."""
    o = l.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.col("o_orderdate").cast("date").alias("order_date"))
    k = F.col("o_orderkey")
    first = o.where(k % 3 != 0).withColumn("delivery", F.lit(1).cast("long"))
    return first, o.where((k % 3 == 0) | (k % 5 == 0)).withColumns({"o_orderstatus": F.lit("X"), "delivery": F.lit(2).cast("long")})


@query
def incremental_upsert(l: Ledger) -> DataFrame:
    first, second = _order_batches(l)
    return change.upsert(change.upsert(None, first, ["o_orderkey"], ["delivery"]), second, ["o_orderkey"], ["delivery"])


@query
def incremental_equals_rebuild(l: Ledger) -> DataFrame:
    """Rows in which an incremental merge and a rebuild differ, after one in a hundred was spoilt."""
    first, second = _order_batches(l)
    merged = change.upsert(first, second, ["o_orderkey"], ["delivery"])
    rebuilt = latest_by(first.unionByName(second), ["o_orderkey"], ["delivery"])
    spoilt = rebuilt.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 100 == 7, "?").otherwise(F.col("o_orderstatus")))
    return change.symmetric_diff(merged, spoilt, exclude=("delivery",))


@query
def account_snapshot(l: Ledger) -> DataFrame:
    """Three snapshots of customers: every second one changed in the second run, every third one in the last."""
    c = l.table("customer").select(F.concat(F.lit("A"), "c_custkey").alias("account_id"), "c_custkey", F.col("c_mktsegment").alias("segment"))
    at = lambda day, every: c.withColumn("updated_at", F.when(F.col("c_custkey") % every == 0, F.lit(f"2024-01-{day:02d} 00:00:00")).otherwise(F.lit("2024-01-01 00:00:00")).cast("timestamp_ntz")).drop("c_custkey")
    runs = [at(1, 1), at(10, 2), at(20, 3)]
    return reduce(lambda t, run: change.snapshot(t, run, "account_id", "updated_at"), runs, None)


# ---- streaming, over what would be its landed tables
def _paths(l: Ledger) -> DataFrame:
    """Large orders on a file and a stream path; one in five comes by both, one in seven twice."""
    o, k = l.table("orders"), F.col("o_orderkey")
    by = F.when(k % 5 == 0, F.array(F.lit("FILE"), F.lit("KAFKA"))).when(k % 2 == 0, F.array(F.lit("FILE"))).otherwise(F.array(F.lit("KAFKA")))
    rows = o.select(k, F.concat(F.lit("T"), k).alias("txn_id"), F.concat(F.lit("A"), "o_custkey").alias("account_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.lit("EUR").alias("currency"), F.lit("FEE").alias("txn_type"),
                    F.when(k % 11 == 0, "DECLINED").otherwise("POSTED").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("txn_ts_raw"), F.col("o_orderdate").alias("produced"), F.explode(by).alias("ingest_path"))
    copies = rows.withColumn("copy", F.explode(F.when(k % 7 == 0, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0)))))
    return copies.withColumns(
        {
            "produced_at": F.when(F.col("ingest_path") == "KAFKA", F.col("produced")),
            "landed_at": F.timestamp_add("SECOND", (k % 60 + F.col("copy") * 100).cast("int"), F.col("produced")),
            "_source_file": F.when(F.col("ingest_path") == "FILE", F.concat(F.lit("f"), F.col("copy").cast("string"))),
        }
    ).drop("copy", "produced")


def _alerts(l: Ledger) -> DataFrame:
    found = screen_large(_paths(l), None, LARGE, detected_at=dt.datetime(2002, 1, 1))
    return found.withColumn("detected_at", F.timestamp_add("SECOND", F.lit(90), F.col("landed_at")))


@query
def large_txn_alerts(l: Ledger) -> DataFrame:
    """Alerts of the second run; the first had seen orders before 1998."""
    early = F.col("txn_ts_raw") < "1998-01-01"
    before = screen_large(_paths(l).where(early), None, LARGE)
    return screen_large(_paths(l), before, LARGE).drop("detected_at")


@query
def missed_stream_alerts(l: Ledger) -> DataFrame:
    """File alerts without a stream alert, the stream having lost one in three."""
    k = F.substring("txn_id", 2, 20).cast("long")
    kept = _alerts(l).where((F.col("ingest_path") == "FILE") | (k % 3 != 0))
    return missed_alerts(kept, _paths(l).where("ingest_path = 'KAFKA'").select("txn_id").distinct()).select("txn_id", "ingest_path", "amount")


@query
def stream_latency(l: Ledger) -> DataFrame:
    return latency(_alerts(l)).withColumns({c: F.round(c, 6) for c in ("p50_s", "p95_s", "max_s")})


@query
def exactly_once_check(l: Ledger) -> DataFrame:
    """Landed messages, one in a thousand lost and one in 700 doubled, against the offsets of each partition."""
    expected = l.messages.groupBy("partition").agg(F.lit(0).cast("long").alias("low"), (F.max("offset") + 1).alias("high"))
    rows = l.landed.where((F.col("_kafka_offset") % 1000 != 999) | (F.col("_kafka_partition") == 0))
    doubled = rows.unionByName(rows.where((F.col("_kafka_offset") % 700 == 699) & (F.col("_kafka_partition") == 1)))
    return longs(exactly_once(doubled, expected), "partition", "low", "high")


@query
def event_encode(l: Ledger) -> DataFrame:
    return encode_events(l.raw).select("key", "value")


@query
def event_decode(l: Ledger) -> DataFrame:
    return l.landed.select(*l.landed.columns[:14], F.col("_kafka_partition").cast("long").alias("_kafka_partition"), "_kafka_offset", "_raw_value", F.col("_parse_error").isNotNull().alias("failed"))


# ---- analyst queries
def _events(l: Ledger) -> DataFrame:
    return l.table("events").select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("amount"))


@query
def running_balance_window(l: Ledger) -> DataFrame:
    return reports.running_balance(_events(l), "user_id", "ts", "event_id", "amount")


@query
def running_balance_split(l: Ledger) -> DataFrame:
    """The same with every user of more than 20 events cut in time, and the sums carried over the cuts."""
    return reports.running_balance(_events(l), "user_id", "ts", "event_id", "amount", hot_rows=20)


@query
def trailing_counts_split(l: Ledger) -> DataFrame:
    """Events of each user in the 12 hours up to each event, users of more than 20 events being cut in time."""
    rows = _events(l).select("event_id", "user_id", "ts")
    return trailing_counts(rows, ["user_id"], "ts", 720, "n", hot_rows=20).select("event_id", "n")


@query
def order_price_percent_rank(l: Ledger) -> DataFrame:
    """The place of each order's price among those of its year and status, by counts of values and ranges."""
    o = l.table("orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("year"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return percent_rank(o, ["year", "o_orderstatus"], "amount", "share").select("o_orderkey", F.round("share", 6).alias("share"))


@query
def active_accounts_by_quarter(l: Ledger) -> DataFrame:
    """Active accounts of each quarter, exact, and whether the estimate from two deliveries' merged monthly sketches is within a twentieth."""
    o, k = l.table("orders"), F.col("o_orderkey")
    stored = reports.merge_sketches(None, reports.active_sketches(o.where(k % 3 != 0), "o_orderdate", "o_custkey"))
    merged = reports.merge_sketches(stored, reports.active_sketches(o.where(k % 3 == 0), "o_orderdate", "o_custkey"))
    close = reports.active_in_spans(merged, F.trunc("month_start", "quarter"), "quarter_start").withColumnRenamed("active", "estimate")
    exact = o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("quarter_start")).agg(F.countDistinct("o_custkey").alias("active"))
    return exact.join(close, "quarter_start").select("quarter_start", "active", (F.abs(F.col("active") - F.col("estimate")) <= F.greatest(F.lit(1.0), F.col("active") / 20)).alias("within_a_twentieth"))


@query
def running_balance_self_join(l: Ledger) -> DataFrame:
    return reports.running_balance_self_join(_events(l), "user_id", "ts", "event_id", "amount")


@query
def month_report_range(l: Ledger) -> DataFrame:
    return reports.month_report(l.table("lineitem").withColumn("amount", F.col("l_extendedprice").cast("decimal(18,2)")), "l_shipdate", "l_returnflag", "amount", dt.date(1996, 3, 1))


@query
def month_report_wrapped(l: Ledger) -> DataFrame:
    """The month report by a function of the date, which no scan can skip by: the slow half of the pair."""
    rows = l.table("lineitem").withColumn("amount", F.col("l_extendedprice").cast("decimal(18,2)"))
    return reports.month_report_wrapped(rows, "l_shipdate", "l_returnflag", "amount", "1996-03")


@query
def largest_transactions(l: Ledger) -> DataFrame:
    """The ten largest transactions in euro; of equal ones the smaller id comes first."""
    return reports.top_k(l.fct, [F.desc("amount_eur"), F.col("txn_id")], 10).select("txn_id", "account_id", "amount_eur")


@query
def active_accounts_approx_error(l: Ledger) -> DataFrame:
    """Exact active accounts of each month, and whether the approximate count is within a twentieth."""
    exact, close = (reports.active_by_month(l.table("orders"), "o_orderdate", "o_custkey", approximate=x) for x in (False, True))
    both = exact.join(close.withColumnRenamed("active", "approximate"), "month_start")
    return both.select("month_start", "active", (F.abs(F.col("active") - F.col("approximate")) <= F.greatest(F.lit(1.0), F.col("active") / 20)).alias("within_a_twentieth"))


@query
def active_accounts_exact(l: Ledger) -> DataFrame:
    return reports.active_by_month(l.table("orders"), "o_orderdate", "o_custkey")


@query
def active_accounts_approx(l: Ledger) -> DataFrame:
    return reports.active_by_month(l.table("orders"), "o_orderdate", "o_custkey", approximate=True)


@query
def full_history_rollup(l: Ledger) -> DataFrame:
    rows = l.table("lineitem").withColumn("amount", F.col("l_extendedprice").cast("decimal(18,2)"))
    return reports.history_rollup(rows, "l_shipdate", ["l_returnflag", "l_linestatus"], "amount")


@query
def point_lookup(l: Ledger) -> DataFrame:
    return reports.point_lookup(l.table("orders"), "o_orderkey", 777).select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))


@query
def amplified_volume(l: Ledger) -> DataFrame:
    """Orders a month after making 40 shifted copies of each."""
    many = reports.amplify(l.table("orders"), 40, "o_orderkey", "o_orderdate")
    return many.groupBy(F.trunc("o_orderdate", "month").alias("month_start")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("total"))


# ---- masking
@query
def masked_emails(l: Ledger) -> DataFrame:
    c = l.table("customer").select("c_custkey", F.concat(F.lit("user"), "c_custkey", F.lit("@example.com")).alias("email"))
    return c.select("c_custkey", mask_email(F.col("email")).alias("email"))


@query
def masked_ibans(l: Ledger) -> DataFrame:
    return l.accounts.select("account_id", mask_iban(F.col("iban")).alias("iban"))


@query
def masked_accounts(l: Ledger) -> DataFrame:
    return masked_view(l.accounts, privileged=False).select("account_id", "iban", "currency")


# ---- quality checks: the rows that fail
@query
def dq_not_null(l: Ledger) -> DataFrame:
    return quality.not_null(l.numbered.validated, "merchant_id").select("txn_id", "_source_file", "_source_row")


@query
def dq_unique(l: Ledger) -> DataFrame:
    return quality.unique(l.staged, "txn_id")


@query
def dq_accepted_values(l: Ledger) -> DataFrame:
    return quality.accepted_values(l.staged, "direction", ["DR", "CR"]).select("txn_id", "direction", "_source_file")


@query
def dq_relationships(l: Ledger) -> DataFrame:
    return quality.relationships(l.staged, "account_id", l.accounts, "account_id").select("txn_id", "account_id", "_source_file")


@query
def dq_expression_is_true(l: Ledger) -> DataFrame:
    return quality.expression_is_true(l.staged, "amount > 0", "txn_type = 'CARD_PAYMENT'").select("txn_id", "amount", "_source_file")


@query
def dq_unique_combination(l: Ledger) -> DataFrame:
    return quality.unique_combination(l.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_within_range(l: Ledger) -> DataFrame:
    return quality.within_range(l.fct, "amount_eur", 5, 400).select("txn_id", "amount_eur")


@query
def dq_freshness(l: Ledger) -> DataFrame:
    tables = {"transactions": l.raw, "fx_rates": adapters.raw_fx_rates(l.spark, l.dir), "accounts": adapters.raw_accounts(l.spark, l.dir)}
    return quality.freshness(tables, dt.datetime(2024, 2, 6, 12), exempt=("accounts",)).withColumn("age_hours", F.round("age_hours", 6))
