"""Validation, facts, dimensions and balances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.functions.columns import month_start
from ledgerflow.operators.change import scd2_from_feed
from ledgerflow.operators.temporal import date_spine, explode_days, forward_fill, latest_by
from ledgerflow.plans.staging import BY_FILE

MONEY = "decimal(18,2)"
CUSTOMER_STATE = ["first_name", "last_name", "email", "country_code", "segment", "risk_rating", "kyc_status"]


def current_accounts(stg_accounts: DataFrame) -> DataFrame:
    return latest_by(stg_accounts, ["account_id"], ["updated_at", "_source_file", "_source_row"])


def dim_account(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "account_id", "customer_id", "iban", "account_type", "currency", "status", (F.col("status") == "ACTIVE").alias("is_active"), "opened_date", "closed_date", "opening_balance", "updated_at"
    )


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    """Every state a customer was in. A change of birth date alone is not a new state."""
    return customer_columns(scd2_from_feed(stg_customers, "customer_id", "updated_at", CUSTOMER_STATE, ["_source_file", "_source_row"]))


def customer_columns(history: DataFrame) -> DataFrame:
    return history.select(
        F.col("version_key").alias("customer_version_key"), "customer_id", "first_name", "last_name", "email", "birth_date", "country_code", "segment", "risk_rating", "kyc_status", "created_at", "valid_from", "valid_to", "is_current"
    )


def dim_merchant(stg_merchants: DataFrame, mcc_codes: DataFrame) -> DataFrame:
    m = stg_merchants.join(F.broadcast(mcc_codes), "mcc", "left")
    return m.select("merchant_id", "merchant_name", "mcc", F.coalesce("mcc_description", F.lit("Unknown")).alias("mcc_description"), F.coalesce("spend_category", F.lit("Other")).alias("spend_category"), "country_code")


def dim_date(spark: SparkSession, p: Params = Params()) -> DataFrame:
    d = F.col("date_day")
    iso = F.weekday(d) + 1
    return date_spine(spark, p.calendar_start, p.calendar_end).select(
        d, F.year(d).alias("year_number"), F.quarter(d).alias("quarter_number"), F.month(d).alias("month_number"), F.dayofmonth(d).alias("day_of_month"), iso.alias("iso_day_of_week"), (iso >= 6).alias("is_weekend"),
        month_start(d).alias("month_start_date"), F.last_day(d).alias("month_end_date"),
    )


def fx_daily(stg_fx: DataFrame, p: Params = Params()) -> DataFrame:
    """A rate for each day and currency, carried forward over days without one; the euro is 1."""
    known = stg_fx.where("currency <> 'EUR' and rate_to_eur is not null and rate_date is not null")
    filled = forward_fill(known, "currency", "rate_date", "rate_to_eur", p.fx_forward_fill_days)
    euro = filled.select("rate_date").distinct().select(F.lit("EUR").alias("currency"), "rate_date", F.lit(1).cast("decimal(18,8)").alias("rate_to_eur"), F.col("rate_date").alias("published"))
    return filled.unionByName(euro).select("rate_date", "currency", "rate_to_eur", F.col("published").alias("published_date"), (F.col("rate_date") != F.col("published")).alias("is_carried_forward"))


def validate(txns: DataFrame, accounts: DataFrame) -> DataFrame:
    """txns with rejection_reason (the first rule that fails, or null), warning_reason and the account's currency.

    No row is lost. A blank id or time is there, so it isn't missing; a blank time is invalid. accounts: one row an account. Both sides keep their own size: the join shuffles on account_id and
    the optimiser broadcasts accounts where they are small."""
    a = accounts.select(F.col("account_id").alias("_account"), F.col("currency").alias("account_currency"), "customer_id")
    joined = txns.join(a, txns.account_id == F.col("_account"), "left")
    # The reasons, in the order in which they apply.
    rules: list[tuple[Column, str]] = [
        (F.col("txn_id").isNull(), "MISSING_TXN_ID"),
        (F.col("txn_ts_raw").isNull(), "MISSING_TIMESTAMP"),
        (F.col("txn_ts").isNull(), "INVALID_TIMESTAMP"),
        (F.col("amount").isNull(), "INVALID_AMOUNT"),
        (F.col("amount") < 0, "NEGATIVE_AMOUNT"),
        (F.col("amount") == 0, "ZERO_AMOUNT"),
        (F.col("_account").isNull(), "UNKNOWN_ACCOUNT"),
        (F.col("direction").isNull() | ~F.col("direction").isin("DR", "CR"), "INVALID_DIRECTION"),
        (F.col("currency") != F.col("account_currency"), "CURRENCY_MISMATCH"),
    ]
    # End of the fixed values.
    reason = F.coalesce(*[F.when(test, name) for test, name in rules])
    warning = F.when((F.col("txn_type") == "CARD_PAYMENT") & F.col("merchant_id").isNull(), "MISSING_MERCHANT")
    return joined.withColumns({"rejection_reason": reason, "warning_reason": warning}).drop("_account")


def quarantine(validated: DataFrame) -> DataFrame:
    """Rejected rows as they came, with their reason; (_source_file, _source_row) is the key."""
    return validated.where("rejection_reason is not null").select(
        "txn_id", "account_id", "txn_ts_raw", "amount_raw", "currency", "direction", "txn_type", "rejection_reason", "_source_file", "_source_row", "_loaded_at"
    )


def fct_transactions(validated: DataFrame, fx: DataFrame, types: DataFrame) -> DataFrame:
    """The last delivered version of each valid transaction, in its own currency and in euro.

    The file name carries the delivery date, so it decides before the load time. _source_row stays in the fact, so
    that later merges can rank deliveries the same way."""
    valid = latest_by(validated.where("rejection_reason is null"), ["txn_id"], BY_FILE)
    dated = valid.withColumn("txn_date", F.col("txn_ts").cast("date"))
    rates = fx.select(F.col("currency").alias("_ccy"), F.col("rate_date").alias("_day"), F.col("rate_to_eur").alias("fx_rate_to_eur"), F.col("published_date").alias("fx_rate_published_date"))
    rated = dated.join(rates, (dated.currency == F.col("_ccy")) & (dated.txn_date == F.col("_day")), "left").join(F.broadcast(types.select("txn_type", "txn_category")), "txn_type", "left")
    signed = F.when(F.col("direction") == "DR", -F.col("amount")).otherwise(F.col("amount")).cast(MONEY)
    eur = lambda c: (c * F.col("fx_rate_to_eur")).cast(MONEY)
    return rated.select(
        "txn_id", "account_id", "customer_id", "txn_ts", "txn_date", "txn_type", "txn_category", "direction", "status", "channel", "merchant_id", "counterparty_iban", "original_txn_id", "currency", "amount",
        signed.alias("signed_amount"), "fx_rate_to_eur", "fx_rate_published_date", eur(F.col("amount")).alias("amount_eur"), eur(signed).alias("signed_amount_eur"), (F.col("status") == "POSTED").alias("is_posted"),
        "warning_reason", "device_id", "description", "_source_file", "_source_row", "_loaded_at",
    )


def recompute_from(fct: DataFrame, balances: DataFrame | None, before: DataFrame | None = None) -> dt.date | None:
    """First day whose balances may have changed since they were built; None if nothing new came.

    before: the fact as the balances saw it; with it, a transaction that moved to another day counts on its old day too."""
    if balances is None:
        return fct.agg(F.min("txn_date")).first()[0]
    through, last = balances.agg(F.max("source_loaded_through"), F.max("balance_date")).first()
    news = fct if through is None else fct.where(F.col("_loaded_at") > F.lit(through))
    days = news.select("txn_date")
    if before is not None:
        days = days.unionByName(before.join(news.select("txn_id"), "txn_id", "left_semi").select("txn_date"))
    day = days.agg(F.min("txn_date")).first()[0]
    return day if day is None or last is None else min(day, last + dt.timedelta(days=1))  # days without any transaction count too


def daily_balance(fct: DataFrame, accounts: DataFrame, fx: DataFrame, from_day: dt.date | None = None, prior: DataFrame | None = None) -> DataFrame:
    """A row for each account and day: posted movements and closing balance, also on days without any.

    An account's days run from its opening or the first data, to its closing or the last data. With from_day, only
    days from then on, starting at prior's closing balance of the day before."""
    bounds = fct.agg(F.min("txn_date").alias("data_start"), F.max("txn_date").alias("data_end"), F.max("_loaded_at").alias("source_loaded_through"))
    spans = accounts.select("account_id", "currency", "opening_balance", "opened_date", "closed_date").crossJoin(F.broadcast(bounds))
    start = F.when(F.col("opened_date") > F.col("data_start"), F.col("opened_date")).otherwise(F.col("data_start"))
    end = F.when(F.col("closed_date") < F.col("data_end"), F.col("closed_date")).otherwise(F.col("data_end"))
    spans = spans.withColumns({"_first": start if from_day is None else F.greatest(start, F.lit(from_day)), "_last": end})
    spine = explode_days(spans, "_first", "_last", "balance_date").select("account_id", "currency", "opening_balance", "balance_date", "source_loaded_through")
    posted = fct.where("is_posted") if from_day is None else fct.where("is_posted").where(F.col("txn_date") >= F.lit(from_day))
    zero = F.lit(0).cast(MONEY)
    daily = posted.groupBy("account_id", F.col("txn_date").alias("balance_date")).agg(
        F.sum("signed_amount").alias("net_amount"),
        F.sum(F.when(F.col("direction") == "CR", F.col("amount")).otherwise(zero)).alias("credit_amount"),
        F.sum(F.when(F.col("direction") == "DR", F.col("amount")).otherwise(zero)).alias("debit_amount"),
        F.count(F.lit(1)).alias("posted_txn_count"),
    )
    days = spine.join(daily, ["account_id", "balance_date"], "left")
    if prior is not None and from_day is not None:
        eve = prior.where(F.col("balance_date") == F.lit(from_day - dt.timedelta(days=1))).select("account_id", F.col("closing_balance").alias("_prior"))
        days = days.join(eve, "account_id", "left").withColumn("opening_balance", F.coalesce("_prior", "opening_balance")).drop("_prior")
    amounts = {c: F.coalesce(c, zero).cast(MONEY) for c in ("net_amount", "credit_amount", "debit_amount")}
    days = days.withColumns(amounts | {"posted_txn_count": F.coalesce("posted_txn_count", F.lit(0)).cast("long")})
    running = F.sum("net_amount").over(Window.partitionBy("account_id").orderBy("balance_date").rowsBetween(Window.unboundedPreceding, 0))
    closed = days.withColumn("closing_balance", (F.col("opening_balance") + running).cast(MONEY))
    rates = fx.select("currency", F.col("rate_date").alias("balance_date"), "rate_to_eur")
    return closed.join(rates, ["currency", "balance_date"], "left").select(
        "account_id", "balance_date", "currency", "net_amount", "credit_amount", "debit_amount", "posted_txn_count", "closing_balance", (F.col("closing_balance") * F.col("rate_to_eur")).cast(MONEY).alias("closing_balance_eur"), "source_loaded_through"
    )


def incremental_balance(balances: DataFrame | None, fct: DataFrame, accounts: DataFrame, fx: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """balances brought up to date: whole days from the first changed one on are built anew, earlier days stay."""
    day = recompute_from(fct, balances, before)
    if balances is None:
        return daily_balance(fct, accounts, fx)
    if day is None:
        return balances
    return balances.where(F.col("balance_date") < F.lit(day)).unionByName(daily_balance(fct, accounts, fx, day, balances))
