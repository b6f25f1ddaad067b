"""Finance reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.columns import month_start
from ledgerflow.operators.rank import percent_rank
from ledgerflow.operators.temporal import as_of_join

MONEY = "decimal(18,2)"


def reversed_ids(fct: DataFrame) -> DataFrame:
    """Transactions that a posted reversal takes back."""
    return fct.where("txn_type = 'REVERSAL' and is_posted and original_txn_id is not null").select(F.col("original_txn_id").alias("_original")).distinct()


def customer_month_balances(balances: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Average and last daily holdings of each customer and month, over all its accounts."""
    owners = dim_account.select("account_id", "customer_id")
    held = balances.join(owners, "account_id").groupBy("customer_id", "balance_date").agg(F.sum("closing_balance_eur").alias("held"))
    return held.groupBy("customer_id", month_start(F.col("balance_date")).alias("month_start")).agg(
        (F.sum("held") / F.count("held")).cast(MONEY).alias("avg_daily_balance_eur"), F.max_by("held", "balance_date").cast(MONEY).alias("month_end_balance_eur")
    )


def customer_month_bookings(fct: DataFrame, back: DataFrame) -> DataFrame:
    """What each customer booked in each month. back: reversed_ids() of the whole fact."""
    t = fct.where("is_posted and txn_type <> 'REVERSAL'").join(back, F.col("txn_id") == F.col("_original"), "left")
    kept = F.col("_original").isNull()
    total = lambda test, name: F.sum(F.when(test, F.col("amount_eur")).otherwise(F.lit(0))).cast(MONEY).alias(name)
    return t.groupBy("customer_id", month_start(F.col("txn_date")).alias("month_start")).agg(
        F.count(F.lit(1)).alias("posted_txn_count"),
        total(F.col("txn_category") == "INCOME", "income_eur"),
        total((F.col("txn_type") == "CARD_PAYMENT") & kept, "card_spend_eur"),
        total((F.col("direction") == "CR") & (F.col("txn_type") != "INTERNAL_TRANSFER"), "external_inflow_eur"),
        total((F.col("direction") == "DR") & (F.col("txn_type") != "INTERNAL_TRANSFER") & kept, "external_outflow_eur"),
        F.countDistinct("merchant_id").alias("distinct_merchants"),
    )


def customer_months(per_month: DataFrame, booked: DataFrame, dim_customer: DataFrame, prior: DataFrame | None = None, keep=lambda df: df) -> DataFrame:
    """The summary's rows from both parts. prior: customer_id, month_start, card_spend_eur of earlier months, where
    these parts don't begin with a customer's first one. keep: how the rows are held, as ranks take two looks at them."""
    both = per_month.join(booked, ["customer_id", "month_start"], "left").fillna(0, ["posted_txn_count", "income_eur", "card_spend_eur", "external_inflow_eur", "external_outflow_eur", "distinct_merchants"])
    known = as_of_join(both, dim_customer, "customer_id", F.add_months("month_start", 1).cast("timestamp_ntz"), "before", ("segment", "risk_rating"))
    if prior is not None:
        known = known.withColumn("_asked", F.lit(True)).unionByName(prior.withColumn("_asked", F.lit(False)), allowMissingColumns=True)
    known = known.withColumn("prior_month_card_spend_eur", F.lag("card_spend_eur").over(Window.partitionBy("customer_id").orderBy("month_start")))
    if prior is not None:
        known = known.where("_asked").drop("_asked")
    ranked = percent_rank(keep(known), ["month_start", "segment"], "card_spend_eur", "card_spend_percentile_in_segment")
    return ranked.select(
        "customer_id", "month_start", "segment", "risk_rating", "posted_txn_count", "income_eur", "card_spend_eur", "external_inflow_eur", "external_outflow_eur",
        (F.col("external_inflow_eur") - F.col("external_outflow_eur")).cast(MONEY).alias("net_external_flow_eur"), "distinct_merchants", "avg_daily_balance_eur", "month_end_balance_eur",
        "prior_month_card_spend_eur", "card_spend_percentile_in_segment",
    )


def monthly_customer_summary(fct: DataFrame, balances: DataFrame, dim_account: DataFrame, dim_customer: DataFrame, keep=lambda df: df) -> DataFrame:
    """A row for each customer and month with a balance, whether or not anything was booked."""
    return customer_months(customer_month_balances(balances, dim_account), customer_month_bookings(fct, reversed_ids(fct)), dim_customer, None, keep)


def monthly_spend(fct: DataFrame, back: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Card spend by month, category and country. back: reversed_ids() of the whole fact."""
    card = fct.where("txn_type = 'CARD_PAYMENT' and is_posted").join(back, F.col("txn_id") == F.col("_original"), "left_anti")
    placed = card.join(dim_merchant.select("merchant_id", "spend_category", "country_code"), "merchant_id", "left")
    keys = [month_start(F.col("txn_date")).alias("month_start"), F.coalesce("spend_category", F.lit("Unknown")).alias("spend_category"), F.coalesce("country_code", F.lit("UNKNOWN")).alias("merchant_country")]
    return placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("txn_count"), F.countDistinct("customer_id").alias("active_customers"), F.sum("amount_eur").cast(MONEY).alias("spend_eur"), (F.sum("amount_eur") / F.count("amount_eur")).cast(MONEY).alias("avg_ticket_eur")
    )


def spend_report(monthly: DataFrame) -> DataFrame:
    """monthly_spend() with each row's share of the month and growth on the last month present."""
    prior = F.lag("spend_eur").over(Window.partitionBy("spend_category", "merchant_country").orderBy("month_start"))
    whole = F.sum("spend_eur").over(Window.partitionBy("month_start"))
    return monthly.withColumns({"prior_month_spend_eur": prior, "_whole": whole}).select(
        "month_start", "spend_category", "merchant_country", "txn_count", "active_customers", "spend_eur", "avg_ticket_eur",
        (F.col("spend_eur") / F.nullif("_whole", F.lit(0))).cast("decimal(9,6)").alias("share_of_month_spend"), "prior_month_spend_eur",
        ((F.col("spend_eur") - F.col("prior_month_spend_eur")) / F.nullif("prior_month_spend_eur", F.lit(0))).cast("decimal(12,6)").alias("mom_growth"),
    )


def merchant_category_spend(fct: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Card spend by month, category and country, with its share of the month and growth on the last month present."""
    return spend_report(monthly_spend(fct, reversed_ids(fct), dim_merchant))
