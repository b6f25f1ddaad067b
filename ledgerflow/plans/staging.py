"""Text to types: one function for each landed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.columns import EU_TS, ISO_TS, code, parse_date, parse_decimal, parse_ts, text_or_null
from ledgerflow.operators.temporal import latest_by

FILE_COLUMNS = ["_source_file", "_source_row", "_loaded_at"]
BY_FILE = ["_source_file", "_loaded_at", "_source_row"]


def _transaction_columns() -> dict:
    """Typing that both ingestion paths share."""
    t = lambda c: F.trim(F.col(c))
    return {
        "txn_id": t("txn_id"),
        "account_id": t("account_id"),
        "txn_ts": parse_ts(t("txn_ts"), ISO_TS, EU_TS),
        "amount": parse_decimal(F.col("amount")),
        "currency": code(F.col("currency")),
        "direction": code(F.col("direction")),
        "txn_type": code(F.col("txn_type")),
        "status": code(F.col("status")),
    }


def stg_transactions(raw: DataFrame) -> DataFrame:
    cols = _transaction_columns() | {
        "channel": code(F.col("channel")),
        "merchant_id": text_or_null(F.col("merchant_id")),
        "counterparty_iban": text_or_null(F.col("counterparty_iban")),
        "original_txn_id": text_or_null(F.col("original_txn_id")),
        "description": F.trim("description"),
        "device_id": text_or_null(F.col("device_id")),
        "txn_ts_raw": F.col("txn_ts"),
        "amount_raw": F.col("amount"),
    }
    return raw.select(*[v.alias(k) for k, v in cols.items()], *FILE_COLUMNS)


def stg_transactions_stream(landed: DataFrame) -> DataFrame:
    kept = ["_kafka_partition", "_kafka_offset", "_parse_error", "_ingested_at"]
    return landed.select(*[v.alias(k) for k, v in _transaction_columns().items()], F.timestamp_millis("_kafka_timestamp_ms").cast("timestamp_ntz").alias("produced_at"), *kept)


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("customer_id").alias("customer_id"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.lower(F.trim("email")).alias("email"),
        parse_date(F.col("birth_date")).alias("birth_date"),
        *[code(F.col(c)).alias(c) for c in ("country_code", "segment", "risk_rating", "kyc_status")],
        *[parse_ts(F.col(c), ISO_TS).alias(c) for c in ("created_at", "updated_at")],
        *FILE_COLUMNS,
    )


def stg_accounts(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("account_id").alias("account_id"),
        F.trim("customer_id").alias("customer_id"),
        F.upper(F.replace("iban", F.lit(" "), F.lit(""))).alias("iban"),
        *[code(F.col(c)).alias(c) for c in ("account_type", "currency", "status")],
        *[parse_date(F.col(c)).alias(c) for c in ("opened_date", "closed_date")],
        F.trim("opening_balance").try_cast("decimal(18,2)").alias("opening_balance"),
        parse_ts(F.col("updated_at"), ISO_TS).alias("updated_at"),
        *FILE_COLUMNS,
    )


def stg_merchants(raw: DataFrame) -> DataFrame:
    """The latest delivery of each merchant."""
    clean = raw.select(F.trim("merchant_id").alias("merchant_id"), F.trim("merchant_name").alias("merchant_name"), F.trim("mcc").alias("mcc"), code(F.col("country_code")).alias("country_code"), *FILE_COLUMNS)
    return latest_by(clean, ["merchant_id"], BY_FILE)


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    """The latest delivery of each day and currency."""
    clean = raw.select("rate_date", code(F.col("currency")).alias("currency"), F.trim("rate_to_eur").try_cast("decimal(18,8)").alias("rate_to_eur"), F.trim("source").alias("source"), *FILE_COLUMNS)
    return latest_by(clean, ["rate_date", "currency"], BY_FILE).withColumn("rate_date", parse_date(F.col("rate_date")))
