"""Landed tables: every business column is text, followed by where the row came from."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id", "first_name", "last_name", "email", "birth_date", "country_code", "segment", "risk_rating", "kyc_status", "created_at", "updated_at"),
    "accounts": ("account_id", "customer_id", "iban", "account_type", "currency", "status", "opened_date", "closed_date", "opening_balance", "updated_at"),
    "merchants": ("merchant_id", "merchant_name", "mcc", "country_code"),
    "fx_rates": ("rate_date", "currency", "rate_to_eur", "source"),
    "transactions": (
        "txn_id", "account_id", "txn_ts", "amount", "currency", "direction", "txn_type", "status", "channel", "merchant_id", "counterparty_iban", "original_txn_id", "description", "device_id",
    ),
}
#: Reference data first: a transaction is only valid if its account is known.
LOAD_ORDER = ("customers", "accounts", "merchants", "fx_rates", "transactions")
FILE_METADATA = [T.StructField("_source_file", T.StringType()), T.StructField("_source_row", T.LongType()), T.StructField("_loaded_at", T.TimestampNTZType())]
STREAM_METADATA = [
    T.StructField("_kafka_topic", T.StringType()),
    T.StructField("_kafka_partition", T.IntegerType()),
    T.StructField("_kafka_offset", T.LongType()),
    T.StructField("_kafka_timestamp_ms", T.LongType()),
    T.StructField("_raw_value", T.StringType()),
    T.StructField("_parse_error", T.StringType()),
    T.StructField("_ingested_at", T.TimestampNTZType()),
]


def raw_schema(entity: str) -> T.StructType:
    if entity not in RAW_COLUMNS:
        raise ValueError(f"unknown entity {entity!r}; known: {', '.join(LOAD_ORDER)}")
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[entity]] + FILE_METADATA)


def stream_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS["transactions"]] + STREAM_METADATA)
