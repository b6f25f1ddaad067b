"""Event encoding and decoding. Decoding never fails: what can't be read is kept, with an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.schema import RAW_COLUMNS

COLUMNS = RAW_COLUMNS["transactions"]
HEADER = ("schema", "bank.transaction.v1")
KEPT_CHARS = 4000


def encode_events(rows: DataFrame) -> DataFrame:
    """key (account), value (compact JSON of the text columns, empty text as null) and headers, as a Kafka sink takes them."""
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) for c in COLUMNS]
    header = F.array(F.struct(F.lit(HEADER[0]).alias("key"), F.lit(HEADER[1]).cast("binary").alias("value")))
    return rows.select(F.col("account_id").alias("key"), F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"), header.alias("headers"))


def decode_events(messages: DataFrame) -> DataFrame:
    """messages (topic, partition, offset, timestamp_ms, value binary) as landed rows.

    A null or empty value, bad UTF-8, bad JSON, anything but an object and whatever stands behind it, be it another
    object, give null fields, the first 4000 characters and an error."""
    text = F.col("value").cast("string")
    valid = F.is_valid_utf8(text)
    readable = F.make_valid_utf8(text)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS] + [T.StructField("_bad", T.StringType())])
    parsed = messages.withColumn("_text", readable).withColumn("_valid", valid)
    fields = F.from_json("_text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = parsed.withColumn("_fields", fields)
    empty = F.col("value").isNull() | (F.length("value") == 0)
    error = (
        F.when(empty, "empty message")
        .when(~F.col("_valid"), "invalid utf-8")
        .when(F.col("_fields").isNull() | F.col("_fields._bad").isNotNull(), "invalid json")
        .when(~F.trim("_text").rlike(r"(?s)^\s*\{.*\}\s*$"), "not a json object")
        # As the only element of an array the text holds one value and nothing else.
        .when(~F.coalesce(F.json_array_length(F.concat(F.lit("["), F.col("_text"), F.lit("]"))) == 1, F.lit(False)), "invalid json")
    )
    parsed = parsed.withColumn("_error", error)
    good = F.col("_error").isNull()
    return parsed.select(
        *[F.when(good, F.col(f"_fields.{c}")).alias(c) for c in COLUMNS],
        F.col("topic").alias("_kafka_topic"),
        F.col("partition").cast("int").alias("_kafka_partition"),
        F.col("offset").cast("long").alias("_kafka_offset"),
        F.col("timestamp_ms").cast("long").alias("_kafka_timestamp_ms"),
        F.when(~good, F.substring("_text", 1, KEPT_CHARS)).alias("_raw_value"),
        F.col("_error").alias("_parse_error"),
        F.current_timestamp().cast("timestamp_ntz").alias("_ingested_at"),
    )
