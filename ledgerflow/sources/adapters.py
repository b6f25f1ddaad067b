"""The driver's tables as landed text: messy on purpose, in the ways that the library has to deal with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.operators.rank import row_numbers
from ledgerflow.sources.seeds import MCC_CODES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _currency(customer: Column) -> Column:
    return F.when(customer % 10 == 8, "USD").when(customer % 10 == 9, "GBP").otherwise("EUR")


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    return c.select(
        F.concat(F.lit("A"), k).alias("account_id"),
        F.concat(F.lit("C"), k).alias("customer_id"),
        F.concat(F.lit("de "), F.lpad(k.cast("string"), 20, "0")).alias("iban"),
        F.element_at(F.array(F.lit("CHECKING"), F.lit("savings "), F.lit("CREDIT_CARD")), (k % 3 + 1).cast("int")).alias("account_type"),
        _currency(k).alias("currency"),
        F.when(k % 50 == 7, "CLOSED").otherwise("ACTIVE").alias("status"),
        F.lit("2023-06-01").alias("opened_date"),
        F.when(k % 50 == 7, "2024-01-20").alias("closed_date"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("opening_balance"),
        F.lit("2023-06-01 00:00:00").alias("updated_at"),
        F.lit("accounts/accounts_20230601.csv.gz").alias("_source_file"),
        (k + 1).alias("_source_row"),
        F.lit("2023-06-01 06:00:00").cast("timestamp_ntz").alias("_loaded_at"),
    )


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    mcc = F.array(*[F.lit(m[0]) for m in MCC_CODES], F.lit("0000"), F.lit("0001"))
    country = F.array(*[F.lit(x) for x in ("DE", "fr", "ES", " it")])
    return p.select(
        F.concat(F.lit("M"), k).alias("merchant_id"),
        F.col("p_name").alias("merchant_name"),
        F.element_at(mcc, (k % 20 + 1).cast("int")).alias("mcc"),
        F.element_at(country, (F.col("p_size") % 4 + 1).cast("int")).alias("country_code"),
        F.lit("merchants/merchants_20230601.csv.gz").alias("_source_file"),
        (k + 1).alias("_source_row"),
        F.lit("2023-06-01 06:00:00").cast("timestamp_ntz").alias("_loaded_at"),
    )


def raw_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published on business days only."""
    bounds = table(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("d")).where("weekday(d) < 5")
    rate = (F.lit(900) + F.pmod(F.datediff("d", F.lit("2024-01-01")), F.lit(17))) / F.lit(1000)
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("rate_date"),
        F.explode(F.array(F.lit("usd"), F.lit("GBP "))).alias("currency"),
        rate.cast("decimal(18,8)").cast("string").alias("rate_to_eur"),
        F.lit("ECB").alias("source"),
        F.concat(F.lit("fx_rates/fx_rates_"), F.date_format("d", "yyyyMMdd"), F.lit(".csv.gz")).alias("_source_file"),
        F.lit(1).cast("long").alias("_source_row"),
        F.col("d").cast("timestamp_ntz").alias("_loaded_at"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed made from orders: a full row for each change, of which some change nothing."""
    rank = F.row_number().over(Window.partitionBy("o_custkey", "o_orderdate").orderBy("o_orderkey"))
    o = table(spark, sf_dir, "orders").withColumn("at", F.timestamp_add("SECOND", rank, F.col("o_orderdate")))
    level = F.left("o_orderpriority", F.lit(1))
    k = F.col("o_custkey").cast("string")
    at = F.date_format("at", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        F.concat(F.lit("C"), k).alias("customer_id"),
        F.concat(F.lit(" First"), k).alias("first_name"),
        F.concat(F.lit("Last"), k).alias("last_name"),
        F.concat(F.lit("User"), k, F.lit("@Example.com")).alias("email"),
        F.lit("1980-02-29").alias("birth_date"),
        F.lit("de").alias("country_code"),
        F.element_at(F.create_map(F.lit("F"), F.lit("RETAIL"), F.lit("O"), F.lit("PRIVATE"), F.lit("P"), F.lit("business")), F.col("o_orderstatus")).alias("segment"),
        F.when(level.isin("1", "2"), "HIGH").when(level == "3", "MEDIUM").otherwise("LOW").alias("risk_rating"),
        F.lit("VERIFIED").alias("kyc_status"),
        F.lit("1994-12-31 00:00:00").alias("created_at"),
        at.alias("updated_at"),
        F.concat(F.lit("customers/customers_"), F.date_format("at", "yyyyMMdd"), F.lit(".csv.gz")).alias("_source_file"),
        F.col("o_orderkey").alias("_source_row"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("_loaded_at"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str, counted: bool = False) -> DataFrame:
    """events as delivered files: two date formats, decimal commas, bad values, late and repeated deliveries, reversals.

    A file holds an id once. If counted, row numbers are 1, 2, 3... along a file; else they rise along it with gaps, as
    they follow from the id, which is enough where only their order matters."""
    e = table(spark, sf_dir, "events")
    parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n_parts"))
    i = F.col("event_id")
    card = F.col("event_type").isin("purchase", "view")
    base = e.crossJoin(F.broadcast(parts)).select(
        F.concat(F.lit("T"), i).alias("txn_id"),
        i.alias("i"),
        F.col("user_id"),
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("at"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.when(card, "CARD_PAYMENT").when(F.col("event_type") == "signup", "CASH_DEPOSIT").when(F.col("event_type") == "click", "SEPA_TRANSFER_OUT").otherwise("FEE").alias("txn_type"),
        F.when(F.col("event_type") == "signup", "CR").otherwise("DR").alias("direction"),
        F.when(i % 100 == 3, "DECLINED").otherwise("POSTED").alias("status"),
        F.when(card & (i % 13 != 0), F.concat(F.lit("M"), i % F.col("n_parts"))).otherwise("").alias("merchant_id"),
        F.lit("").alias("original_txn_id"),
    )
    back = base.where((F.col("txn_type") == "CARD_PAYMENT") & (F.col("i") % 211 == 0)).select(
        F.concat(F.lit("R"), "i").alias("txn_id"), "i", "user_id", F.timestamp_add("DAY", F.lit(3), F.col("at")).alias("at"), "value", F.lit("REVERSAL").alias("txn_type"), F.lit("CR").alias("direction"), F.lit("POSTED").alias("status"), "merchant_id",
        F.concat(F.lit("T"), "i").alias("original_txn_id"),
    )
    i = F.col("i")
    both = base.unionByName(back).withColumn("day", F.date_add(F.col("at").cast("date"), F.when(i % 50 == 1, 5).otherwise(1)))
    first = both.withColumn("loaded", F.timestamp_add("HOUR", F.lit(6), F.col("day").cast("timestamp_ntz")))
    # The same row again in the next day's file, which was loaded an hour before the first.
    again = first.where(i % 97 == 0).withColumns({"day": F.date_add("day", 1), "loaded": F.timestamp_add("HOUR", F.lit(-1), F.col("loaded"))})
    rows = first.unionByName(again)
    amount = F.when(i % 331 == 1, "N/A").when(i % 337 == 2, F.concat(F.lit("-"), F.col("value").cast("string"))).when(i % 347 == 3, "0.00").otherwise(F.col("value").cast("string"))
    own = _currency(F.col("user_id"))
    place = 2 * i + F.when(F.col("txn_id").startswith("T"), 2).otherwise(1)
    sent = rows.select(
        "txn_id",
        F.when(i % 349 == 4, "A999999999").otherwise(F.concat(F.lit("A"), "user_id")).alias("account_id"),
        F.when(i % 353 == 5, None).when(i % 367 == 7, "  ").otherwise(F.date_format("at", "yyyy-MM-dd HH:mm:ss")).alias("iso"),
        F.when(i % 367 == 7, "  ").otherwise(F.date_format("at", "dd/MM/yyyy HH:mm:ss")).alias("eu"),
        F.when(i % 7 == 0, F.replace(amount, F.lit("."), F.lit(","))).otherwise(amount).alias("amount"),
        F.when(i % 11 == 0, F.lower(own)).otherwise(own).alias("currency"),
        F.when(i % 359 == 6, "XX").otherwise(F.col("direction")).alias("direction"),
        "txn_type",
        "status",
        F.when(F.col("txn_type") == "CARD_PAYMENT", "card ").otherwise("BRANCH").alias("channel"),
        "merchant_id",
        F.lit("").alias("counterparty_iban"),
        "original_txn_id",
        F.concat(F.lit(" payment "), "i").alias("description"),
        F.when(i % 5 == 0, "").otherwise(F.concat(F.lit("dev"), "user_id")).alias("device_id"),
        F.concat(F.lit("transactions/transactions_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv.gz")).alias("_source_file"),
        "i",
        F.col("loaded").alias("_loaded_at"),
    )
    sent = row_numbers(sent, ["_source_file"], "i", ["txn_id"], "_source_row") if counted else sent.withColumn("_source_row", place)
    return sent.select(
        "txn_id", "account_id", F.when(F.col("iso").isNull(), None).when(i % 7 == 0, F.col("eu")).otherwise(F.col("iso")).alias("txn_ts"), "amount", "currency", "direction", "txn_type", "status", "channel", "merchant_id",
        "counterparty_iban", "original_txn_id", "description", "device_id", "_source_file", F.col("_source_row").cast("long").alias("_source_row"), "_loaded_at",
    )


def raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as landed from a topic of three partitions, an event's offset following from its number; some payloads are cut short."""
    from ledgerflow.schema import RAW_COLUMNS
    from ledgerflow.streaming.events import encode_events

    once = raw_transactions(spark, sf_dir).where("txn_id like 'T%'").dropDuplicates(["txn_id"]).select(*RAW_COLUMNS["transactions"])
    n = F.substring(F.get_json_object("value", "$.txn_id"), 2, 20).cast("long")
    sent = encode_events(once).select("key", "value", n.alias("n"))
    cut = F.when(F.col("n") % 500 == 10, F.left("value", (F.length("value") / 2).cast("int"))).otherwise(F.col("value"))
    return sent.select(
        F.lit("bank.transactions").alias("topic"), F.pmod("n", F.lit(3)).cast("int").alias("partition"), F.floor(F.col("n") / 3).alias("offset"), (F.lit(1706745600000) + F.col("n") * 1000).alias("timestamp_ms"), cut.cast("binary").alias("value"), "n"
    )
