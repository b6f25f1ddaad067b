"""Building all tables in a warehouse, in full or from what is new."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.config import Params
from ledgerflow.operators import change
from ledgerflow.operators.change import loaded_since, snapshot, upsert
from ledgerflow.operators.quality import require_passed, run_checks
from ledgerflow.plans import controls, core, derived, staging
from ledgerflow.plans.checks import model_checks
from ledgerflow.plans.staging import BY_FILE
from ledgerflow.sources.seeds import mcc_codes, transaction_types
from ledgerflow.sources.tables import Warehouse, month_partition


#: Which of two deliveries of a customer's version counts, and the buckets of customers that a build writes anew.
BY_DELIVERY, CUSTOMER_BUCKETS = ["_source_file", "_source_row"], 64


def build(warehouse: Warehouse, p: Params = Params(), full_refresh: bool = False, check: bool = True, reconcile: bool = True) -> dict[str, DataFrame]:
    """Builds every table from the landed text and returns the new tables by name.

    The fact and the quarantine are merged from rows loaded since the last build, unless full_refresh; what the merge
    changed in the fact decides which months and accounts of the tables derived from it are made anew. Quarantined rows
    that are valid by now are released into the fact. All new tables are published together, after the checks and the
    reconciliation with the landed text have passed. If anything fails before that, the warehouse is as it was, and the
    next build begins where this one did."""
    try:
        tables, merged = new_tables(warehouse, p, full_refresh)
        if check:
            require_passed(run_checks(model_checks(tables, p)))
        if reconcile:
            require_reconciled(warehouse.read("raw_transactions"), tables, merged)
        warehouse.publish()
        return tables
    finally:
        warehouse.discard()  # nothing, if all was published


def require_reconciled(raw: DataFrame, tables: dict[str, DataFrame], merged: DataFrame | None) -> None:
    """Raises unless the fact agrees with the landed text, parsed anew; with merged, a batch's rows, for its ids alone."""
    facts = tables["fct_transactions"]
    if merged is not None:
        ids = merged.select("txn_id").distinct()
        facts = facts.join(ids, "txn_id", "left_semi")
        raw = raw.join(ids.withColumnRenamed("txn_id", "_id"), F.trim("txn_id") == F.col("_id"), "left_semi")
    controls.require_reconciled(controls.reconcile(raw, tables["dq_rejected_transactions"], facts))


def new_tables(warehouse: Warehouse, p: Params, full_refresh: bool) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Writes all tables, unpublished. Also returns the batch that was merged into the fact, if there was one before."""
    spark, write = warehouse.spark, warehouse.write
    raw = {e: warehouse.read(f"raw_{e}") for e in ("customers", "accounts", "merchants", "fx_rates", "transactions")}
    before = (lambda name: None) if full_refresh else warehouse.read
    accounts = core.dim_account(core.current_accounts(staging.stg_accounts(raw["accounts"])))
    out = {
        "dim_account": write(accounts, "dim_account"),
        **customers(warehouse, raw["customers"], before, p),
        "dim_merchant": write(core.dim_merchant(staging.stg_merchants(raw["merchants"]), mcc_codes(spark)), "dim_merchant"),
        "dim_date": write(core.dim_date(spark, p), "dim_date"),
        "fx_rates_daily": write(core.fx_daily(staging.stg_fx_rates(raw["fx_rates"]), p), "fx_rates_daily"),
    }
    out["snap_accounts"] = write(snapshot(before("snap_accounts"), out["dim_account"], "account_id", "updated_at"), "snap_accounts")
    old_fct, old_bad = before("fct_transactions"), before("dq_rejected_transactions")
    validated = core.validate(staging.stg_transactions(raw["transactions"]), out["dim_account"])
    news = loaded_since(validated, old_fct, lookback_hours=p.incremental_lookback_hours)
    again = judged_again(warehouse, raw["transactions"], old_bad, out["dim_account"])
    if again is not None:
        news = news.unionByName(again).dropDuplicates(["_source_file", "_source_row"])
    # The batch is narrow beside the tables, and is used several times.
    news = warehouse.step(news)
    batch = warehouse.step(month_partition(core.fct_transactions(news, out["fx_rates_daily"], transaction_types(spark)), "txn_date"))
    out["fct_transactions"], touched = merge_by_partition(warehouse, "fct_transactions", old_fct, batch, ["txn_id"], BY_FILE, "txn_month", "txn_date", "txn_id")
    freed = None if again is None else file_partition(again.where("rejection_reason is null"))
    out["dq_rejected_transactions"], _ = merge_by_partition(warehouse, "dq_rejected_transactions", old_bad, file_partition(core.quarantine(news)), ["_source_file", "_source_row"], [], "file_month", removed=freed)
    delta = None if old_fct is None else warehouse.step(fact_delta(old_fct, out["fct_transactions"], batch, touched))
    out |= derived.build_derived(warehouse, out, before, delta, touched, p)
    out["dq_transaction_file_summary"] = write(controls.file_summary(validated), "dq_transaction_file_summary")
    landed = warehouse.read("raw_transactions_stream")
    if landed is not None:
        both = controls.stream_vs_batch(staging.stg_transactions_stream(landed), staging.stg_transactions(raw["transactions"]), warehouse.step)
        out["dq_stream_vs_batch"] = write(both, "dq_stream_vs_batch")
    return out, batch if old_fct is not None else None


def customers(warehouse: Warehouse, raw: DataFrame, before, p: Params) -> dict[str, DataFrame]:
    """All versions of customers that were ever delivered, and their histories; newly delivered versions are spliced in.

    Both are kept in buckets of customers, and only buckets that something was delivered for are written again."""
    key, at, names = "customer_id", "updated_at", ("int_customer_versions", "dim_customer")
    versions, history = (before(n) for n in names)
    bucket = lambda df: df.withColumn("customer_bucket", F.pmod(F.xxhash64(key), F.lit(CUSTOMER_BUCKETS)).cast("int"))
    news = bucket(loaded_since(staging.stg_customers(raw), versions, lookback_hours=p.incremental_lookback_hours))
    if versions is None or history is None:
        versions = warehouse.write(change.splice_versions(None, news, key, at, BY_DELIVERY), names[0], "customer_bucket")
        return {names[0]: versions, names[1]: warehouse.write(bucket(core.customer_columns(change.scd2_from_versions(versions, key, at, core.CUSTOMER_STATE))), names[1], "customer_bucket")}
    news = warehouse.step(news)
    touched = sorted(r[0] for r in news.select("customer_bucket").distinct().collect())
    if not touched:
        return dict(zip(names, (versions, history), strict=True))
    own = F.col("customer_bucket").isin(touched)
    versions = warehouse.write(change.splice_versions(versions.where(own), news, key, at, BY_DELIVERY), names[0], "customer_bucket", touched)
    made = lambda rows: bucket(core.customer_columns(change.scd2_from_versions(rows, key, at, core.CUSTOMER_STATE)))
    spliced = change.splice(history.where(own), versions.where(own), news, key, made)
    return {names[0]: versions, names[1]: warehouse.write(spliced, names[1], "customer_bucket", touched)}


def file_partition(df: DataFrame) -> DataFrame:
    """df with file_month, the month in the name of its file, or `none`."""
    return df.withColumn("file_month", F.coalesce(F.date_format(F.try_to_date(F.regexp_extract("_source_file", r"_(\d{8})\.csv", 1), "yyyyMMdd"), "yyyy-MM"), F.lit("none")))


def judged_again(warehouse: Warehouse, raw: DataFrame, quarantined: DataFrame | None, accounts: DataFrame) -> DataFrame | None:
    """Quarantined rows on which the accounts of today shed another light, validated again; None if there are none.

    Of all reasons only two depend on accounts: an unknown one may have come, and one of another currency changed its
    own. Only those rows are read from the landed text and validated."""
    if quarantined is None:
        return None
    suspects = quarantined.where("rejection_reason in ('UNKNOWN_ACCOUNT', 'CURRENCY_MISMATCH')").select("account_id", "currency", "rejection_reason", "_source_file", "_source_row")
    known = accounts.select("account_id", F.col("currency").alias("_own"))
    keys = suspects.join(known, "account_id").where("rejection_reason = 'UNKNOWN_ACCOUNT' or currency = _own").select("_source_file", "_source_row")
    keys = warehouse.step(keys)
    return None if keys.isEmpty() else warehouse.step(core.validate(staging.stg_transactions(raw.join(keys, ["_source_file", "_source_row"], "left_semi")), accounts))


def merge_by_partition(
    warehouse: Warehouse, name: str, old: DataFrame | None, batch: DataFrame, keys: list[str], precedence: list[str], partition: str, cluster_by: str | None = None, bloom: str | None = None, removed: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """Puts a batch into a table by key, or takes the keys of removed out; returns the new table and the partitions written.

    These are the batch's own and those in which its keys were before; of the table, only keys, precedence and partitions
    are read to find them, once rows that are there already or lose have been left out. Partitions without rows afterwards go. Their names, one for
    each month, are all that comes to the driver."""
    if old is None:
        merged = warehouse.write(upsert(None, batch, keys, precedence), name, partition, None, cluster_by, bloom)
        return merged, [r[0] for r in merged.select(partition).distinct().collect()]
    # What the lookback brings again unchanged is left out.
    columns = sorted(set(batch.columns) & set(old.columns))
    months = [r[0] for r in batch.select(partition).distinct().collect()]
    seen = old.where(F.col(partition).isin(months)).select(*keys, F.xxhash64(*columns).alias("_same"))
    batch = batch.withColumn("_same", F.xxhash64(*columns)).join(seen, [*keys, "_same"], "left_anti").select(*batch.columns)
    if precedence:  # so is what loses against a stored row
        held = old.select(*keys, F.struct(*precedence).alias("_best")).join(batch.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(F.max("_best").alias("_best"))
        batch = warehouse.step(batch.join(held, keys, "left").where(F.col("_best").isNull() | (F.col("_best") <= F.struct(*precedence))).select(*batch.columns))
    moving = batch.select(*keys) if removed is None else batch.select(*keys).unionByName(removed.select(*keys))
    touched = batch.select(partition).unionByName(old.select(*keys, partition).join(moving.distinct(), keys, "left_semi").select(partition))
    touched = sorted(r[0] for r in touched.distinct().collect())
    if not touched:
        return old, []
    rivals = old.where(F.col(partition).isin(touched))
    if removed is not None:
        rivals = rivals.join(removed.select(*keys), keys, "left_anti")
    return warehouse.write(upsert(rivals, batch, keys, precedence), name, partition, touched, cluster_by, bloom), touched


def fact_delta(old: DataFrame, new: DataFrame, batch: DataFrame, touched: list[str]) -> DataFrame:
    """The fact's rows that a merge took out or changed (side `left`), and those it brought or changed (`came`)."""
    columns = [c for c in new.columns if c in old.columns]
    mark = F.xxhash64(*[c for c in columns if c != "_loaded_at"]).alias("_same")
    ids = batch.select("txn_id").distinct()
    a, b = (df.where(F.col("txn_month").isin(touched)).join(ids, "txn_id", "left_semi").select(*columns, mark) for df in (old, new))
    only = lambda x, y, side: x.join(y.select("txn_id", "_same"), ["txn_id", "_same"], "left_anti").withColumn("side", F.lit(side))
    return only(a, b, "left").unionByName(only(b, a, "came")).drop("_same")
