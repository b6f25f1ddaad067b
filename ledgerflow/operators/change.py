"""Change over time: histories, snapshots, incremental merges, differences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.columns import surrogate_key
from ledgerflow.operators.temporal import latest_by


def scd2_from_feed(feed: DataFrame, key: str, version_ts: str, attributes: list[str], tie: list[str]) -> DataFrame:
    """feed with valid_from, valid_to, is_current and version_key, one row for each real change.

    Of repeated versions the last by `tie` counts; a version that changes no attribute disappears, while A, B, A stays
    three. All windows share one partitioning, so there is one shuffle."""
    return scd2_from_versions(latest_by(feed, [key, version_ts], tie), key, version_ts, attributes)


def scd2_from_versions(versions: DataFrame, key: str, version_ts: str, attributes: list[str]) -> DataFrame:
    """The history of versions, one row for each key and moment."""
    order = Window.partitionBy(key).orderBy(version_ts)
    once = versions.withColumn("_state", surrogate_key(*[F.col(c) for c in attributes]))
    changed = once.withColumn("_before", F.lag("_state").over(order)).where(F.col("_before").isNull() | (F.col("_before") != F.col("_state")))
    following = F.lead(version_ts).over(order)
    return changed.withColumns(
        {"valid_from": F.col(version_ts), "valid_to": following, "is_current": following.isNull(), "version_key": surrogate_key(F.col(key), F.col(version_ts))}
    ).drop("_state", "_before")


def splice_versions(versions: DataFrame | None, news: DataFrame, key: str, version_ts: str, tie: list[str]) -> DataFrame:
    """Versions (one row for each key and moment, changing anything or not) with newly delivered ones spliced in, late and
    repeated ones included. A version without a change has to be kept: one that comes between may turn it into a change."""
    return upsert(versions, latest_by(news, [key, version_ts], tie), [key, version_ts], tie)


def splice_scd2(history: DataFrame, versions: DataFrame, news: DataFrame, key: str, version_ts: str, attributes: list[str]) -> DataFrame:
    """history with the rows of the keys in news made anew from their spliced versions; all other rows stay as they are."""
    return splice(history, versions, news, key, lambda rows: scd2_from_versions(rows, key, version_ts, attributes))


def splice(history: DataFrame, versions: DataFrame, news: DataFrame, key: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    touched = news.select(F.col(key).alias("_touched")).distinct()
    mine = lambda df, how: df.join(touched, df[key].eqNullSafe(F.col("_touched")), how)
    return mine(history, "left_anti").unionByName(make(mine(versions, "left_semi")))


def snapshot(target: DataFrame | None, current: DataFrame, key: str, updated_at: str) -> DataFrame:
    """target with the rows of current that are new or newer; open versions they replace are closed at that moment.

    Adds valid_from and valid_to. current holds one row a key."""
    fresh = current.withColumns({"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast("timestamp_ntz")})
    if target is None:
        return fresh
    opened = target.where("valid_to is null").select(F.col(key).alias("_k"), F.col(updated_at).alias("_seen"))
    news = fresh.join(opened, fresh[key] == F.col("_k"), "left").where(F.col("_k").isNull() | (F.col(updated_at) > F.col("_seen"))).drop("_k", "_seen")
    closing = news.select(F.col(key).alias("_k"), F.col("valid_from").alias("_end"))
    kept = target.join(closing, target[key] == F.col("_k"), "left").withColumn("valid_to", F.when(F.col("valid_to").isNull(), F.col("_end")).otherwise(F.col("valid_to"))).drop("_k", "_end")
    return kept.unionByName(news)


def upsert(target: DataFrame | None, batch: DataFrame, keys: list[str], precedence: list[str | Column] = ()) -> DataFrame:
    """target with the rows of batch put in by key.

    With precedence, rows of both sides that share a key compete and the last by that order stays, so that an older
    delivery which arrives late doesn't replace a newer one; without, batch wins. Columns that only batch has are
    null in older rows. Keys are compared null-safe."""
    if target is None:
        return latest_by(batch, keys, list(precedence)) if precedence else batch
    same = lambda a, b: [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys]
    touched = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    untouched = target.join(touched, same(target, touched), "left_anti")
    if not precedence:
        return untouched.unionByName(batch, allowMissingColumns=True)
    rivals = target.join(touched, same(target, touched), "left_semi").unionByName(batch, allowMissingColumns=True)
    return untouched.unionByName(latest_by(rivals, keys, list(precedence)), allowMissingColumns=True)


def loaded_since(df: DataFrame, target: DataFrame | None, column: str = "_loaded_at", lookback_hours: int = 3) -> DataFrame:
    """Rows of df loaded after the target's newest, less a lookback for late commits; all rows for no or empty target."""
    if target is None:
        return df
    newest = target.agg(F.max(column)).first()[0]
    return df if newest is None else df.where(F.col(column) > F.lit(newest) - F.expr(f"interval {int(lookback_hours)} hours"))


def symmetric_diff(a: DataFrame, b: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Rows that only one of the two has, counting repeats, with `side`."""
    cols = [c for c in a.columns if c not in exclude]
    left, right = a.select(*cols), b.select(*cols)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def checksum_diff(a: DataFrame, b: DataFrame, exclude: tuple[str, ...] = (), buckets: int = 4096) -> DataFrame:
    """symmetric_diff(), for tables that are mostly equal: rows are dealt to buckets by their hash, buckets are compared by
    their count and two sums of hashes, which don't depend on order, and only rows of buckets that differ are compared
    themselves. Of equal tables nothing moves but the sums, a row for each bucket and task. The differing buckets, at
    most `buckets` numbers, are broadcast. Both tables are read twice."""
    cols = [c for c in a.columns if c not in exclude]
    parts = [x for c in cols for x in (F.col(c), F.col(c).isNull())]  # a null alone would leave the hash as it is
    one, two = F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)
    dealt = lambda df: df.select(*cols).withColumn("_bucket", F.pmod(one, F.lit(buckets)).cast("int"))
    sums = lambda df, sign: dealt(df).select("_bucket", F.lit(sign).alias("n"), *[(F.lit(sign) * x.cast("decimal(20,0)")).cast("decimal(21,0)").alias(n) for n, x in (("h1", one), ("h2", two))])
    total = sums(a, 1).unionByName(sums(b, -1)).groupBy("_bucket").agg(F.sum("n").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    differ = F.broadcast(total.where("n <> 0 or h1 <> 0 or h2 <> 0").select("_bucket"))
    left, right = (dealt(df).join(differ, "_bucket", "left_semi").select(*cols) for df in (a, b))
    return symmetric_diff(left, right)
