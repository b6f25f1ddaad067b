"""Exactly-once landing: the landed table, not the offsets a consumer committed, says what has been taken in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.operators.rank import exact_percentiles
from ledgerflow.operators.temporal import latest_by
from ledgerflow.sources.tables import Warehouse
from ledgerflow.streaming.events import decode_events

POSITION = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]


def land_batch(warehouse: Warehouse, name: str, rows: DataFrame, batch: str) -> None:
    """Adds decoded rows that aren't landed yet, as one batch that counts whole or not at all.

    A small table beside it, a row for each batch and partition, holds the highest offsets, so that a batch needs no
    look at what was landed before it; batches that a crash left without such rows are read instead. The batch's own
    folder is left out, so that a replay writes it again completely."""
    others = lambda table: {b.rsplit("/batch=", 1)[1]: b for b in warehouse.batches(table) if not b.endswith(f"/batch={batch}")}
    data, noted = others(name), others(f"{name}_offsets")
    known = [warehouse.spark.read.parquet(*noted.values())] if noted else []
    unnoted = [path for b, path in data.items() if b not in noted]
    known += [highest(warehouse.spark.read.parquet(*unnoted))] if unnoted else []
    fresh = rows.dropDuplicates(POSITION)
    if known:
        landed = reduce(DataFrame.unionByName, known).groupBy("_kafka_topic", "_kafka_partition").agg(F.max("_high").alias("_high"))
        fresh = fresh.join(F.broadcast(landed), ["_kafka_topic", "_kafka_partition"], "left").where(F.col("_high").isNull() | (F.col("_kafka_offset") > F.col("_high"))).drop("_high").select(*rows.columns)
    warehouse.append(fresh, name, batch)
    own = warehouse.spark.read.schema(fresh.schema).parquet(warehouse.batch_path(name, batch))
    warehouse.append(highest(own).coalesce(1), f"{name}_offsets", batch)


def highest(landed: DataFrame) -> DataFrame:
    """The highest offset of each partition."""
    return landed.groupBy("_kafka_topic", "_kafka_partition").agg(F.max("_kafka_offset").alias("_high"))


def land_stream(source: DataFrame, warehouse: Warehouse, name: str, checkpoint: str, run_id: str = "run", trigger: dict | None = None) -> StreamingQuery:
    """Starts landing a streaming source of messages (topic, partition, offset, timestamp_ms, value).

    run_id goes into the batch names: a new checkpoint counts its batches from 0 again and needs a new run_id."""
    land = lambda df, n: land_batch(warehouse, name, decode_events(df), f"{run_id}-{n:010d}")
    return source.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def exactly_once(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """A row for each partition of expected (partition, low, high exclusive) or landed, and whether each offset is there once."""
    seen = landed.groupBy(F.col("_kafka_partition").alias("partition")).agg(
        F.count(F.lit(1)).alias("landed"), F.countDistinct("_kafka_offset").alias("distinct_offsets"), F.min("_kafka_offset").alias("min_offset"), F.max("_kafka_offset").alias("max_offset"), F.count("_parse_error").alias("unparseable")
    )
    both = seen.join(expected.select("partition", "low", "high"), "partition", "full").fillna(0, ["landed", "distinct_offsets", "unparseable", "low", "high"])
    n = F.col("high") - F.col("low")
    whole = (F.col("landed") == n) & (F.col("distinct_offsets") == n) & F.when(n == 0, True).otherwise((F.col("min_offset") == F.col("low")) & (F.col("max_offset") == F.col("high") - 1))
    return both.withColumn("ok", F.coalesce(whole, F.lit(False)))


def large_rows(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.where("txn_id is not null and status = 'POSTED'").where(F.col("amount") >= F.lit(threshold))


def alert_columns(rows: DataFrame, detected_at=None) -> DataFrame:
    now = F.lit(detected_at) if detected_at is not None else F.current_timestamp()
    return rows.select("txn_id", "account_id", "amount", "currency", "txn_type", "txn_ts_raw", "_source_file", now.cast("timestamp_ntz").alias("detected_at"), "ingest_path", "produced_at", "landed_at")


def screen_large(rows: DataFrame, alerts: DataFrame | None, threshold: float = 10_000, detected_at=None) -> DataFrame:
    """New alerts for posted rows of at least threshold, once for each transaction and path, the earliest landed first.

    rows: txn_id, account_id, amount, currency, txn_type, status, txn_ts_raw, _source_file, ingest_path, produced_at,
    landed_at."""
    first = latest_by(large_rows(rows, threshold), ["txn_id", "ingest_path"], [-F.unix_micros(F.col("landed_at").cast("timestamp")), "_source_file"])
    if alerts is not None:
        first = first.join(alerts.select("txn_id", "ingest_path"), ["txn_id", "ingest_path"], "left_anti")
    return alert_columns(first, detected_at)


def screen_stream(rows: DataFrame, warehouse: Warehouse, name: str, checkpoint: str, threshold: float = 10_000, run_id: str = "run", trigger: dict | None = None, delay: str = "1 day") -> StreamingQuery:
    """Starts screening a stream of rows, as screen_large() does: an alert for each transaction and path, when it first comes.

    Spark's state remembers what has been alerted, for `delay` behind the latest landed_at, so it is bounded and no batch
    reads earlier alerts; a transaction that lands again later than that is alerted again, one that is itself later than
    that is left out. Alerts of a batch are written to a folder of their own, so a replay after a crash writes the same
    ones again. run_id: as in land_stream(). Rows without landed_at are not screened."""
    timed = large_rows(rows, threshold).where("landed_at is not null").withColumn("_event_time", F.col("landed_at").cast("timestamp"))
    once = timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["txn_id", "ingest_path"])
    screen = lambda df, n: warehouse.append(alert_columns(df), name, f"{run_id}-{n:010d}")
    return once.writeStream.foreachBatch(screen).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def trailing_alerts(rows: DataFrame, minutes: int, least: int, delay: str = "1 hour", slide_minutes: int = 1) -> DataFrame:
    """account_id, window_start, window_end, n: accounts with at least `least` rows in a window of `minutes`, on a stream.

    rows: account_id, txn_id, txn_ts. Windows begin every slide_minutes, so a burst that fits into `minutes` less one
    slide is found for certain. A transaction that comes again within the watermark counts once. Windows are given out
    once the watermark has passed them; rows later than `delay` no longer count, and state older than that is dropped."""
    timed = rows.where("account_id is not null and txn_ts is not null").withColumn("_event_time", F.col("txn_ts").cast("timestamp")).withWatermark("_event_time", delay)
    once = timed.dropDuplicatesWithinWatermark(["txn_id"])
    counted = once.groupBy("account_id", F.window("_event_time", f"{minutes} minutes", f"{slide_minutes} minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least).select("account_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n")


def latency(alerts: DataFrame) -> DataFrame:
    """Rows, median, 95th percentile and maximum, in seconds, of each leg from produced over landed to detected.

    The percentiles are exact; gaps are counted by value and by ranges of values, so no task holds all gaps of a leg."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    legs = {"produced_to_landed": ("produced_at", "landed_at"), "landed_to_alert": ("landed_at", "detected_at"), "produced_to_alert": ("produced_at", "detected_at")}
    gaps = F.array(*[F.struct(F.lit(k).alias("leg"), ((micros(b) - micros(a)) / 1_000_000).alias("s")) for k, (a, b) in legs.items()])
    rows = alerts.where("produced_at is not null").select(F.explode(gaps).alias("g")).select("g.*")
    return exact_percentiles(rows, ["leg"], "s", {"p50_s": 0.5, "p95_s": 0.95, "max_s": 1.0})


def missed_alerts(alerts: DataFrame, streamed_ids: DataFrame) -> DataFrame:
    """Alerts of the file path whose transaction was on the stream, where it raised none."""
    on_stream = alerts.where("ingest_path = 'KAFKA'").select("txn_id")
    return alerts.where("ingest_path = 'FILE'").join(streamed_ids.select("txn_id"), "txn_id", "left_semi").join(on_stream, "txn_id", "left_anti")
