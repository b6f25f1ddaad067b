"""Landing files to text tables: scan by header name, incremental selection, audit."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.schema import LOAD_ORDER, RAW_COLUMNS, raw_schema
from ledgerflow.sources.scratch import hold

AUDIT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("rows_parsed", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("errors_seen", T.LongType()),
        T.StructField("first_error", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)
CORRUPT, MALFORMED = "_corrupt", "_malformed"
#: A row in which a quoted field begins and doesn't end.
UNCLOSED = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+$'


def list_files(spark: SparkSession, landing: str, entity: str) -> DataFrame:
    """file_name (<entity>/<file>), path and file_date of the entity's landed files."""
    raw_schema(entity)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{entity}_????????.csv*").load(f"{landing}/{entity}").select("path")
    name = F.concat(F.lit(f"{entity}/"), F.element_at(F.split("path", "/"), -1))
    return files.select(name.alias("file_name"), "path").withColumn("file_date", F.try_to_date(F.regexp_extract("file_name", r"_(\d{8})\.csv", 1), "yyyyMMdd"))


def pending_files(files: DataFrame, audit: DataFrame | None = None, through: dt.date | None = None, since: dt.date | None = None) -> DataFrame:
    """Files that no audited run has loaded, up to and including `through` by the date in the name."""
    if audit is not None:
        files = files.join(audit.where("status = 'LOADED'").select("file_name").distinct(), "file_name", "left_anti")
    if since is not None:
        files = files.where(F.col("file_date") >= F.lit(since))
    return files.where(F.col("file_date") <= F.lit(through)) if through is not None else files


def landed_lines(spark: SparkSession, paths: list[str], keep: Callable[[DataFrame], DataFrame] = hold) -> DataFrame:
    """The files' lines that aren't blank: value, _path, the split they were read in (_start, its first byte) and _id.

    They are written once by keep. Within a split ids rise by one from line to line; both come from the one scan that
    was written, so that numbers don't depend on how a second scan would cut the files."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
    return keep(lines.where(F.regexp_like("value", F.lit(r"[^\x00-\x20]"))).withColumn("_id", F.monotonically_increasing_id()))


def split_places(lines: DataFrame) -> DataFrame:
    """One row a split: _path, _start, the _id of its first line, and the lines of its file before it (_before).

    Lines are counted by split where they are; only counts are summed up along a file."""
    splits = lines.groupBy("_path", "_start").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("_path", "_start", "_first", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before"))


def column_names(head: str) -> list[str]:
    return [h.strip().strip('"').lower() for h in head.split(",")]


def read_landing(spark: SparkSession, paths: list[str], entity: str, loaded_at: dt.datetime | None = None, keep: Callable[[DataFrame], DataFrame] = hold) -> DataFrame:
    """The files' rows as text, columns found by header name whatever their order and case, plus file metadata.

    Columns a file lacks are null, columns the table lacks are left out. A ragged row is kept as far as it fills
    columns; `_corrupt` then holds its text, for the audit. Two quotes inside a quoted field stand for one. A row whose last quoted field doesn't end has no certain
    columns: it is `_malformed`. A row's number counts the lines of its file that aren't blank, from the header (0) on.

    All files are scanned once, by split, whatever their number. Spark binds a CSV schema by position, so a row is
    parsed by the header of its file; the headers that differ come to the driver, not those of all files."""
    schema, flags = raw_schema(entity), [T.StructField(CORRUPT, T.StringType()), T.StructField(MALFORMED, T.BooleanType())]
    if not paths:
        return spark.createDataFrame([], T.StructType(schema.fields + flags))
    lines = landed_lines(spark, sorted(paths), keep)
    places = keep(split_places(lines))
    heads = lines.join(places.where("_before = 0").select("_path", F.col("_first").alias("_id")), ["_path", "_id"])
    head = F.regexp_replace("value", r"^\ufeff|\r$", "")
    heads = keep(heads.select("_path", head.alias("_head")))
    stamp = F.lit(loaded_at) if loaded_at is not None else F.current_timestamp()
    rows = lines.join(places.join(heads, "_path"), ["_path", "_start"])
    rows = rows.withColumn("_source_row", F.col("_id") - F.col("_first") + F.col("_before")).where("_source_row > 0")
    found = {h["_head"]: column_names(h["_head"]) for h in heads.select("_head").distinct().orderBy("_head").collect()}
    parsed, values = [], {c: [] for c in (*RAW_COLUMNS[entity], CORRUPT)}
    for i, (text, names) in enumerate(found.items()):
        first = [n if n in values and n not in names[:at] else f"_other{at}" for at, n in enumerate(names)]
        own = T.StructType([T.StructField(n, T.StringType()) for n in (*first, CORRUPT)])
        fields = F.from_csv("value", own.simpleString(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'})
        parsed.append(F.when(F.col("_head") == text, fields).alias(f"_parsed{i}"))
        for n in {*first, CORRUPT} & values.keys():
            values[n].append(F.col(f"_parsed{i}.{n}"))
    broken = F.regexp_like("value", F.lit(UNCLOSED))
    rows = rows.select("_path", "_source_row", F.when(broken, F.col("value")).alias("_broken"), *parsed)
    text_of = lambda c: F.coalesce(*values[c], F.lit(None).cast("string"))
    return rows.select(
        *[text_of(c).alias(c) for c in RAW_COLUMNS[entity]],
        F.concat(F.lit(f"{entity}/"), F.element_at(F.split("_path", "/"), -1)).alias("_source_file"),
        "_source_row",
        stamp.cast("timestamp_ntz").alias("_loaded_at"),
        F.coalesce(F.col("_broken"), text_of(CORRUPT)).alias(CORRUPT),
        F.col("_broken").isNotNull().alias(MALFORMED),
    )


def audit_rows(landed: DataFrame, entity: str, run_id: str, loaded_at: dt.datetime, rejects: DataFrame | None = None, files: list[str] | None = None) -> DataFrame:
    """One audit row a file, also for one of files without rows; a run without files says so in one row.

    landed are the rows that were loaded, rejects those that were skipped: both were parsed, and count as errors if
    their text was kept."""
    spark, columns = landed.sparkSession, ["_source_file", "_source_row", CORRUPT]
    seen = landed.select(*columns, F.lit(1).alias("kept"))
    if rejects is not None:
        seen = seen.unionByName(rejects.select(*columns, F.lit(0).alias("kept")))
    first = F.min_by(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), F.col("_source_row")))
    counted = seen.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"), F.sum("kept").alias("kept"), F.count(CORRUPT).alias("bad"), first.alias("first"))
    if files is not None:
        counted = spark.createDataFrame([(f,) for f in files], "_source_file string").join(counted, "_source_file", "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    rows = counted.select(
        F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity"), F.col("_source_file").alias("file_name"), number("n").alias("rows_parsed"), number("kept").alias("rows_loaded"), number("bad").alias("errors_seen"),
        F.col("first").alias("first_error"), F.lit("LOADED").alias("status"), F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
    )
    return rows if not rows.isEmpty() else spark.createDataFrame([(run_id, entity, None, 0, 0, 0, None, "NO_NEW_FILES", loaded_at)], AUDIT)


def load_entity(spark: SparkSession, landing: str, warehouse, entity: str, through: dt.date | None = None, loaded_at: dt.datetime | None = None, run_id: str | None = None) -> DataFrame:
    """Loads the entity's pending files into the warehouse and returns this run's audit rows.

    Malformed rows are skipped: they go to load_rejects, with their text. Rows count once their audit is written: rows
    that a crash left without one are deleted first, and loaded again."""
    run_id, loaded_at = run_id or uuid.uuid4().hex, loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    batches = lambda table: [b.rsplit("/batch=", 1)[1] for b in warehouse.batches(table)]
    audited = set(batches("load_audit"))
    for batch in [b for b in batches(f"raw_{entity}") if f"{b}-{entity}" not in audited]:
        warehouse.drop_batch(f"raw_{entity}", batch)
    for batch in [b for b in batches("load_rejects") if b.endswith(f"-{entity}") and b not in audited]:
        warehouse.drop_batch("load_rejects", batch)
    audit = warehouse.read("load_audit")
    files = {r["path"]: r["file_name"] for r in pending_files(list_files(spark, landing, entity), audit, through).collect()}
    landed, rejects = read_landing(spark, list(files), entity, loaded_at, warehouse.step), None
    if files:  # written first; the audit counts what was written, and the text of ragged rows stays with them
        skipped = landed.where(MALFORMED).select(F.lit(entity).alias("entity"), "_source_file", "_source_row", "_loaded_at", CORRUPT)
        rows = landed.where(~F.col(MALFORMED)).drop(MALFORMED)
        warehouse.append(skipped, "load_rejects", f"{run_id}-{entity}")
        warehouse.append(rows, f"raw_{entity}", run_id)
        rejects = spark.read.schema(skipped.schema).parquet(warehouse.batch_path("load_rejects", f"{run_id}-{entity}"))
        landed = spark.read.schema(rows.schema).parquet(warehouse.batch_path(f"raw_{entity}", run_id))
    warehouse.append(audit_rows(landed, entity, run_id, loaded_at, rejects, sorted(files.values()) or None), "load_audit", f"{run_id}-{entity}")
    return warehouse.read("load_audit").where((F.col("run_id") == run_id) & (F.col("entity") == entity))


def load_all(spark: SparkSession, landing: str, warehouse, through: dt.date | None = None, loaded_at: dt.datetime | None = None) -> DataFrame:
    """All entities, reference data first; returns the run's audit."""
    run_id = uuid.uuid4().hex
    for entity in LOAD_ORDER:
        load_entity(spark, landing, warehouse, entity, through, loaded_at, run_id)
    return warehouse.read("load_audit").where(F.col("run_id") == run_id)


def load_summary(audit: DataFrame) -> DataFrame:
    """Totals of each run and entity."""
    return audit.groupBy("run_id", "entity").agg(
        F.count_if(F.col("status") == "LOADED").alias("files"), F.sum("rows_parsed").alias("rows_parsed"), F.sum("rows_loaded").alias("rows_loaded"), F.sum("errors_seen").alias("errors_seen"), F.min("first_error").alias("first_error")
    )


def replay_files(spark: SparkSession, landing: str, start: dt.date, end: dt.date) -> DataFrame:
    """Transactions of the files dated start ... end, in delivery order."""
    files = pending_files(list_files(spark, landing, "transactions"), through=end, since=start)
    return read_landing(spark, [r["path"] for r in files.select("path").collect()], "transactions").where(~F.col(MALFORMED)).drop(CORRUPT, MALFORMED).orderBy("_source_file", "_source_row")
