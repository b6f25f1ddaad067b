"""What the training-data operators share: table access, intermediate tables, word rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A word is a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=8)
def _local_dir(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application below spark.checkpoint.dir, which driver and executors share.

    Where that is unset a local master gets a fresh folder of this machine; on a cluster it is an error."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not at:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = _local_dir(context.applicationId)
    return f"{at}/ledgerflow-{context.applicationId}"


def clear(spark: SparkSession) -> None:
    """Deletes what this application has written to the shared folder. Results not yet computed are lost with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read back: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


@contextmanager
def few_rows_a_batch(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """What runs inside hands texts to Python so many rows at a time, as the JVM and Python both hold a batch whole."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(col, UPPER, LOWER)


def word_count(col: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def empty_if_null(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))
