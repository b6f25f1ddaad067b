"""Rows that a plan uses several times, written once to a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=8)
def _own_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir; only where that is unset a local master uses its own disk."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not at:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = _own_folder(context.applicationId)
    return f"{at}/ledgerflow-tables-{context.applicationId}"


def hold(df: DataFrame) -> DataFrame:
    """df, written and read back: later plans read it, and a lost executor loses nothing."""
    at = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
