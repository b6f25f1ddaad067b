"""Parquet tables whose changes count all at once: files are only ever added, and one small list says which of them count."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Version:
    """What a table consists of: its schema, its partition column if it has one, and the folders that each partition's
    rows are in (by the partition's folder name; an unpartitioned table has one, with an empty name)."""

    schema: dict
    partition: str | None = None
    folders: dict[str, list[str]] = field(default_factory=dict)


class Warehouse:
    """Tables below one root, in any file system that Spark writes to.

    write() puts rows into a folder of their own, which nobody reads before publish() has written the next list of all
    tables' folders. So readers see the tables of one moment, a crash at any point changes nothing that counts, and all
    tables written between two publications change together. One process writes at a time; appended batches, which
    count by themselves, may come from others."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._pending: dict[str, Version] = {}
        self._known: dict[str, dict[str, Version]] = {}
        self._steps: list[str] = []

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _complete(self, folder: str) -> bool:
        return self._fs.exists(self._path(f"{folder}/_SUCCESS"))

    # ---- lists of what counts
    def _lists(self) -> list[str]:
        return [n for n in self._names(f"{self.root}/_lists") if n.endswith(".json")]

    def _tables(self, name: str) -> dict[str, Version]:
        """The tables of a list; lists never change, so each is read once."""
        if name not in self._known:
            stream = self._fs.open(self._path(f"{self.root}/_lists/{name}"))
            try:
                found = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
            self._known[name] = {table: Version(**v) for table, v in found.items()}
        return self._known[name]

    def _current(self) -> dict[str, Version]:
        lists = self._lists()
        return self._tables(lists[-1]) if lists else {}

    def versions(self, name: str) -> list[Version]:
        """The versions of a table that are still listed, oldest first."""
        found: list[Version] = []
        for of in self._lists():
            version = self._tables(of).get(name)
            if version is not None and (not found or version != found[-1]):
                found.append(version)
        return found

    def publish(self) -> None:
        """Makes everything written since the last publication count, at once."""
        if self._pending:
            lists = self._lists()
            tables = {n: asdict(v) for n, v in {**self._current(), **self._pending}.items()}
            at = f"{self.root}/_lists/{int(lists[-1][:10]) + 1 if lists else 0:010d}.json"
            stream = self._fs.create(self._path(f"{at}.new"), True)
            try:
                stream.write(bytearray(json.dumps(tables), "utf-8"))
            finally:
                stream.close()
            if self._fs.exists(self._path(at)) or not self._fs.rename(self._path(f"{at}.new"), self._path(at)):
                raise RuntimeError(f"{at} is there already: another process has published")
        self._pending = {}
        self._drop_steps()

    def discard(self) -> None:
        """Forgets what was written since the last publication; drop_older() deletes it."""
        self._pending = {}
        self._drop_steps()

    def drop_older(self, keep: int = 2) -> None:
        """Deletes all but the newest lists, and every folder that none of them names."""
        for old in self._lists()[:-keep]:
            self._fs.delete(self._path(f"{self.root}/_lists/{old}"), False)
        held = {(t, f) for of in self._lists() for t, v in self._tables(of).items() for f in sum(v.folders.values(), [])} | {(t, f) for t, v in self._pending.items() for f in sum(v.folders.values(), [])}
        for table in self._names(self.root):
            for folder in self._names(f"{self.root}/{table}"):
                if folder.startswith("write=") and (table, folder) not in held:
                    self._fs.delete(self._path(f"{self.root}/{table}/{folder}"), True)

    # ---- tables
    def read(self, name: str, version: int = -1) -> DataFrame | None:
        """All appended batches, or a published version; None if there is nothing yet."""
        if batches := self.batches(name):
            return self.spark.read.option("mergeSchema", True).parquet(*batches)
        if version == -1:
            found = self._current().get(name)
            return None if found is None else self._load(name, found)
        return self._load(name, self.versions(name)[version])

    def _load(self, name: str, version: Version) -> DataFrame:
        schema = T.StructType.fromJson(version.schema)
        paths = [f"{self.root}/{name}/{folder}/{part}".rstrip("/") for part, folders in sorted(version.folders.items()) for folder in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths).select(*schema.names)

    def write(self, df: DataFrame, name: str, partition_by: str | None = None, touched: list | None = None, cluster_by: str | None = None, bloom: str | None = None) -> DataFrame:
        """Writes rows of a table and returns the table as it will be once published.

        With touched, values of the partition column, df replaces these partitions, and those it has no rows of go; to
        partitions that aren't touched its rows are added, and their files stay. Without, df is the whole table. It may
        read the table. Rows are clustered by a column
        so that row groups can be skipped. Columns new to the table are null in the rows that stay."""
        folder = f"write=w{uuid.uuid4().hex}"
        if cluster_by:
            by = [partition_by, cluster_by] if partition_by else [cluster_by]
            df = df.repartitionByRange(*by).sortWithinPartitions(*by)
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        if bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{bloom}", "true")
        writer.parquet(f"{self.root}/{name}/{folder}")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])  # any column may be null in rows that stay
        if partition_by is None:
            parts = {"": [folder]}
        else:
            gone = {f"{partition_by}={value}" for value in touched or []}
            before = self._current().get(name) if touched is not None else None
            parts = {part: list(at) for part, at in (before.folders if before else {}).items() if part not in gone}
            for part in self._names(f"{self.root}/{name}/{folder}"):
                if part.startswith(f"{partition_by}="):
                    parts.setdefault(part, []).append(folder)
        self._pending[name] = Version(schema.jsonValue(), partition_by, parts)
        return self._load(name, self._pending[name])

    def replace(self, df: DataFrame, name: str, cluster_by: str | None = None, partition_by: str | None = None, bloom: str | None = None) -> DataFrame:
        """Writes a whole table and publishes it."""
        out = self.write(df, name, partition_by, None, cluster_by, bloom)
        self.publish()
        return out

    def step(self, df: DataFrame) -> DataFrame:
        """df, written and read back, until the next publication: what is used several times is computed once."""
        at = f"{self.root}/_steps/{uuid.uuid4().hex}"
        self._steps.append(at)
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def _drop_steps(self) -> None:
        for at in self._steps:
            self._fs.delete(self._path(at), True)
        self._steps = []

    # ---- appended batches
    def batches(self, name: str) -> list[str]:
        """Complete batches of an appended table."""
        return [f"{self.root}/{name}/{b}" for b in self._names(f"{self.root}/{name}") if b.startswith("batch=") and self._complete(f"{self.root}/{name}/{b}")]

    def batch_path(self, name: str, batch: str) -> str:
        return f"{self.root}/{name}/batch={batch}"

    def drop_batch(self, name: str, batch: str) -> None:
        self._fs.delete(self._path(self.batch_path(name, batch)), True)

    def append(self, df: DataFrame, name: str, batch: str) -> None:
        """Adds a batch; writing the same batch again replaces it, so a replay is harmless."""
        df.write.mode("overwrite").parquet(self.batch_path(name, batch))


def write_table(df: DataFrame, path: str, cluster_by: str | None = None, partition_by: str | None = None, table_format: str = "parquet") -> None:
    """A plain overwrite in any format whose writer is on the class path (parquet, orc, or an open table format)."""
    if cluster_by:
        df = df.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
    writer = df.write.format(table_format).mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)


def month_partition(df: DataFrame, date: str) -> DataFrame:
    """df with txn_month, a partition column that date ranges prune."""
    return df.withColumn("txn_month", F.date_format(date, "yyyy-MM"))
