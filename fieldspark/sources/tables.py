"""Parquet tables in a warehouse folder."""

from __future__ import annotations

import atexit
import math
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, suppress
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fieldspark.sources.estimates import UNKNOWN, estimated_bytes

#: Settings of a session that still has Spark's defaults: name, default, value.
#: - Operators are fused into one method only up to the size that the JVM compiles. The rules of a table of
#:   many columns make longer ones, which run interpreted, about half as fast.
#: - A task reads 4 MB of a table's files: its cells, as text, are more than ten times as many bytes.
WIDE_TABLES = (
    ("spark.sql.codegen.hugeMethodLimit", "65535", "8000"),
    ("spark.sql.files.maxPartitionBytes", "134217728b", "4m"),
)


def set_for_wide_tables(spark: SparkSession) -> None:
    """Settings for tables of many computed columns; what the session has set otherwise stays."""
    for name, default, value in WIDE_TABLES:
        if spark.conf.get(name) == default:
            spark.conf.set(name, value)


def balanced(df: DataFrame, min_tasks: int | None = None, task_bytes: int | None = None) -> DataFrame:
    """Redistribute a scan that gives fewer tasks than ``min_tasks``, as files that cannot be split
    do (compressed text, one Parquet row group). Without the argument a scan stays as it is. With
    ``task_bytes`` a scan that is redistributed gives a task for as many bytes of its files, so that
    tasks don't grow with the table."""
    if min_tasks is None or df.rdd.getNumPartitions() >= min_tasks:
        return df
    size = estimated_bytes(df) if task_bytes else UNKNOWN
    return df.repartition(min_tasks if size >= UNKNOWN else max(min_tasks, math.ceil(size / task_bytes)))


#: With this setting Spark deletes the shuffle files of what it runs at its end. Otherwise they stay until the driver
#: happens to collect its garbage, so that those of all writes add up.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning, _before = threading.Lock(), []


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of writes run meanwhile, also of several at the same time. A table that was
    written is read from its files, so nothing asks for them again."""
    with _cleaning:
        _before.append(spark.conf.get(SHUFFLE_CLEANUP, "false"))  # the first is the session's own
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning:
            earlier = _before.pop()
            if not _before:
                spark.conf.set(SHUFFLE_CLEANUP, earlier)


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_folder(spark: SparkSession, path: str) -> None:
    found, system = hadoop_path(spark, path)
    system.delete(found, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    found, system = hadoop_path(spark, path)
    if not system.exists(found):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(found) if s.isDirectory())


#: The file that names the folder a table is read from.
CURRENT = "_current"


@dataclass(frozen=True)
class Warehouse:
    """Tables kept under ``<root>/<layer>/<name>``; ``root`` must be shared by all executors.

    Each write makes a folder of its own beside the earlier ones, and the file ``_current`` names the
    one to read. A table is switched by replacing that file, so readers see the old table or the new
    one, whatever happens to the writer. The table before stays for queries that still read it; older
    ones are deleted."""

    spark: SparkSession
    root: str

    def _folder(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def _versions(self, layer: str, name: str) -> list[str]:
        """The folders of a table that is or was current, the current one first."""
        pointer, system = hadoop_path(self.spark, f"{self._folder(layer, name)}/{CURRENT}")
        if not system.exists(pointer):
            return []
        stream = system.open(pointer)
        try:
            return bytes(stream.readAllBytes()).decode().split()
        finally:
            stream.close()

    def exists(self, layer: str, name: str) -> bool:
        return bool(self._versions(layer, name))

    def path(self, layer: str, name: str) -> str:
        """The folder that holds a table now."""
        found = self._versions(layer, name)
        if not found:
            raise FileNotFoundError(f"no table {layer}/{name} in {self.root}")
        return f"{self._folder(layer, name)}/{found[0]}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def write(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace a table and return it as read back, with its lineage cut."""
        version = self.new_version()
        with shuffles_deleted(self.spark):
            df.write.partitionBy(*partition_by).parquet(self.version_path(layer, name, version))
        self.switch(layer, name, version)
        return self.read(layer, name)

    def append(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Add rows to a table that only grows, and return all of it. Its files are never replaced."""
        path = self.version_path(layer, name, "log")
        df.write.mode("append").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @staticmethod
    def new_version() -> str:
        return f"table-{uuid.uuid4().hex}"

    def version_path(self, layer: str, name: str, version: str) -> str:
        return f"{self._folder(layer, name)}/{version}"

    def switch(self, layer: str, name: str, version: str) -> None:
        """Make a completely written folder the current one."""
        before = self._versions(layer, name)
        folder = self._folder(layer, name)
        beside, system = hadoop_path(self.spark, f"{folder}/{CURRENT}-{uuid.uuid4().hex}")
        stream = system.create(beside, True)
        stream.write("\n".join([version, *before[:1]]).encode())
        stream.close()
        jvm = self.spark._jvm
        replace = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = replace
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        pointer = hadoop_path(self.spark, f"{folder}/{CURRENT}")[0]
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.makeQualified(pointer).toUri(), conf)
        files.rename(system.makeQualified(beside), system.makeQualified(pointer), options)
        for old in before[1:]:
            delete_folder(self.spark, f"{folder}/{old}")

    def register(self, layer: str, name: str, about: str) -> str:
        """Declare the table as it is now in the session catalog, as ``<layer>_<name>``, described by
        ``about`` and its columns by the comments they carry. To be repeated after each write."""
        table = f"{layer}_{name}"
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = self.path(layer, name)
        self.spark.catalog.createTable(table, path, "parquet", self.spark.read.parquet(path).schema, about)
        return table

    def save_as_table(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Replace a table and register it in the session catalog as ``<layer>_<name>``."""
        table = f"{layer}_{name}"
        df.write.mode("overwrite").option("path", f"{self._folder(layer, name)}/catalog").saveAsTable(table)
        return self.spark.table(table)


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: ``spark.checkpoint.dir``, or without that the session's warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


@contextmanager
def scratch_warehouse(spark: SparkSession) -> Iterator[Warehouse]:
    """A fresh shared folder for intermediate tables, deleted at the end. Writing a table there cuts its
    lineage and survives lost executors."""
    house = Warehouse(spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}")
    try:
        yield house
    finally:
        delete_folder(spark, house.root)


def session_warehouse(spark: SparkSession) -> Warehouse:
    """A fresh shared folder for tables that lazy results read, deleted when the program ends."""
    house = Warehouse(spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}")
    found, system = hadoop_path(spark, house.root)

    def delete() -> None:
        with suppress(Exception):  # the JVM may be gone
            system.delete(found, True)

    atexit.register(delete)
    return house


def written(df: DataFrame) -> DataFrame:
    """The same rows, read from a table of the session, with their lineage cut."""
    return session_warehouse(df.sparkSession).write("any", "rows", df)


def kept_rows(df: DataFrame) -> DataFrame:
    """The same few rows, apart from the tables they came from: for results of checks and reports,
    which have a row for each declared check or column."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
