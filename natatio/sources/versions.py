"""Small tables that change by whole versions: a version is written beside the others and put in place by one rename."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Somebody else put a version in place meanwhile."""


def place(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as that takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = place(spark, path)
    return fs.exists(at)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within it, what a write has shuffled is deleted once it has ended; else it stays until the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names in a folder that fit a pattern."""
    fs, at = place(spark, f"{path}/{pattern}")
    return sorted(s.getPath().getName() for s in fs.globStatus(at) or ())


def remove(spark: SparkSession, path: str) -> None:
    fs, at = place(spark, path)
    fs.delete(at, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; an existing target is an error, and stays as it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    (fs, a), (_, b) = place(spark, source), place(spark, target)
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(fs.makeQualified(a).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(a), fs.makeQualified(b), options)


def _name(version: int) -> str:
    return f"v{version:010d}"


def all_versions(spark: SparkSession, root: str) -> list[int]:
    return [int(n[1:]) for n in names(spark, root, "v*")]


def current(spark: SparkSession, root: str) -> int:
    """The last version; 0 before the first."""
    return max(all_versions(spark, root), default=0)


def read(spark: SparkSession, root: str, schema: StructType | str, version: int | None = None) -> DataFrame:
    """A version of the table, the last one if none is named; version 0 is empty."""
    version = current(spark, root) if version is None else version
    return spark.read.schema(schema).parquet(f"{root}/{_name(version)}") if version else spark.createDataFrame([], schema)


def commit(rows: DataFrame, root: str, base: int) -> int:
    """Put these rows in place as the version after ``base``; refused (``Conflict``) if there is one already.

    Rows may be made from an earlier version of the same table: that one isn't touched. Readers see the old version or the new one.
    """
    spark = rows.sparkSession
    beside, target = f"{root}/_beside-{uuid.uuid4().hex}", f"{root}/{_name(base + 1)}"
    if current(spark, root) != base:
        raise Conflict(f"{root}: version {base} isn't the last one")
    rows.write.parquet(beside)
    try:
        _rename(spark, beside, target)
    except Py4JJavaError as error:
        remove(spark, beside)
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or exists(spark, target):
            raise Conflict(f"{root}: version {base + 1} is there already") from error
        raise
    return base + 1


def expire(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Delete all but the last ``keep`` versions; those that are left."""
    versions = sorted(all_versions(spark, root))
    for version in versions[:-keep]:
        remove(spark, f"{root}/{_name(version)}")
    return versions[-keep:]
