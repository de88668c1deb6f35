"""What the operators of this subpackage share: tables, the shared folder, words."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder is made and set as the checkpoint folder, on a single machine (tests) only; on a
    cluster it is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named and context.getCheckpointDir():
        return named
    if not context.getCheckpointDir():
        if not named and context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="natatio-"))
    return context.getCheckpointDir()


#: Paths that this process has asked for, to be dropped when they have served.
_WRITTEN: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a table in the shared folder."""
    _WRITTEN.append(f"{shared_dir(spark).rstrip('/')}/natatio-{name}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def written() -> int:
    return len(_WRITTEN)


def last_written(since: int) -> tuple[str, ...]:
    """The paths asked for since ``written()`` was ``since``."""
    return tuple(_WRITTEN[since:])


def drop_written(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete the tables of the shared folder that were asked for since ``written()`` was ``since``, but for those to be kept.

    Frames that are still to be read from them can't be read any more.
    """
    for path in [p for p in _WRITTEN[since:] if p not in keep]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _WRITTEN.remove(path)


def settled(frame: DataFrame) -> DataFrame:
    """The frame with its lineage cut by a checkpoint in the shared folder."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The frame by way of a Parquet table in the shared folder: cuts lineage in less space than a checkpoint.

    Of the codecs, ``zstd`` takes its buffers from a pool; those of ``snappy`` lie outside the heap until the garbage collector finds them, which may be a gigabyte for tables of long arrays.
    """
    path = shared_path(frame.sparkSession, name)
    frame.write.option("compression", codec).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def most_common(counts: DataFrame, limit: int) -> pd.DataFrame:
    """The rows of ``counts`` with the greatest ``n``, ``limit`` at most, in falling order, ties by the first column.

    Numbers are graded by their logarithm (64 grades to a factor of e); rows of the highest grades that together have no more than
    ``limit`` come to the driver, so no partition sends rows that aren't kept. ``counts`` is read twice and should be stored.
    """
    grade = F.floor(F.log(F.col("n").cast("double")) * 64)
    least, total = None, 0
    for row in sorted(counts.groupBy(grade.alias("grade")).agg(F.count("*").alias("many")).collect(), reverse=True):
        total += row["many"]
        if total > limit:
            break
        least = row["grade"]
    kept = counts.where(grade >= least) if least is not None else counts.limit(0)
    return kept.toPandas().sort_values(["n", counts.columns[0]], ascending=[False, True], ignore_index=True)


#: A key of over one in so many rows is hot; by that there are at most so many hot keys.
HOT_KEYS = 1000


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row for each key; ``counts(*keys, n)`` tells how many rows ``left`` has of a key.

    Rows of hot keys aren't brought together in one task: the rows of ``right`` for these, ``HOT_KEYS`` at most, go to every task.
    ``right`` and ``counts`` are read more than once and should be stored.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * HOT_KEYS > total).select(*keys)
    if total < HOT_KEYS or hot.isEmpty():
        return left.join(right, keys)
    hot = F.broadcast(settled(hot))
    return left.join(F.broadcast(right.join(hot, keys, "left_semi")), keys).unionByName(left.join(hot, keys, "left_anti").join(right, keys))


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, in lists of bounded length.

    ``bytes.split()`` cuts at exactly these six separators. A text over ``size`` bytes is cut
    at a separator, so that no word is broken and no list grows with the text.
    """
    start = 0
    while len(data) - start > size:
        cut = _SEPARATOR.search(data, start + size)
        if cut is None:
            break
        yield data[start : cut.start()].split()
        start = cut.end()
    yield (data[start:] if start else data).split()
