"""The curated zone: snapshots of Parquet by season and course, and a manifest of which snapshot each meet is in.

A run writes the rows of its meets to snapshot folders of its own and then puts a new manifest in place, by one rename for all tables. Until then readers
see the zone as it was; a run that fails leaves folders that no manifest names.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from natatio.operators.curate import small
from natatio.schemas import CURATED, MANIFEST, QUARANTINE
from natatio.sources import versions
from natatio.sources.versions import exists, place, tidy

__all__ = ["append_if_absent", "compact", "delete_meet", "exists", "expire", "manifest", "place", "quarantined", "read_curated", "register_catalog", "scrapes", "scratch_path", "without_meet", "write_curated"]

PARTS = ("season", "course")
SCHEMAS = CURATED | {"quarantine": QUARANTINE}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); a temporary one on a single machine only."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir")
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="natatio-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _manifests(root: str) -> str:
    return f"{root}/_manifests"


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """``(tab, meet_id, snap, scrape, live)`` of a version, the last one if none is named.

    A meet is live in one snapshot of a table; where rows of it lie in other snapshots that are still read, these pairs are listed as not live.
    """
    return versions.read(spark, _manifests(root), MANIFEST, version)


def scrapes(spark: SparkSession, root: str) -> DataFrame:
    """``(meet_id, scrape)``: the scrape that each meet's rows come from."""
    return manifest(spark, root).where("live and tab = 'dim_meet'").select("meet_id", "scrape")


def read_curated(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table of the zone as of one manifest (the last one if none is named), with its declared schema.

    Snapshots with live meets are read by name (as many as there were runs since ``compact``); season and course come from folders. What was replaced since it was written is left out by
    an anti-join with the pairs listed for that, if there are any.
    """
    schema = SCHEMAS[table]
    own = manifest(spark, root, version).where(F.col("tab") == table)
    snaps = sorted(r.snap for r in own.where("live").select("snap").distinct().collect())
    if not snaps:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, StructField("snap", StringType())])).option("basePath", f"{root}/{table}").parquet(*(f"{root}/{table}/snap={s}" for s in snaps))
    gone = own.where("not live").select("meet_id", "snap")
    if not gone.isEmpty():
        rows = rows.join(small(gone), ["meet_id", "snap"], "left_anti")
    return rows.select(*schema.names)


#: A table of a run, or what makes it of tables that the run has written before, by their names.
Table = DataFrame | Callable[[Callable[[str], DataFrame]], DataFrame]


def write_curated(tables: dict[str, Table], root: str, scraped: DataFrame | None = None) -> dict[str, int]:
    """Replace the meets of ``dim_meet`` (where it isn't among the tables, those that a table holds) in all these tables, and no others, by one commit; the rows written to each table.

    Each table is evaluated once; its rows are counted as they are written. Files are dealt by season and course and split at the session's advisory size, so that a large season makes
    many files and small ones few. Tables with a row for a result or lap are written one after another, and what one has shuffled is deleted before the next, so that the disk needed is
    that of the largest. A meet that has no rows in a table any more has none afterwards, and one that changed its season or course is only where it is now. Of ``quarantine``, the
    meets with new lines are replaced too. ``scraped`` (``meet_id, scrape``) tells where the rows come from. If another run commits meanwhile, this one is refused
    (``versions.Conflict``); nothing of it is seen then, nor after any other failure.
    """
    spark = next(rows for rows in tables.values() if isinstance(rows, DataFrame)).sparkSession
    base = versions.current(spark, _manifests(root))
    snap, counts = f"{base + 1:010d}-{uuid.uuid4().hex[:8]}", {}
    written = lambda name: spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}/snap={snap}")
    there = lambda name: written(name).select("meet_id").distinct()

    def write(name: str) -> None:
        seen = Observation()
        rows = tables[name] if isinstance(tables[name], DataFrame) else tables[name](written)
        rows = rows.select(*(F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields))
        parts = [p for p in PARTS if p in rows.columns]
        rows = rows.hint("rebalance", *parts).sortWithinPartitions(*parts, "meet_id").observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.partitionBy(*parts).option("compression", "zstd").parquet(f"{root}/{name}/snap={snap}")
        counts[name] = seen.get["n"]

    def write_all(names: list[str]) -> None:
        for name in names:
            write(name)

    # Small tables don't wait for large ones: they are written in the tasks that these leave free.
    large = sorted((name for name in tables if "result_id" in SCHEMAS[name].names), key=lambda name: not isinstance(tables[name], DataFrame))
    turns = [large, *([name] for name in tables if name not in large)]
    with tidy(spark), ThreadPoolExecutor(len(turns)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write_all), names) for names in turns]:
            done.result()
    replaced = []
    for name in tables:
        own = there("dim_meet" if "dim_meet" in tables else name)
        if name == "quarantine" and "dim_meet" in tables:
            own = own.union(there(name)).distinct()
        replaced.append(own.withColumn("tab", F.lit(name)))
    new = replaced[0]
    for more in replaced[1:]:
        new = new.unionByName(more)
    new = new.join(small(scraped.select("meet_id", "scrape")), "meet_id", "left") if scraped is not None else new.withColumn("scrape", F.lit(None).cast("string"))
    new = new.withColumns({"snap": F.lit(snap), "live": F.lit(True)})
    _commit(manifest(spark, root, base), new, root, base)
    return counts


def _commit(before: DataFrame, new: DataFrame, root: str, base: int) -> int:
    """The next manifest: these meets are where ``new`` says; snapshots without live meets are listed no more."""
    taken = new.select("tab", "meet_id", F.lit(True).alias("taken"))
    old = before.join(taken, ["tab", "meet_id"], "left").withColumn("live", F.col("live") & F.col("taken").isNull())
    kept = old.groupBy("tab", "snap").agg(F.max("live").alias("any")).where("any").select("tab", "snap")
    rows = old.join(kept, ["tab", "snap"], "left_semi").select(*MANIFEST.names).unionByName(new.where("live").select(*MANIFEST.names))
    return versions.commit(rows.hint("rebalance"), _manifests(root), base)


def delete_meet(spark: SparkSession, root: str, meet_id: str) -> None:
    """Delete a meet from all tables, by one commit; its bytes go with ``compact`` and ``expire``."""
    base = versions.current(spark, _manifests(root))
    gone = spark.createDataFrame([(name, meet_id, None, None, False) for name in SCHEMAS], MANIFEST)
    _commit(manifest(spark, root, base), gone, root, base)


def compact(spark: SparkSession, root: str, seasons: list[int] | None = None) -> dict[str, int]:
    """Bring the meets of these seasons (of all, if none are named) together in one snapshot, by one commit.

    Afterwards they are replaced like any others. Worth it when runs have left many snapshots; ``expire`` then frees the old ones.
    """
    version = versions.current(spark, _manifests(root))
    tables = {name: read_curated(spark, root, name, version) for name in SCHEMAS}
    if seasons is not None:
        tables = {name: rows.where(F.col("season").isin(seasons)) for name, rows in tables.items() if "season" in rows.columns}
    return write_curated(tables, root, scrapes(spark, root))


def expire(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete manifests but the last ``keep``, and the snapshot folders that none of these reads; how many folders went.

    Folders of runs that began from the last manifest and may still be writing are left alone.
    """
    left = versions.expire(spark, _manifests(root), keep)
    used = {(r.tab, r.snap) for v in left for r in manifest(spark, root, v).where("live").select("tab", "snap").distinct().collect()}
    old = [(name, n) for name in SCHEMAS for n in versions.names(spark, f"{root}/{name}", "snap=*") if int(n[5:15]) <= max(left, default=0) and (name, n[5:]) not in used]
    for name, folder in old:
        versions.remove(spark, f"{root}/{name}/{folder}")
    return len(old)


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """Lines that were set aside, of meets whose last scrape couldn't be taken."""
    return read_curated(spark, root, "quarantine")


def register_catalog(spark: SparkSession, root: str, database: str = "default") -> None:
    """Views by the tables' names, as of the last manifest, over external tables of all snapshots (``<table>_rows``) whose partitions are repaired. To be called again after runs."""
    version = versions.current(spark, _manifests(root))
    if not version:
        raise ValueError(f"nothing has been written to {root}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.zone_manifest")
    columns = lambda schema: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {database}.zone_manifest ({columns(MANIFEST)}) USING parquet LOCATION '{_manifests(root)}/v{version:010d}'")
    for name, schema in CURATED.items():
        if not exists(spark, f"{root}/{name}"):
            continue
        names = ", ".join(f"r.`{n}`" for n in schema.names)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name}_rows ({columns(schema)}, snap string) USING parquet PARTITIONED BY (snap, {', '.join(PARTS)}) LOCATION '{root}/{name}'")
        spark.sql(f"MSCK REPAIR TABLE {database}.{name}_rows")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {names} FROM {database}.{name}_rows r LEFT SEMI JOIN {database}.zone_manifest m ON m.live AND m.tab = '{name}' AND m.meet_id = r.meet_id AND m.snap = r.snap")


def append_if_absent(target: DataFrame, new: DataFrame, keys: list[str], position: str | None = None) -> DataFrame:
    """The target with the new rows whose key it doesn't have, each key once: the first by ``position``, a column of the rows.

    Null keys are like no other and are appended.
    """
    if position is not None:
        turn = F.row_number().over(Window.partitionBy(*keys).orderBy(position))
        new = new.withColumn("_turn", turn).where("_turn = 1").drop("_turn")
    return target.unionByName(new.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(*target.columns))


def without_meet(rows: DataFrame, meets: DataFrame) -> DataFrame:
    """Rows of other meets than these."""
    return rows.join(meets.select("meet_id"), "meet_id", "left_anti")
