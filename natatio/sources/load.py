"""The legacy load: meets, their races and the results of these, each only if it isn't there yet.

Loads append to three tables under one root. A load's rows lie in folders of its own, and count once its number is put in place among the loads, by one rename for
all three tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from natatio.schemas import columns
from natatio.sources import versions

LOADED = {
    "meet": columns("meet_id string, name string, venue string, course string, season bigint"),
    "race": columns("race_id bigint, meet_id string, number bigint, status string, distance bigint, stroke string, gender string, relay_count bigint"),
    "result": columns("result_id bigint, race_id bigint, swimmer string, birth bigint, team string, rank bigint, points bigint, completed_time string"),
}
LOADS = columns("load string")
RACE_KEY, RESULT_KEY = ("meet_id", "number", "status"), ("race_id", "swimmer", "birth", "team")


#: Parts that rows are numbered in.
BUCKETS = 4096


def fresh_ids(rows: DataFrame, name: str, after: int, *order: str) -> DataFrame:
    """The rows with ids that follow on ``after`` without a gap. Rows are dealt into buckets by the first column of the order and numbered in each; counts of the buckets are summed
    up, a row for each, and tell where a bucket begins."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(order[0]), F.lit(BUCKETS)))
    sums = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    told = rows.withColumn("_place", place).join(F.broadcast(sums.select("_bucket", before.alias("_before"))), "_bucket")
    return told.withColumn(name, (F.lit(after) + F.col("_before") + F.col("_place")).cast("bigint")).drop("_place", "_before", "_bucket")


def _first(rows: DataFrame, keys: tuple[str, ...], *position: str) -> DataFrame:
    """The first row of each key; a key with a null in it is like no other."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*position))
    return rows.where(known).withColumn("_turn", turn).where("_turn = 1").drop("_turn").unionByName(rows.where(~known))


def read_loaded(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table as of one load (the last one if none is named)."""
    schema, loads = LOADED[table], versions.read(spark, f"{root}/_loads", LOADS, version)
    names = sorted(r.load for r in loads.collect())
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{root}/{table}/load={n}" for n in names))


def additions(target: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The rows that a load adds to the three tables.

    - A meet is added if its id isn't there.
    - A race is added if its meet has none of its number and status, with a fresh id. ``new["race"]`` has ``pos``, the order in which races come, and ``source_race``, by which
      results refer to them.
    - Results of a race that was there, or that isn't the first of its key in this load, are left out altogether; of the others the first by ``pos`` of each race, swimmer, birth and team is
      added, with a fresh id.

    Keys with nulls are like no other. Meets without an id, races of meets that aren't there or in the load, and their results are left out.
    """
    top = lambda rows, c: rows.agg(F.max(c)).first()[0] or 0
    meets = _first(new["meet"].where("meet_id is not null"), ("meet_id",), "pos").join(target["meet"].select("meet_id"), "meet_id", "left_anti")
    there = target["meet"].select("meet_id").union(new["meet"].select("meet_id")).distinct()
    races = _first(new["race"], RACE_KEY, "pos").join(target["race"].select(*RACE_KEY), list(RACE_KEY), "left_anti").join(there, "meet_id", "left_semi")
    races = fresh_ids(races, "race_id", top(target["race"], "race_id"), "meet_id", "number", "status", "pos")
    results = new["result"].join(races.select("source_race", "race_id"), "source_race")
    results = fresh_ids(_first(results, RESULT_KEY, "pos"), "result_id", top(target["result"], "result_id"), "race_id", "pos", "swimmer", "birth", "team")
    shaped = lambda rows, schema: rows.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
    return {name: shaped(rows, LOADED[name]) for name, rows in (("meet", meets), ("race", races), ("result", results))}


def load_meets(spark: SparkSession, root: str, new: dict[str, DataFrame]) -> int:
    """Add what is new (``additions``) to the tables under a root; the number of loads. Refused (``versions.Conflict``) if another load came between."""
    base = versions.current(spark, f"{root}/_loads")
    target = {name: read_loaded(spark, root, name, base) for name in LOADED}
    load = f"{base + 1:010d}-{uuid.uuid4().hex[:8]}"
    for name, rows in additions(target, new).items():
        rows.write.parquet(f"{root}/{name}/load={load}")
    loads = versions.read(spark, f"{root}/_loads", LOADS, base).union(spark.createDataFrame([(load,)], StructType(LOADS.fields)))
    return versions.commit(loads, f"{root}/_loads", base)
