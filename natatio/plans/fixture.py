"""Swim-shaped tables derived from the given star schema; one SQL text for Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from natatio.sources.lake import exists, scratch_path
from natatio.sources.versions import tidy

FX_SWIMS = """
WITH base AS (
  SELECT l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag,
         o_orderkey, o_orderstatus, o_orderpriority,
         year(o_orderdate) AS yr, month(o_orderdate) AS mo,
         50 * (1 + CAST(o_orderkey % 16 AS BIGINT)) AS distance,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS ord
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT concat(CAST(o_orderkey AS STRING), '-', CAST(ord AS STRING)) AS result_id,
  o_orderkey AS race_id,
  CAST(ord AS BIGINT) AS ord,
  CAST(yr * 100 + mo AS STRING) AS meet_id,
  CAST(mo AS BIGINT) AS mo,
  CAST(yr + CASE WHEN mo >= 8 THEN 1 ELSE 0 END AS BIGINT) AS season,
  CASE WHEN mo BETWEEN 4 AND 8 THEN 'LCM' ELSE 'SCM' END AS course,
  CAST(concat(CAST(yr AS STRING), '-', lpad(CAST(mo AS STRING), 2, '0'), '-01') AS DATE) AS meet_date,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(l_partkey % 150 AS STRING) END AS swimmer_id,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE concat('swimmer ', CAST(l_partkey % 150 AS STRING)) END AS name,
  CAST(CASE WHEN o_orderkey % 29 = 0 THEN 4 ELSE 1 END AS BIGINT) AS relay_count,
  CASE WHEN l_suppkey % 25 = 7 THEN NULL ELSE concat('club', CAST(l_suppkey % 25 AS STRING)) END AS club,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(1975 + l_partkey % 17 AS BIGINT) END AS birth_year,
  distance,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Fri' WHEN '2' THEN 'Ryg' WHEN '3' THEN 'Bryst'
       WHEN '4' THEN 'Fly' ELSE 'IM' END AS stroke,
  CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE o_orderstatus WHEN 'P' THEN 'Heats' WHEN 'F' THEN 'Final' ELSE 'Timed final' END AS type,
  CASE WHEN l_discount = 0.1 AND l_returnflag = 'R' THEN NULL
       ELSE distance * (50 + CAST(l_quantity AS BIGINT)) + l_partkey % 97 END AS completed_centiseconds,
  CASE WHEN l_discount = 0.0 AND l_returnflag = 'A' THEN -1
       WHEN l_discount = 0.0 AND l_returnflag = 'N' THEN NULL ELSE CAST(ord + 1 AS BIGINT) END AS rank
FROM base
"""

FX_MEET = """
SELECT DISTINCT meet_id, season, course, meet_date, concat('meet ', meet_id) AS meet_name,
  CASE mo % 4 WHEN 0 THEN split('DM-L,DMJ-L', ',') WHEN 1 THEN split('DO', ',')
              WHEN 2 THEN split('DM-K', ',') ELSE NULL END AS category
FROM fx_swims
"""

FX_BASE_TIMES = """
SELECT season, course, gender, relay_count, distance,
  CASE stroke WHEN 'Fri' THEN 'FREE' WHEN 'Ryg' THEN 'BACK' WHEN 'Bryst' THEN 'BREAST'
              WHEN 'Fly' THEN 'FLY' ELSE 'MEDLEY' END AS stroke,
  CAST(min(completed_centiseconds) AS DOUBLE) / CAST(100 AS DOUBLE) AS basetime_in_sec
FROM fx_swims
WHERE completed_centiseconds IS NOT NULL AND NOT (course = 'SCM' AND season % 4 = 1)
GROUP BY 1, 2, 3, 4, 5, 6
"""

FX_OVERRIDES = """
SELECT DISTINCT meet_id, race_id, CASE WHEN race_id % 2 = 0 THEN 'para' ELSE 'open' END AS class
FROM fx_swims WHERE race_id % 53 = 0
"""

FX_SPLITS = """
WITH laps AS (
  SELECT result_id, race_id, season, course, distance, ord, {laps} AS lap, 1 + race_id % 4 AS n, completed_centiseconds AS cs
  FROM fx_swims WHERE completed_centiseconds IS NOT NULL
), timed AS (
  SELECT result_id, race_id, season, course, lap, CAST(floor(distance * lap / n) AS BIGINT) AS distance,
         CAST(floor(cs / n) AS BIGINT) + (ord * 7 + lap * 13) % 40 AS lap_cs
  FROM laps
)
SELECT result_id, race_id, season, course, distance,
  CASE WHEN (race_id + lap) % 31 = 0 THEN NULL ELSE lap_cs END AS split_centiseconds,
  CAST(sum(lap_cs) OVER (PARTITION BY result_id ORDER BY lap) AS BIGINT) AS cumulative_centiseconds
FROM timed
"""

#: A number for each lap of a swim, in DuckDB's words.
DUCK_LAPS = "unnest(generate_series(1, 1 + race_id % 4))"
#: What ``FX_SPLITS`` says of one swim, as an array on its own row: no lap is shuffled or stored. Null without a time.
LAPS = """
CASE WHEN completed_centiseconds IS NOT NULL THEN transform(sequence(1L, 1L + race_id % 4), lap -> named_struct(
  'distance', CAST(floor(distance * lap / (1 + race_id % 4)) AS BIGINT),
  'split_centiseconds', CASE WHEN (race_id + lap) % 31 = 0 THEN NULL ELSE CAST(floor(completed_centiseconds / (1 + race_id % 4)) AS BIGINT) + (ord * 7 + lap * 13) % 40 END,
  'cumulative_centiseconds', aggregate(sequence(1L, lap), 0L, (sum, k) -> sum + CAST(floor(completed_centiseconds / (1 + race_id % 4)) AS BIGINT) + (ord * 7 + k * 13) % 40))) END
"""
#: In the order in which they build on each other.
TABLES = {"fx_swims": FX_SWIMS, "fx_meet": FX_MEET, "fx_base_times": FX_BASE_TIMES, "fx_overrides": FX_OVERRIDES, "fx_splits": FX_SPLITS}
#: Where this session has stored the derived tables, by the folder of the given ones.
_STORED: dict[tuple[str, str], str] = {}


def place(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, bool]:
    """This session's folder for tables derived from ``sf_dir``, and whether it has a table (or zone) of that name."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root = _STORED.setdefault(key, scratch_path(spark, "derived"))
    return f"{root}/{name}", exists(spark, f"{root}/{name}/_SUCCESS")


def register(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The derived tables as temporary views and frames; each but the laps, which swims bring along, is written once a session."""
    out = {}
    for name, text in TABLES.items():
        if name == "fx_splits":
            out[name] = out["fx_swims"].selectExpr("result_id", "race_id", "season", "course", f"explode({LAPS}) AS lap").select("result_id", "race_id", "season", "course", "lap.*")
        else:
            path, there = place(spark, sf_dir, name)
            if not there:
                for given in ("lineitem", "orders"):
                    spark.read.parquet(f"{sf_dir}/{given}.parquet").createOrReplaceTempView(given)
                with tidy(spark):
                    spark.sql(text).write.mode("overwrite").option("compression", "zstd").parquet(path)
            out[name] = spark.read.parquet(path)
        out[name].createOrReplaceTempView(name)
    return out


def prefix() -> str:
    """The same tables as DuckDB common table expressions."""
    return "WITH " + ", ".join(f"{name} AS ({text.replace('{laps}', DUCK_LAPS)})" for name, text in TABLES.items())
