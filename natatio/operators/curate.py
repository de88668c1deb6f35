"""Raw tables to the five curated ones, for all meets at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natatio.functions.fields import base_seconds, stroke_to_base, wa_points

FIXED_SEASON = 2026
EVENT_KEYS = ("course", "gender", "relay_count", "distance", "stroke")
BASE_KEY = ("season", "course", "gender", "relay_count", "distance", "base_stroke")
#: Rows up to which a reference table is broadcast; a larger one is joined by a shuffle.
SMALL = 100_000


def last_wins(rows: DataFrame, keys: list[str], *position: str) -> DataFrame:
    """One row for each key: the last by position."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*map(F.desc, position)))).where("_n = 1").drop("_n")


def small(frame: DataFrame) -> DataFrame:
    """The frame marked for broadcast, if it has few rows."""
    return F.broadcast(frame) if frame.limit(SMALL + 1).count() <= SMALL else frame


def classify_races(races: DataFrame, overrides: DataFrame) -> DataFrame:
    """Races with ``class``: an override, else para if a timed final's name also occurs as heats or final in its meet."""
    elsewhere = F.max(F.when(F.col("type").isin("Heats", "Final"), 1)).over(Window.partitionBy("meet_id", "race_name"))
    guess = F.when((F.col("type") == "Timed final") & elsewhere.isNotNull(), "para").otherwise("open")
    told = overrides.select("meet_id", "race_id", F.col("class").alias("told"))
    return races.withColumn("guess", guess).join(told, ["meet_id", "race_id"], "left").withColumn("class", F.coalesce("told", "guess")).drop("told", "guess")


def assign_result_ids(results: DataFrame) -> DataFrame:
    """``result_id``: race and place in the raw file within the race, from 0."""
    place = F.row_number().over(Window.partitionBy("meet_id", "race_id").orderBy("pos")) - 1
    return results.withColumn("result_id", F.concat_ws("-", F.col("race_id").cast("string"), place.cast("string")))


def build_dim_meet(meets: DataFrame) -> DataFrame:
    return meets.select(F.col("meet_id").cast("string").alias("meet_id"), "meet_name", "venue", "meet_date", "category", "season", "course")


def build_dim_race(races: DataFrame, overrides: DataFrame, dim_meet: DataFrame) -> DataFrame:
    own = classify_races(races, overrides).drop("season", "course")
    return own.join(dim_meet.select("meet_id", "season", "course"), "meet_id", "left").select("race_id", "meet_id", "number", "race_name", "distance", "stroke", "gender", "relay_count", "type", "class", "season", "course")


def lookup_base_time(rows: DataFrame, base_times: DataFrame, name: str, season: int | None = None) -> DataFrame:
    """The rows with the base time of their event, of their own season or of a fixed one; null if there is none."""
    table = base_times.withColumnRenamed("stroke", "base_stroke").select(*BASE_KEY, F.col("basetime_in_sec").alias(name))
    if season is not None:
        table = table.where(F.col("season") == season).drop("season")
    return rows.join(table, [k for k in BASE_KEY if k in table.columns], "left")


def scored(time: Column, rank: Column, race_class: Column) -> Column:
    """Whether a swim gets points; a null rank does."""
    return time.isNotNull() & (F.coalesce(rank, F.lit(0)) != -1) & (F.coalesce(race_class, F.lit("open")) != "para")


def score_results(rows: DataFrame, base_times: DataFrame, fixed_season: int = FIXED_SEASON) -> DataFrame:
    """``points`` by the season's base time and ``points_fixed`` by the fixed season's; rows have race columns and class."""
    rows = rows.withColumn("base_stroke", stroke_to_base(F.col("stroke")))
    rows = lookup_base_time(lookup_base_time(rows, base_times, "base"), base_times, "base_fixed", fixed_season)
    cs, ok = F.col("completed_centiseconds"), scored(F.col("completed_centiseconds"), F.col("rank"), F.col("class"))
    return rows.withColumns({"points": F.when(ok, wa_points(F.col("base"), cs)), "points_fixed": F.when(ok, wa_points(F.col("base_fixed"), cs))}).drop("base", "base_fixed", "base_stroke")


RACE_COLUMNS = ("number", "race_name", "distance", "stroke", "gender", "relay_count", "type", "class")
FACT_COLUMNS = ("result_id", "race_id", "meet_id", "rank", "name", "swimmer_id", "nationality", "club", "birth_year", "completed_time", "completed_centiseconds", "points", "points_fixed", "season", "course")


def _with_race(results: DataFrame, dim_race: DataFrame, dim_meet: DataFrame) -> DataFrame:
    joined = results.join(dim_race.select("meet_id", "race_id", *RACE_COLUMNS), ["meet_id", "race_id"], "left")
    return joined.join(dim_meet.select("meet_id", "season", "course", "meet_name", "venue", "meet_date"), "meet_id", "left")


def build_obt(results: DataFrame, dim_race: DataFrame, dim_meet: DataFrame, base_times: DataFrame, fixed_season: int = FIXED_SEASON) -> DataFrame:
    """The one wide result table; a result of an unknown race keeps its row, open and without points."""
    rows = score_results(_with_race(assign_result_ids(results), dim_race, dim_meet), base_times, fixed_season)
    rows = rows.withColumn("class", F.coalesce("class", F.lit("open")))
    return rows.select(*FACT_COLUMNS, "meet_name", "venue", "meet_date", *RACE_COLUMNS)


def build_fact_result(obt: DataFrame) -> DataFrame:
    return obt.select(*FACT_COLUMNS)


def build_fact_split(results: DataFrame, dim_meet: DataFrame) -> DataFrame:
    """A row for each lap of each result."""
    laps = assign_result_ids(results).select("result_id", "race_id", "meet_id", F.explode("splits").alias("lap"))
    return laps.join(dim_meet.select("meet_id", "season", "course"), "meet_id", "left").select("result_id", "race_id", "meet_id", "lap.*", "season", "course")


def curate(meets: DataFrame, races: DataFrame, results: DataFrame, base_times: DataFrame, overrides: DataFrame, fixed_season: int = FIXED_SEASON) -> dict[str, DataFrame]:
    """The five curated tables. Repeated races and base times count once, the last by ``pos``."""
    if "pos" in races.columns:
        races = last_wins(races, ["meet_id", "race_id"], "pos").drop("pos")
    base = base_times.groupBy("season", "course", "gender", "relay_count", "distance", "stroke").agg(F.max_by("basetime_in_sec", "pos").alias("basetime_in_sec")) if "pos" in base_times.columns else base_times
    base, dim_meet = small(base), build_dim_meet(meets)
    dim_race = build_dim_race(races, small(overrides), dim_meet)
    obt = build_obt(results, dim_race, dim_meet, base, fixed_season)
    return {"dim_meet": dim_meet, "dim_race": dim_race, "fact_result": build_fact_result(obt), "fact_split": build_fact_split(results, dim_meet), "obt_result": obt}


def enrich_points(rows: DataFrame, base_times: DataFrame, fixed_season: int = FIXED_SEASON) -> DataFrame:
    """The rows with ``points`` and ``points_fixed``, new or in place of what they have, without regard to class; all other columns stay."""
    columns = [c for c in rows.columns if c not in ("points", "points_fixed")]
    told = rows.drop("points", "points_fixed").withColumn("_class", F.col("class") if "class" in columns else F.lit(None)).withColumn("class", F.lit("open"))
    every = score_results(told, base_times, fixed_season)
    return every.select(*(F.col("_class" if c == "class" else f"`{c}`").alias(c) for c in columns), "points", "points_fixed")


def points_coverage(rows: DataFrame, base_times: DataFrame, fixed_season: int = FIXED_SEASON) -> DataFrame:
    """Per meet the share of results that have points, without regard to class."""
    every = enrich_points(rows, base_times, fixed_season)
    return every.groupBy("meet_id").agg(F.count("*").alias("results"), F.count("points").alias("scored"), (F.count("points") / F.count("*")).alias("coverage"))


BASE_EVENT = ("season", "course", "gender", "relay_count", "distance", "stroke")


def legacy_base_times(legacy: DataFrame) -> DataFrame:
    """Legacy rows with the seconds of their text and their source; of repeated keys the first by ``pos``."""
    first = legacy.groupBy(*BASE_EVENT).agg(F.min_by("basetime", "pos").alias("basetime"))
    return first.withColumns({"basetime_in_sec": base_seconds(F.col("basetime")), "source": F.lit("legacy-csv")})


def build_base_times(official: DataFrame, legacy: DataFrame) -> DataFrame:
    """Official rows, and legacy rows (``pos``, ``basetime``) of events that have no official one."""
    rest = legacy_base_times(legacy).join(official.select(*BASE_EVENT), list(BASE_EVENT), "left_anti")
    columns = [*BASE_EVENT, "basetime", "basetime_in_sec", "source"]
    return official.withColumn("source", F.lit("wa-doc")).select(*columns).unionByName(rest.select(*columns))


def base_time_mismatch(rows: DataFrame, seconds_of_text: Column) -> DataFrame:
    """Rows whose seconds aren't those of their text."""
    return rows.where(~F.col("basetime_in_sec").eqNullSafe(seconds_of_text))


def check_base_times(official: DataFrame, seconds_of_text: Column) -> None:
    """Refuse official base times that contradict themselves."""
    wrong = base_time_mismatch(official, seconds_of_text).take(5)
    if wrong:
        raise ValueError(f"base times differ from their text: {wrong}")


def base_time_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.min("season").alias("first_season"), F.max("season").alias("last_season"), F.countDistinct("season").alias("seasons"))


def legacy_points(rows: DataFrame, base_times: DataFrame, youth_season: int, fixed_season: int) -> DataFrame:
    """Legacy scoring: youth base times (``Y``) for single short-course swims at youth championships (a category with DMY),
    else the senior ones (``S``); ``base_times`` has ``age_group``.

    ``points`` has the base time of the meet's season (youth: of ``youth_season``), ``points_fixed`` that of ``fixed_season``, both of the
    swim's own age group. Without a base time or with a rank of -1, points are 0.
    """
    youth = (F.col("course") == "SCM") & F.exists("category", lambda x: x.contains("DMY")) & (F.col("relay_count") == 1)
    rows = rows.withColumn("age_group", F.when(youth, "Y").otherwise("S"))
    rows = rows.withColumns({"own_season": F.when(F.col("age_group") == "Y", F.lit(youth_season)).otherwise(F.col("season")), "base_stroke": stroke_to_base(F.col("stroke"))})
    table = base_times.withColumnRenamed("stroke", "base_stroke")
    keys = ["age_group", "course", "gender", "relay_count", "distance", "base_stroke"]
    own = table.select(F.col("season").alias("own_season"), *keys, F.col("basetime_in_sec").alias("own"))
    fixed = table.where(F.col("season") == fixed_season).select(*keys, F.col("basetime_in_sec").alias("fixed"))
    rows = rows.join(own, ["own_season", *keys], "left").join(fixed, keys, "left")
    swum = F.when(F.coalesce("rank", F.lit(0)) != -1, F.col("completed_centiseconds"))
    points = lambda base: F.coalesce(wa_points(F.col(base), swum), F.lit(0))
    return rows.withColumns({"points": points("own"), "points_fixed": points("fixed")}).drop("own", "fixed", "own_season", "base_stroke")
