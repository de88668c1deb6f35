"""Age groups, corrections and reports of the legacy result base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natatio.operators.curate import last_wins


def age_group(gender: Column, age: Column) -> Column:
    """Men: 13-15 Y1-Y3, 16-18 J1-J3, 19-21 S1-S3, older S; women one year younger; others ``-``."""
    level = age + F.when(gender == "F", 1).when(gender == "M", 0)
    group = F.when(level.between(13, 15), F.concat(F.lit("Y"), (level - 12).cast("string"))).when(level.between(16, 18), F.concat(F.lit("J"), (level - 15).cast("string")))
    return F.coalesce(group.when(level.between(19, 21), F.concat(F.lit("S"), (level - 18).cast("string"))).when(level > 21, "S"), F.lit("-"))


def assign_age_group(rows: DataFrame) -> DataFrame:
    return rows.withColumn("age_group", age_group(F.col("gender"), F.col("season") - F.col("birth_year")))


def age_group_rank(rows: DataFrame) -> DataFrame:
    """``age_rank``: by points within meet, race number and age group, each swimmer's best row only; other rows have 0.

    Rows of relays, without a place or without an age group (``-``) aren't ranked.
    """
    counts = F.coalesce((F.col("relay_count") == 1) & (F.col("rank") >= 1) & (F.col("age_group") != "-"), F.lit(False))
    group, order = ["meet_id", "number", "age_group"], [F.desc_nulls_last("points"), F.col("result_id")]
    rows = assign_age_group(rows)
    # Only rows that count are shuffled, and once: by the group, in which both windows are sorted.
    own = F.row_number().over(Window.partitionBy(*group, "name").orderBy(*order)) == 1
    ranked = rows.where(counts).repartition(*group).withColumn("_own", own)
    place = F.row_number().over(Window.partitionBy(*group, "_own").orderBy(*order)).cast("bigint")
    ranked = ranked.withColumn("age_rank", F.when(F.col("_own"), place).otherwise(F.lit(0))).drop("_own")
    return ranked.unionByName(rows.where(~counts).withColumn("age_rank", F.lit(0).cast("bigint")))


def append_category(meets: DataFrame, additions: DataFrame) -> DataFrame:
    """Meets with the categories of ``additions(meet_id, added)`` appended, each once."""
    found = meets.join(additions.groupBy("meet_id").agg(F.sort_array(F.collect_set("added")).alias("added")), "meet_id", "left")
    none = F.array().cast("array<string>")
    return found.withColumn("category", F.when(F.col("added").isNull(), F.col("category")).otherwise(F.array_union(F.coalesce("category", none), "added"))).drop("added")


def apply_corrections(rows: DataFrame, corrections: DataFrame, key: str, column: str) -> DataFrame:
    """``corrections(key, old, new)`` applied where the column still has the old value."""
    found = rows.join(corrections.select(key, "old", "new"), key, "left")
    return found.withColumn(column, F.when(F.col(column) == F.col("old"), F.col("new")).otherwise(F.col(column))).drop("old", "new")


def finals_report(rows: DataFrame, meets: DataFrame, category: str, course: str) -> DataFrame:
    """Single swims in finals of a category's meets, sorted by event, points and place."""
    chosen = meets.where(F.array_contains("category", category) & (F.col("course") == course)).select("meet_id")
    found = rows.join(chosen, "meet_id", "left_semi").where("type like 'Final%' and relay_count = 1 and rank >= 1")
    return found.select("meet_id", "season", "gender", "stroke", "distance", "rank", "name", "points", "result_id").orderBy(F.desc("season"), "gender", "stroke", "distance", F.desc("points"), "rank", "result_id")


def event_catalogue(rows: DataFrame, meets: DataFrame, category: str) -> DataFrame:
    chosen = meets.where(F.array_contains("category", category)).select("meet_id")
    return rows.join(chosen, "meet_id", "left_semi").select("gender", "stroke", "distance").distinct()


def participants_per_group(rows: DataFrame) -> DataFrame:
    return assign_age_group(rows).where("swimmer_id is not null").select("season", "age_group", "swimmer_id").distinct().groupBy("season", "age_group").agg(F.count("*").alias("participants"))


def unscored_audit(rows: DataFrame) -> DataFrame:
    """Races with placed results that have no points."""
    return rows.where("coalesce(points, 0) = 0 and rank >= 1").groupBy("meet_id", "race_id").agg(F.count("*").alias("unscored"))


def birth_cohort(rows: DataFrame, oldest: bool = False) -> DataFrame:
    """Swims of those born last (or first), for each season and gender."""
    end = F.min("birth_year") if oldest else F.max("birth_year")
    born = rows.where("birth_year is not null").groupBy("season", "gender").agg(end.alias("birth_year"))
    return rows.join(born, ["season", "gender", "birth_year"], "left_semi").select("season", "gender", "birth_year", "result_id", "swimmer_id", "points")


def youngest_cohort(rows: DataFrame) -> DataFrame:
    """Swims of those born last, for each season and gender."""
    return birth_cohort(rows)


def oldest_cohort(rows: DataFrame) -> DataFrame:
    """Swims of those born first, for each season and gender."""
    return birth_cohort(rows, oldest=True)


def gender_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("gender").agg(F.count("*").alias("n"), F.max("points").alias("best_points"), F.countDistinct("swimmer_id").alias("swimmers"))


def results_in_races(rows: DataFrame, races: DataFrame) -> DataFrame:
    return rows.join(races.select("race_id"), "race_id", "left_semi").agg(F.count("*").alias("n"))


def keep_last(rows: DataFrame) -> DataFrame:
    """Of rows with one swimmer, birth year and club in a race, the last."""
    return last_wins(rows, ["race_id", "name", "birth_year", "club"], "ord")


def group_ranking(rows: DataFrame, group: str) -> DataFrame:
    """The ranking of one age group, race by race."""
    return age_group_rank(rows).where((F.col("age_group") == group) & (F.col("age_rank") > 0)).select("meet_id", "number", "age_rank", "name", "club", "points", "result_id").orderBy("meet_id", "number", "age_rank")
