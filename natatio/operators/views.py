"""The analytics views: lazy functions from frames to frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natatio.schemas import EVENT

SWIM_ORDER = ("completed_centiseconds", "meet_date", "result_id")


def results(obt: DataFrame) -> DataFrame:
    """Every result with age, flags, phase and the event as text."""
    kind = F.col("type")
    return obt.withColumns({
        "age": F.col("season") - F.col("birth_year"),
        "is_relay": F.col("relay_count") > 1,
        "is_dq": F.col("rank") == -1,
        "phase": F.when(kind == "Heats", "heats").when(kind == "Final", "final").otherwise("timed_final"),
        "event": F.concat_ws(" ", "gender", F.concat(F.col("distance").cast("string"), F.lit("m")), "stroke", F.concat(F.lit("("), "course", F.lit(")"))),
    })


def individual_results(obt: DataFrame) -> DataFrame:
    """Ranked swims of single swimmers; a null rank or relay count excludes a row."""
    return results(obt).where(~F.col("is_relay") & ~F.col("is_dq") & F.col("swimmer_id").isNotNull())


def _timed(obt: DataFrame) -> DataFrame:
    return individual_results(obt).where("completed_centiseconds is not null")


def _at_best(col: str) -> Column:
    """The value at the fastest swim that has one."""
    return F.min_by(col, F.when(F.col(col).isNotNull(), F.struct(*SWIM_ORDER))).alias(col)


def _bests(obt: DataFrame, keys: tuple[str, ...], more: tuple[str, ...]) -> DataFrame:
    best = F.min("completed_centiseconds").alias("best_centiseconds")
    return _timed(obt).groupBy("swimmer_id", *keys).agg(F.min("name").alias("name"), best, *map(_at_best, ("completed_time", "points", *more))).withColumnRenamed("completed_time", "best_time")


def personal_best(obt: DataFrame) -> DataFrame:
    """The fastest swim of each swimmer and event; every other column is of the fastest swim that has it."""
    return _bests(obt, EVENT, ("meet_name", "meet_date", "season"))


def season_best(obt: DataFrame) -> DataFrame:
    return _bests(obt, ("season", *EVENT), ("meet_name", "meet_date"))


def _ranked(obt: DataFrame, keys: tuple[str, ...], by: str, name: str, columns: tuple[str, ...]) -> DataFrame:
    """All swims with a value, ranked by it; ties share."""
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(by)))
    return individual_results(obt).where(F.col(by).isNotNull()).withColumn(name, rank.cast("bigint")).select(*keys, *columns, name)


def event_leaderboard(obt: DataFrame) -> DataFrame:
    return _ranked(obt, ("season", *EVENT), "points", "points_rank", ("swimmer_id", "name", "club", "points", "completed_time", "meet_name", "meet_date"))


def cross_era_best(obt: DataFrame) -> DataFrame:
    return _ranked(obt, EVENT, "points_fixed", "era_rank", ("swimmer_id", "name", "club", "season", "meet_name", "meet_date", "completed_time", "points", "points_fixed"))


def swimmer_progression(obt: DataFrame) -> DataFrame:
    """Each timed swim with its change from the swimmer's previous one in the event, by date."""
    turn = Window.partitionBy("swimmer_id", *EVENT).orderBy("meet_date", "result_id")
    change = lambda c: F.col(c) - F.lag(c).over(turn)
    own = ("result_id", "swimmer_id", "name", *EVENT, "season", "meet_date", "meet_name", "completed_centiseconds", "completed_time", "points")
    return _timed(obt).select(*own, change("completed_centiseconds").alias("delta_centiseconds"), change("points").alias("delta_points"))


def biggest_improvers(obt: DataFrame) -> DataFrame:
    """Season bests against those of the previous season that the swimmer has a time of in the event."""
    bests = _timed(obt).groupBy("swimmer_id", *EVENT, "season").agg(F.min("name").alias("name"), F.min("completed_centiseconds").alias("best_cs"), F.max("points").alias("best_points"))
    turn = Window.partitionBy("swimmer_id", *EVENT).orderBy("season")
    pairs = bests.withColumns({"prev_best_cs": F.lag("best_cs").over(turn), "prev_points": F.lag("best_points").over(turn)}).where("prev_best_cs is not null")
    return pairs.select("swimmer_id", "name", *EVENT, "season", "best_cs", "prev_best_cs", (F.col("prev_best_cs") - F.col("best_cs")).alias("improvement_centiseconds"), (F.col("best_points") - F.col("prev_points")).alias("improvement_points"))


def club_leaderboard(obt: DataFrame) -> DataFrame:
    """Swims, swimmers, places on the podium and points of each club and season; swims without a club are left out."""
    swims = individual_results(obt).where("club is not null")
    return swims.groupBy("club", "season").agg(F.count("*").alias("swims"), F.countDistinct("swimmer_id").alias("swimmers"), F.count_if(F.col("rank").between(1, 3)).alias("podiums"), F.sum("points").alias("total_points"), F.max("points").alias("best_points"))


def age_band(age: Column) -> Column:
    return F.when(age <= 12, "<=12").when(age <= 14, "13-14").when(age <= 16, "15-16").when(age <= 18, "17-18").otherwise("19+")


def age_group_ranking(obt: DataFrame) -> DataFrame:
    swims = _timed(obt).where("age is not null").withColumn("age_group", age_band(F.col("age")))
    rank = F.rank().over(Window.partitionBy("season", *EVENT, "age_group").orderBy("completed_centiseconds"))
    return swims.select("season", *EVENT, "age_group", "swimmer_id", "name", "club", "age", "completed_time", "points", rank.cast("bigint").alias("age_group_rank"))


def meet_summary(obt: DataFrame) -> DataFrame:
    """All results of a meet; the top points only among rows with a swimmer, of equal ones the last result."""
    single = F.col("swimmer_id").isNotNull() & F.col("points").isNotNull()
    least = (F.min(c).alias(c) for c in ("meet_name", "meet_date", "season"))
    top = F.max_by("swimmer_id", F.when(single, F.struct("points", "result_id"))).alias("top_points_swimmer")
    return results(obt).groupBy("meet_id").agg(*least, F.count("*").alias("results"), F.countDistinct("race_id").alias("races"), F.countDistinct("swimmer_id").alias("swimmers"), F.max(F.when(single, F.col("points"))).alias("top_points"), top)


def pacing(splits: DataFrame, obt: DataFrame) -> DataFrame:
    """First against second half of each swim of two laps or more; of an odd number of laps the middle one is in the second half."""
    laps = splits.where("split_centiseconds is not null")
    turn = Window.partitionBy("result_id")
    laps = laps.withColumns({"lap": F.row_number().over(turn.orderBy("cumulative_centiseconds")), "laps": F.count("*").over(turn)}).where("laps >= 2")
    early = F.col("lap") <= F.expr("laps div 2")
    halves = laps.groupBy("result_id").agg(F.sum(F.when(early, F.col("split_centiseconds"))).alias("first_half_cs"), F.sum(F.when(~early, F.col("split_centiseconds"))).alias("second_half_cs"))
    halves = halves.withColumn("back_half_delta_cs", F.col("second_half_cs") - F.col("first_half_cs")).withColumn("negative_split", F.col("back_half_delta_cs") < 0)
    return halves.join(individual_results(obt).select("result_id", "name", *EVENT, "season", "meet_name"), "result_id")


def results_by_category(obt: DataFrame, meets: DataFrame) -> DataFrame:
    """Each swim once for each category of its meet."""
    return individual_results(obt).join(meets.select("meet_id", F.explode("category").alias("category")), "meet_id")


def event_standard_by_season(obt: DataFrame, meets: DataFrame, approximate: bool = False) -> DataFrame:
    """Spread of the times of an event; ``approximate`` bounds the memory of a very large group's quartiles."""
    keys = ("category", "season", *EVENT)
    swims = results_by_category(obt, meets).where("completed_centiseconds is not null").withColumn("time_rank", F.rank().over(Window.partitionBy(*keys).orderBy("completed_centiseconds")))
    quartiles = (F.percentile_approx if approximate else F.percentile)("completed_centiseconds", F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    out = swims.groupBy(*keys).agg(F.count("*").alias("swims"), F.min("completed_centiseconds").alias("best_cs"), quartiles.alias("q"), F.avg(F.when(F.col("time_rank") <= 8, F.col("completed_centiseconds"))).alias("top8_avg_cs"))
    return out.select(*keys, "swims", "best_cs", F.col("q")[0].alias("p25_cs"), F.col("q")[1].alias("median_cs"), F.col("q")[2].alias("p75_cs"), "top8_avg_cs")


def prelim_ranked(obt: DataFrame, meets: DataFrame) -> DataFrame:
    """Heat swims in order of time, ties by result id."""
    keys = ("category", "season", *EVENT)
    heats = results_by_category(obt, meets).where("phase = 'heats' and completed_centiseconds is not null")
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy("completed_centiseconds", "result_id"))
    return heats.select(*keys, "completed_centiseconds", "completed_time", "swimmer_id", "name", turn.cast("bigint").alias("heat_rank"))


def cutline_at(obt: DataFrame, meets: DataFrame, place: int) -> DataFrame:
    """The ``place``-th fastest heat swim."""
    found = prelim_ranked(obt, meets).where(F.col("heat_rank") == place)
    return found.select("category", "season", *EVENT, F.col("completed_centiseconds").alias("cutline_centiseconds"), F.col("completed_time").alias("cutline_time"), "swimmer_id", "name")


def final_cutline_by_season(obt: DataFrame, meets: DataFrame) -> DataFrame:
    return cutline_at(obt, meets, 8)
