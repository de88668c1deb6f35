"""The analytics views by name, for use from SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from natatio.operators import views
from natatio.schemas import EVENT

#: View name to a function of the base tables.
VIEWS = {
    "results": lambda t: views.results(t["obt_result"]),
    "individual_results": lambda t: views.individual_results(t["obt_result"]),
    "personal_best": lambda t: views.personal_best(t["obt_result"]),
    "season_best": lambda t: views.season_best(t["obt_result"]),
    "event_leaderboard": lambda t: views.event_leaderboard(t["obt_result"]),
    "swimmer_progression": lambda t: views.swimmer_progression(t["obt_result"]),
    "cross_era_best": lambda t: views.cross_era_best(t["obt_result"]),
    "biggest_improvers": lambda t: views.biggest_improvers(t["obt_result"]),
    "club_leaderboard": lambda t: views.club_leaderboard(t["obt_result"]),
    "age_group_ranking": lambda t: views.age_group_ranking(t["obt_result"]),
    "meet_summary": lambda t: views.meet_summary(t["obt_result"]),
    "pacing": lambda t: views.pacing(t["fact_split"].select("result_id", "split_centiseconds", "cumulative_centiseconds"), t["obt_result"]),
    "results_by_category": lambda t: views.results_by_category(t["obt_result"], t["dim_meet"]),
    "event_standard_by_season": lambda t: views.event_standard_by_season(t["obt_result"], t["dim_meet"]),
    "prelim_ranked": lambda t: views.prelim_ranked(t["obt_result"], t["dim_meet"]),
    "final_cutline_by_season": lambda t: views.final_cutline_by_season(t["obt_result"], t["dim_meet"]),
}


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """All views over these base tables (``obt_result``, ``dim_meet``, ``fact_split``) as temporary views, and
    ``cutline_at(n)`` as a table function; nothing is computed yet."""
    for name, view in VIEWS.items():
        view(tables).createOrReplaceTempView(name)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION cutline_at(place BIGINT)
        RETURNS TABLE(category STRING, season BIGINT, course STRING, gender STRING, distance BIGINT, stroke STRING, cutline_centiseconds BIGINT, cutline_time STRING, swimmer_id STRING, name STRING)
        RETURN SELECT category, season, {', '.join(EVENT)}, completed_centiseconds, completed_time, swimmer_id, name FROM prelim_ranked WHERE heat_rank = cutline_at.place""")


def query(spark: SparkSession, text: str) -> DataFrame:
    """One SQL text over the registered views."""
    return spark.sql(text)
