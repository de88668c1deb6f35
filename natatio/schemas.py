"""Declared schemas of the raw, curated and reference tables; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DataType, DateType, LongType, StringType, StructField, StructType

SPLIT = "struct<distance bigint, split_time string, split_centiseconds bigint, cumulative_time string, cumulative_centiseconds bigint>"

_TYPES: dict[str, DataType] = {"bigint": LongType(), "string": StringType(), "date": DateType(), "boolean": BooleanType(), "array<string>": ArrayType(StringType())}


def columns(text: str) -> StructType:
    """A schema from names and types, without a session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(", "))])


#: Raw and reference tables, as DDL.
RAW = {
    "meet_info": "meet_id bigint, meet string, venue string, course string, season bigint, date string, category array<string>",
    "races": "meet_id bigint, race_id bigint, number bigint, name string, distance bigint, stroke string, gender string, relay_count bigint, type string, class string",
    "results": f"race_id bigint, Rank bigint, Name string, Swimmer_id string, nationality string, club string, birth_year bigint, completed_time string, completed_centiseconds bigint, splits array<{SPLIT}>",
}
BASE_TIMES = "season bigint, course string, gender string, relay_count bigint, distance bigint, stroke string, basetime string, basetime_in_sec double, source string"
OVERRIDES = "meet_id string, race_id bigint, class string, reason string"
CURATED = {
    "dim_meet": columns("meet_id string, meet_name string, venue string, meet_date date, category array<string>, season bigint, course string"),
    "dim_race": columns("race_id bigint, meet_id string, number bigint, race_name string, distance bigint, stroke string, gender string, relay_count bigint, type string, class string, season bigint, course string"),
    "fact_result": columns("result_id string, race_id bigint, meet_id string, rank bigint, name string, swimmer_id string, nationality string, club string, birth_year bigint, completed_time string, completed_centiseconds bigint, points bigint, points_fixed bigint, season bigint, course string"),
    "fact_split": columns("result_id string, race_id bigint, meet_id string, distance bigint, split_time string, split_centiseconds bigint, cumulative_time string, cumulative_centiseconds bigint, season bigint, course string"),
    "obt_result": columns("result_id string, race_id bigint, meet_id string, rank bigint, name string, swimmer_id string, nationality string, club string, birth_year bigint, completed_time string, completed_centiseconds bigint, points bigint, points_fixed bigint, season bigint, course string, meet_name string, venue string, meet_date date, number bigint, race_name string, distance bigint, stroke string, gender string, relay_count bigint, type string, class string"),
}
#: Lines that were set aside, with their number in the file (from 1), and meets without a scrape that can be taken (no file or line).
QUARANTINE = columns("meet_id string, scrape string, file string, line_no bigint, line string, reason string")
#: Where each meet's rows of each table are; see ``lake``.
MANIFEST = columns("tab string, meet_id string, snap string, scrape string, live boolean")
EVENT = ("course", "gender", "distance", "stroke")
