"""Standardised fields of scraped swim results, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and codes as the result pages have them.
MONTHS = ("januar", "februar", "marts", "april", "maj", "juni", "juli", "august", "september", "oktober", "november", "december")
BASE_STROKES = {"Fri": "FREE", "Ryg": "BACK", "Bryst": "BREAST", "Fly": "FLY", "IM": "MEDLEY", "HM": "MEDLEY"}
LEGACY_STROKES = {"Frisvømning": "FREE", "Brystsvømning": "BREAST", "Rygsvømning": "BACK", "Butterfly": "FLY", "IM": "MEDLEY", "Ind.": "MEDLEY", "Indv.Medley": "MEDLEY", "Medley": "MEDLEY", "IM Medley": "MEDLEY"}
LEGACY_GENDERS = {"herrer": "M", "damer": "F", "mix": "X"}
LEGACY_INITIALS = {"h": "M", "d": "F"}
GENDERS = {"Herrer": "M", "Damer": "F", "Mix": "X"}


def lookup(values: dict, key: Column) -> Column:
    """The value of a literal table; null for other keys."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), key)


def whole(col: Column) -> Column:
    """A whole number, or null if the text is none."""
    return F.when(F.trim(col).rlike(r"^[+-]?\d+$"), F.trim(col).try_cast("bigint"))


def _part(col: Column, pattern: str, group: int) -> Column:
    """A group of a pattern; null where the pattern or the group has no match."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def time_to_centiseconds(col: Column) -> Column:
    """``M:SS.hh`` or ``SS.hh``, comma or dot, to centiseconds; others are null.

    The last colon parts minutes and seconds, the first dot seconds and fraction; a fraction may be absent or short, and
    counts with two digits.
    """
    text = F.translate(F.trim(col), ",", ".")
    rest = F.substring_index(text, ":", -1)
    minutes = F.when(~text.contains(":"), F.lit(0)).otherwise(whole(F.regexp_extract(text, "^(.*):[^:]*$", 1)))
    fraction = F.substring(F.concat(F.regexp_extract(rest, r"^[^.]*\.(.*)$", 1), F.lit("00")), 1, 2)
    return minutes * 6000 + whole(F.substring_index(rest, ".", 1)) * 100 + whole(fraction)


def legacy_seconds(col: Column) -> Column:
    """The same time in seconds, as a double."""
    return time_to_centiseconds(col) / F.lit(100.0)


def base_seconds(col: Column) -> Column:
    """A base time with spaces anywhere, in seconds rounded to two decimals; others are null."""
    text = F.regexp_replace(col, " ", "")
    minutes, seconds = _part(text, r"^(?:(\d+):)?[^:]+$", 1), F.substring_index(text, ":", -1)
    value = F.when(seconds.rlike(r"^\d*\.?\d*$"), seconds.try_cast("double"))
    return F.when(text.rlike(r"^(?:\d+:)?[^:]+$"), F.round(F.coalesce(whole(minutes), F.lit(0)) * 60 + value, 2))


def danish_date(col: Column) -> Column:
    """``5. april 2025`` to a date: day, month's name in any case and year, parted by white space; dots don't count. Others are null."""
    words = F.filter(F.split(F.translate(col, ".", ""), r"(?U)\s+"), lambda x: x != "")
    day, year = F.get(words, 0), F.get(words, 2)
    month = lookup({m: n for n, m in enumerate(MONTHS, 1)}, F.lower(F.get(words, 1)))
    good = (F.size(words) == 3) & day.rlike(r"^0*\d{1,2}$") & year.rlike(r"^0*[1-9]\d{0,3}$")
    date = F.format_string("%04d-%02d-%02d", F.when(good, year).try_cast("int"), month, F.when(good, day).try_cast("int"))
    return F.when(good & month.isNotNull(), F.try_to_date(date, "yyyy-MM-dd"))


def season_of(date: Column, last_month: int = 7) -> Column:
    """The season of a date: its year up to ``last_month`` (7; 8 in legacy data), else the next."""
    return (F.year(date) + F.when(F.month(date) > last_month, 1).otherwise(0)).cast("bigint")


def course_code(col: Column) -> Column:
    return F.when(col.contains("50m"), "LCM").when(col.contains("25m"), "SCM").otherwise("UNK")


def legacy_course_code(col: Column) -> Column:
    return F.when(col == "50m", "LCM").when(col == "25m", "SCM").otherwise("?")


def race_type(col: Column) -> Column:
    """The type behind a Danish heading; the order of the tests matters."""
    low = F.lower(col)
    return F.when(low.contains("direkte"), "Timed final").when(low.contains("finale"), "Final").when(low.startswith("swim-off"), "Swim-off").when(low.contains("indledende"), "Heats").otherwise(col)


def parse_event(col: Column) -> Column:
    """``100 Fri - Herrer`` or ``4 x 100 Fri - Damer`` to a struct: distance (of a leg), stroke, gender, relay_count.

    Each part that can't be read is null by itself (relay_count 1); a name without exactly one `` - `` is null throughout.
    """
    sides = F.split(col, " - ")
    event, good = F.get(sides, 0), F.size(sides) == 2
    words = F.filter(F.split(event, r"\s+"), lambda x: x != "")
    relay = (F.size(words) >= 4) & (F.lower(F.get(words, 1)) == "x")
    metres = whole(F.replace(F.when(relay, F.get(words, 2)).otherwise(F.substring_index(event, " ", 1)), F.lit("."), F.lit("")))
    stroke = F.when(relay, F.array_join(F.slice(words, 4, F.greatest(F.size(words), F.lit(1))), " ")).otherwise(F.regexp_extract(event, "^[^ ]* (.*)$", 1))
    known = good & (relay | event.contains(" "))
    return F.struct(
        F.when(known, metres).alias("distance"),
        F.when(known, stroke).alias("stroke"),
        F.when(good, lookup(GENDERS, F.get(sides, 1))).alias("gender"),
        F.coalesce(F.when(good & relay, whole(F.get(words, 0))), F.lit(1)).alias("relay_count"),
    )


def race_id_from_url(col: Column) -> Column:
    return whole(F.try_parse_url(col, F.lit("QUERY"), F.lit("id")))


def clean_rank(col: Column) -> Column:
    """A place; ``DSQ`` in any case is -1, other text null."""
    return F.when(F.upper(F.trim(col)) == "DSQ", F.lit(-1).cast("bigint")).otherwise(whole(col))


def legacy_rank(col: Column) -> Column:
    return F.when(F.trim(col) == "-", F.lit(-1).cast("bigint")).otherwise(whole(F.regexp_replace(F.trim(col), "^=", "")))


def swimmer_id_from_href(col: Column, is_relay: Column | None = None) -> Column:
    """What follows the last ``?`` of a swimmer's link. A relay's link leads to its split times: no swimmer."""
    found = F.when(col.contains("?"), F.substring_index(col, "?", -1))
    return found if is_relay is None else F.when(~F.coalesce(is_relay, F.lit(False)), found)


def nationality_from_flag(col: Column) -> Column:
    """The file stem of the flag's image, in capitals; ``UNK`` without one."""
    return F.coalesce(F.upper(_part(col, r"([^/]+)\.[^./]+$", 1)), F.lit("UNK"))


def int_or_null(col: Column) -> Column:
    """A whole number whose thousands may be parted by dots: distances of laps."""
    return whole(F.regexp_replace(col, r"\.", ""))


def split_categories(col: Column) -> Column:
    return F.filter(F.transform(F.split(col, r"[,\s]+"), F.trim), lambda x: x != "")


def stroke_to_base(col: Column) -> Column:
    return lookup(BASE_STROKES, col)


def legacy_stroke(col: Column) -> Column:
    """The code of a stroke's name; another name in capitals."""
    return F.coalesce(lookup(LEGACY_STROKES, col), F.upper(col))


def legacy_gender(col: Column) -> Column:
    """The code of the first of the words that a text has anywhere, in any case; else by its first letter; else ``?``."""
    low = F.lower(col)
    code = lookup(LEGACY_INITIALS, F.substring(low, 1, 1))
    for word, value in reversed(LEGACY_GENDERS.items()):
        code = F.when(low.contains(word), value).otherwise(code)
    return F.coalesce(code, F.lit("?"))


def legacy_relay(col: Column) -> Column:
    """``4X50`` to a struct of relay_count and distance; a plain distance is no relay."""
    pattern = r"^(?:(\d+)[xX])?(\d+)$"
    return F.struct(F.coalesce(whole(_part(col, pattern, 1)), F.lit(1)).alias("relay_count"), whole(_part(col, pattern, 2)).alias("distance"))


def legacy_points(col: Column) -> Column:
    return F.coalesce(whole(col), F.lit(0))


def wa_points(base: Column, centiseconds: Column) -> Column:
    """``trunc(1000 (base / time)^3)`` in doubles; null without a base or with a time of zero."""
    ratio = F.try_divide(base, centiseconds.cast("double") / F.lit(100.0))
    return (F.lit(1000.0) * F.pow(ratio, F.lit(3.0))).cast("bigint")


def standardize_races(cells) -> object:
    """Races from scraped strings: url, number, name and heading."""
    event = parse_event(F.col("name"))
    return cells.select(race_id_from_url(F.col("url")).alias("race_id"), whole(F.col("number")).alias("number"), "name", event.alias("e"), race_type(F.col("heading")).alias("type")).select("race_id", "number", "name", "e.*", "type")


def standardize_results(cells) -> object:
    """Results from scraped strings: rank, href, flag, birth_year and time; with ``is_relay`` relays have no swimmer."""
    c = F.col
    relay = c("is_relay") if "is_relay" in cells.columns else None
    return cells.select("*", clean_rank(c("rank_text")).alias("rank"), swimmer_id_from_href(c("href"), relay).alias("swimmer_id"), nationality_from_flag(c("flag")).alias("nationality"), whole(c("birth_text")).alias("birth_year"), time_to_centiseconds(c("time_text")).alias("completed_centiseconds")).drop("rank_text", "href", "flag", "birth_text")


def standardize_splits(cells) -> object:
    """Laps from scraped strings: distance, split and cumulative time; rows without a distance are no laps."""
    c = F.col
    return cells.where(F.length(F.trim("distance_text")) > 0).select("*", int_or_null(c("distance_text")).alias("distance"), time_to_centiseconds(c("split_time")).alias("split_centiseconds"), time_to_centiseconds(c("cumulative_time")).alias("cumulative_centiseconds")).drop("distance_text")
