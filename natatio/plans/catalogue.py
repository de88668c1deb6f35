"""Registered queries of the swim-results operators and their DuckDB SQL.

Swims are derived from the given tables (``fixture``), then curated by the operators; each oracle says the same in plain
SQL over the same derived tables.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natatio.functions import fields
from natatio.operators import agegroups, audit, curate, views
from natatio.plans import fixture, registry
from natatio.schemas import CURATED
from natatio.sources import lake, load, raw, versions
from natatio.streaming import curate_stream

#: The fixed reference season of the derived data.
FIXED = 2000


def _text_time(c: Column) -> Column:
    """Centiseconds as ``M:SS.hh``."""
    return F.concat(F.expr(f"{c} div 6000"), F.lit(":"), F.lpad(F.expr(f"{c} % 6000 div 100"), 2, "0"), F.lit("."), F.lpad(F.expr(f"{c} % 100"), 2, "0"))


def _results(swims: DataFrame, *more: Column) -> DataFrame:
    """Raw results of derived swims."""
    return swims.select("meet_id", "race_id", F.col("ord").alias("pos"), "rank", "name", "swimmer_id", F.lit("DEN").alias("nationality"), "club", "birth_year", _text_time("completed_centiseconds").alias("completed_time"), "completed_centiseconds", *more)


def _nested_laps() -> Column:
    empty = F.lit(None).cast("string")
    return F.transform(F.expr(fixture.LAPS), lambda x: F.struct(x.distance.alias("distance"), empty.alias("split_time"), x.split_centiseconds.alias("split_centiseconds"), empty.alias("cumulative_time"), x.cumulative_centiseconds.alias("cumulative_centiseconds"))).alias("splits")


class Swims:
    """The derived tables and what is curated from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        fx = fixture.register(spark, sf_dir)
        self.swims, self.meets, self.base, self.overrides, self.splits = (fx[f"fx_{n}"] for n in ("swims", "meet", "base_times", "overrides", "splits"))
        self.raw_meets = self.meets.withColumn("venue", F.concat(F.lit("pool "), F.col("course")))
        one = self.swims.where("ord = 0")
        self.races = one.select("meet_id", "race_id", (F.col("race_id") % 40 + 1).alias("number"), F.concat_ws(" ", F.col("distance").cast("string"), "stroke", "gender").alias("race_name"), "distance", "stroke", "gender", "relay_count", "type")
        self.results = _results(self.swims)

    @property
    def nested(self) -> DataFrame:
        """Raw results with their laps nested, as raw files have them."""
        return _results(self.swims, _nested_laps())

    @property
    def dim_meet(self) -> DataFrame:
        return curate.build_dim_meet(self.raw_meets)

    @property
    def dim_race(self) -> DataFrame:
        return curate.build_dim_race(self.races, self.overrides, self.dim_meet)

    @property
    def obt(self) -> DataFrame:
        return curate.build_obt(self.results, self.dim_race, self.dim_meet, self.base, FIXED)

    def zone(self, table: str, *more: str) -> DataFrame:
        """A table of the curated zone. This session writes each table once from the raw tables, when a query reads it; with ``more``, these too, as one commit."""
        root, _ = fixture.place(self.spark, self.sf_dir, "zone")
        marks = {name: fixture.place(self.spark, self.sf_dir, f"zone-written-{name}") for name in (table, *more)}
        if left := [name for name, (_, there) in marks.items() if not there]:
            tables = curate.curate(self.raw_meets, self.races, self.nested, self.base, self.overrides, FIXED)
            if "obt_result" in left:
                tables["fact_result"] = lambda written: curate.build_fact_result(written("obt_result"))
            lake.write_curated({name: tables[name] for name in left}, root)
            for name in left:
                self.spark.range(0).write.mode("overwrite").parquet(marks[name][0])
        return lake.read_curated(self.spark, root, table)

    @property
    def whole_zone(self) -> dict[str, DataFrame]:
        """All tables of the zone."""
        self.zone(*CURATED)
        return {name: self.zone(name) for name in CURATED}

    @property
    def views(self) -> dict[str, DataFrame]:
        """What the analytics views read."""
        self.zone("obt_result", "dim_meet", "fact_split")
        return {name: self.zone(name) for name in ("obt_result", "dim_meet", "fact_split")}

    @property
    def legacy(self) -> DataFrame:
        """The wide table with the row's place in its race."""
        return self.zone("obt_result").withColumn("ord", F.substring_index("result_id", "-", -1).cast("bigint"))


EVENT = "course, gender, distance, stroke"
#: The derived and curated tables as common table expressions.
BASE_SQL = (
    fixture.prefix()
    + f""", races AS (SELECT meet_id, race_id, race_id % 40 + 1 AS number, concat_ws(' ', distance, stroke, gender) AS race_name,
    distance, stroke, gender, relay_count, type FROM fx_swims WHERE ord = 0),
named AS (SELECT *, bool_or(type IN ('Heats', 'Final')) OVER (PARTITION BY meet_id, race_name) AS elsewhere FROM races),
dim_meet AS (SELECT meet_id, meet_name, 'pool ' || course AS venue, meet_date, category, season, course FROM fx_meet),
classed AS (SELECT n.*, coalesce(o.class, CASE WHEN n.type = 'Timed final' AND n.elsewhere THEN 'para' ELSE 'open' END) AS class
    FROM named n LEFT JOIN fx_overrides o ON n.meet_id = o.meet_id AND n.race_id = o.race_id),
dim_race AS (SELECT race_id, c.meet_id, number, race_name, distance, stroke, gender, relay_count, type, class, season, course
    FROM classed c JOIN dim_meet m ON c.meet_id = m.meet_id),
swum AS (SELECT s.result_id, s.race_id, s.meet_id, s.rank, s.name, s.swimmer_id, 'DEN' AS nationality, s.club, s.birth_year,
    CASE WHEN s.completed_centiseconds IS NOT NULL THEN concat(s.completed_centiseconds // 6000, ':', lpad(CAST(s.completed_centiseconds % 6000 // 100 AS VARCHAR), 2, '0'),
        '.', lpad(CAST(s.completed_centiseconds % 100 AS VARCHAR), 2, '0')) END AS completed_time,
    s.completed_centiseconds, r.season, r.course, m.meet_name, m.venue, m.meet_date, r.number, r.race_name, r.distance, r.stroke, r.gender, r.relay_count, r.type, r.class,
    CASE r.stroke WHEN 'Fri' THEN 'FREE' WHEN 'Ryg' THEN 'BACK' WHEN 'Bryst' THEN 'BREAST' WHEN 'Fly' THEN 'FLY' ELSE 'MEDLEY' END AS base_stroke
    FROM fx_swims s JOIN dim_race r ON s.race_id = r.race_id AND s.meet_id = r.meet_id JOIN dim_meet m ON s.meet_id = m.meet_id),
based AS (SELECT s.*, b.basetime_in_sec AS base, f.basetime_in_sec AS base_fixed FROM swum s
    LEFT JOIN fx_base_times b ON b.season = s.season AND b.course = s.course AND b.gender = s.gender AND b.relay_count = s.relay_count AND b.distance = s.distance AND b.stroke = s.base_stroke
    LEFT JOIN fx_base_times f ON f.season = {FIXED} AND f.course = s.course AND f.gender = s.gender AND f.relay_count = s.relay_count AND f.distance = s.distance AND f.stroke = s.base_stroke),
pts AS (SELECT *, CAST(trunc(1000.0::DOUBLE * pow(base / (completed_centiseconds::DOUBLE / 100.0::DOUBLE), 3.0::DOUBLE)) AS BIGINT) AS any_points,
    CAST(trunc(1000.0::DOUBLE * pow(base_fixed / (completed_centiseconds::DOUBLE / 100.0::DOUBLE), 3.0::DOUBLE)) AS BIGINT) AS any_fixed FROM based),
obt AS (SELECT * EXCLUDE (base, base_fixed, base_stroke, any_points, any_fixed), CASE WHEN class <> 'para' AND coalesce(rank, 0) <> -1 THEN any_points END AS points,
    CASE WHEN class <> 'para' AND coalesce(rank, 0) <> -1 THEN any_fixed END AS points_fixed FROM pts),
res AS (SELECT *, season - birth_year AS age, relay_count > 1 AS is_relay, rank = -1 AS is_dq,
    CASE type WHEN 'Heats' THEN 'heats' WHEN 'Final' THEN 'final' ELSE 'timed_final' END AS phase,
    concat_ws(' ', gender, distance || 'm', stroke, '(' || course || ')') AS event FROM obt),
ind AS (SELECT * FROM res WHERE relay_count <= 1 AND rank <> -1 AND swimmer_id IS NOT NULL),
timed AS (FROM ind WHERE completed_centiseconds IS NOT NULL),
cat AS (SELECT i.*, c.category FROM ind i JOIN (SELECT meet_id, unnest(category) AS category FROM dim_meet) c ON i.meet_id = c.meet_id),
prelim AS (SELECT category, season, {EVENT}, completed_centiseconds, completed_time, swimmer_id, name,
    row_number() OVER (PARTITION BY category, season, {EVENT} ORDER BY completed_centiseconds, result_id) AS heat_rank
    FROM cat WHERE type = 'Heats' AND completed_centiseconds IS NOT NULL),
aged AS (SELECT *, CASE gender WHEN 'F' THEN age + 1 WHEN 'M' THEN age END AS lvl FROM res),
grp AS (SELECT *, CASE WHEN lvl BETWEEN 13 AND 15 THEN 'Y' || (lvl - 12) WHEN lvl BETWEEN 16 AND 18 THEN 'J' || (lvl - 15)
    WHEN lvl BETWEEN 19 AND 21 THEN 'S' || (lvl - 18) WHEN lvl > 21 THEN 'S' ELSE '-' END AS age_group FROM aged)
"""
)
OBT = "result_id, race_id, meet_id, rank, name, swimmer_id, nationality, club, birth_year, completed_time, completed_centiseconds, points, points_fixed, season, course, meet_name, venue, meet_date, number, race_name, distance, stroke, gender, relay_count, type, class"
FACT = ", ".join(curate.FACT_COLUMNS)
RESULTS = OBT + ", age, is_relay, is_dq, phase, event"


def _best_sql(keys: str, columns: str) -> str:
    """Each column from the swims that have it, in order of time."""
    first = lambda c: f"(list({c} ORDER BY completed_centiseconds, meet_date, result_id) FILTER (WHERE {c} IS NOT NULL))[1]"
    named = ", ".join(f"{first(c)} AS {'best_time' if c == 'completed_time' else c}" for c in columns.split())
    return f"SELECT swimmer_id, {keys}, min(name) AS name, min(completed_centiseconds) AS best_centiseconds, {named} FROM timed GROUP BY swimmer_id, {keys}"


def _rank_sql(keys: str, by: str, name: str, columns: str) -> str:
    """A rank is one more than the number of better swims."""
    return f"SELECT {keys}, {columns}, CAST(1 + count(*) OVER (PARTITION BY {keys} ORDER BY {by} DESC RANGE UNBOUNDED PRECEDING) - count(*) OVER (PARTITION BY {keys}, {by}) AS BIGINT) AS {name} FROM ind WHERE {by} IS NOT NULL"


def _age_rank_sql(columns: str, where: str = "true") -> str:
    """Each swimmer's first row by points; places are counted among these."""
    return f"""SELECT {columns}, coalesce(place, 0) AS age_rank FROM grp LEFT JOIN (
    SELECT result_id, row_number() OVER (PARTITION BY meet_id, number, age_group ORDER BY points DESC NULLS LAST, result_id) AS place FROM
        (SELECT * FROM grp WHERE relay_count = 1 AND rank >= 1 AND age_group IN ('Y1', 'Y2', 'Y3', 'J1', 'J2', 'J3', 'S1', 'S2', 'S3', 'S')
        QUALIFY row_number() OVER (PARTITION BY meet_id, number, age_group, name ORDER BY points DESC NULLS LAST, result_id) = 1)) USING (result_id) WHERE {where}"""


def _override_rows(x: Swims) -> tuple[DataFrame, DataFrame]:
    """The overrides, and a change to them: some are opened, then some races become para, some of them after being open."""
    change = x.overrides.where("race_id % 5 = 0").select("meet_id", "race_id", F.lit("open").alias("class"), F.lit(1).alias("pos"))
    new = x.races.where("race_id % 47 = 1").select("meet_id", "race_id", F.explode(F.array(F.struct(F.lit("para").alias("class"), F.lit(3).alias("pos")), F.struct(F.lit("open").alias("class"), F.lit(2).alias("pos")))).alias("c")).select("meet_id", "race_id", "c.*")
    return x.overrides, change.unionByName(new)


def _legacy_base(x: Swims) -> DataFrame:
    """Youth base times are a twentieth slower."""
    senior = x.base.withColumn("age_group", F.lit("S"))
    return senior.unionByName(x.base.withColumns({"age_group": F.lit("Y"), "basetime_in_sec": F.col("basetime_in_sec") * 1.05}))


def _legacy_rows(x: Swims) -> DataFrame:
    category = F.when(F.substring("meet_id", 6, 1).cast("int") % 2 == 0, F.array(F.lit("DO"), F.lit("DMY-K"))).otherwise(F.array(F.lit("DO")))
    return x.legacy.select("result_id", "season", "course", "gender", "relay_count", "distance", "stroke", "rank", "completed_centiseconds", category.alias("category"))


def _registry(x: Swims) -> DataFrame:
    month = F.substring("meet_id", 5, 2).cast("int")
    status = F.element_at(F.array(*map(F.lit, ("pending", "failed", "scraping", "done"))), (month % 4 + 1))
    return x.meets.select("meet_id", F.last_day("meet_date").alias("end_date"), status.alias("status"), (month % 5).alias("attempts"), F.when(month % 3 == 0, F.lit(12)).alias("grace_hours"), F.when(month % 5 == 0, F.lit(48)).alias("deadline_hours"), F.when(month != 6, F.to_timestamp("meet_date") + F.make_dt_interval(hours=month)).alias("claimed_at"))


_REGISTRY_SQL = """, m AS (SELECT *, CAST(substr(meet_id, 5, 2) AS INT) AS mo2 FROM fx_meet),
registry AS (SELECT meet_id, last_day(meet_date) AS end_date, ['pending', 'failed', 'scraping', 'done'][mo2 % 4 + 1] AS status, mo2 % 5 AS attempts,
    CASE WHEN mo2 % 3 = 0 THEN 12 END AS grace_hours, CASE WHEN mo2 % 5 = 0 THEN 48 END AS deadline_hours,
    CASE WHEN mo2 <> 6 THEN CAST(meet_date AS TIMESTAMP) + to_hours(mo2) END AS claimed_at FROM m)"""
NOW = "timestamp'1995-06-20 12:00:00'"


def _lines(x: Swims) -> DataFrame:
    """Raw lines of the meets, some with a file missing, some without a name, and a second record of each meet."""
    meet, even = F.col("meet_id"), F.substring("meet_id", 6, 1).cast("int") % 3 != 0
    named = F.when(F.col("meet_id").cast("int") % 5 != 0, F.col("meet_name"))
    info = x.meets.select(meet, F.lit("meet_info").alias("file"), F.explode(F.array(F.struct(F.lit(2).alias("pos"), F.to_json(F.struct(F.lit("second").alias("meet"))).alias("line")), F.struct(F.lit(0).alias("pos"), F.lit(" ").alias("line")), F.struct(F.lit(1).alias("pos"), F.to_json(F.struct(named.alias("meet"), "season")).alias("line")))).alias("l"))
    races = x.races.select(meet, F.lit("races").alias("file"), F.struct(F.lit(0).alias("pos"), F.col("race_id").cast("string").alias("line")).alias("l"))
    results = x.results.where(even).select(meet, F.lit("results").alias("file"), F.struct(F.lit(0).alias("pos"), F.coalesce("name", F.lit(" ")).alias("line")).alias("l"))
    return info.union(races).union(results).select("meet_id", "file", "l.*")


_LINES_SQL = """, lines AS (SELECT meet_id, 'meet_info' AS file, meet_name AS line FROM fx_meet UNION ALL SELECT meet_id, 'races', CAST(race_id AS VARCHAR) FROM races
    UNION ALL SELECT meet_id, 'results', coalesce(name, ' ') FROM fx_swims WHERE CAST(substr(meet_id, 6, 1) AS INT) % 3 <> 0),
whole AS (SELECT meet_id, CASE WHEN complete THEN CASE WHEN CAST(meet_id AS INT) % 5 = 0 THEN '' ELSE 'meet ' || meet_id END END AS meet_name, races, results, complete FROM (SELECT meet_id, count(*) FILTER (WHERE file = 'races') AS races, count(*) FILTER (WHERE file = 'results' AND trim(line) <> '') AS results,
    count(*) FILTER (WHERE file = 'meet_info') > 0 AND count(*) FILTER (WHERE file = 'races') > 0 AND count(*) FILTER (WHERE file = 'results') > 0 AS complete FROM lines GROUP BY meet_id))"""


def _orders(x: Swims) -> DataFrame:
    return x.spark.read.parquet(f"{x.sf_dir}/orders.parquet")


def _times(x: Swims) -> DataFrame:
    """Times as pages show them, from the prices of orders."""
    cents = F.floor(F.col("o_totalprice")).cast("bigint") % 100000
    k, second, hundredth = F.col("o_orderkey") % 10, F.lpad(F.expr("cents % 6000 div 100"), 2, "0"), F.lpad(F.expr("cents % 100"), 2, "0")
    minute, dot, colon = F.expr("cents div 6000").cast("string"), F.lit("."), F.lit(":")
    text = F.when(k == 0, "DSQ").when(k == 1, F.concat(second, dot, hundredth)).when(k == 2, F.concat(second, F.lit(","), F.substring(hundredth, 1, 1))).when(k == 3, second)
    text = text.when(k == 4, F.concat(minute, colon, second)).when(k == 5, F.concat(minute, colon, second, dot)).when(k == 6, F.concat(F.lit(" "), minute, colon, second, dot, hundredth, F.lit("9a"))).when(k == 7, F.concat(minute, colon, minute, colon, second))
    text = text.otherwise(F.concat(minute, colon, second, dot, hundredth))
    return _orders(x).withColumn("cents", cents).select("o_orderkey", text.alias("text"))


_TIMES_SQL = """WITH c AS (SELECT o_orderkey, o_orderkey % 10 AS k, CAST(floor(o_totalprice) AS BIGINT) % 100000 AS cents FROM orders),
d AS (SELECT *, cents // 6000 AS m, lpad(CAST(cents % 6000 // 100 AS VARCHAR), 2, '0') AS s, lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS h FROM c),
t AS (SELECT o_orderkey, CASE k WHEN 0 THEN 'DSQ' WHEN 1 THEN s || '.' || h WHEN 2 THEN s || ',' || substr(h, 1, 1) WHEN 3 THEN s WHEN 4 THEN m || ':' || s WHEN 5 THEN m || ':' || s || '.'
        WHEN 6 THEN ' ' || m || ':' || s || '.' || h || '9a' WHEN 7 THEN m || ':' || m || ':' || s ELSE m || ':' || s || '.' || h END AS text,
    CASE WHEN k IN (0, 7) THEN NULL ELSE CASE WHEN k < 4 THEN 0 ELSE m * 6000 END + CAST(s AS BIGINT) * 100
        + CASE WHEN k IN (3, 4, 5) THEN 0 WHEN k = 2 THEN CAST(substr(h, 1, 1) AS BIGINT) * 10 ELSE CAST(h AS BIGINT) END END AS cs FROM d)
SELECT o_orderkey, text, cs, cs / 100.0::DOUBLE AS seconds FROM t"""


def _dates(x: Swims) -> DataFrame:
    """Dates as pages show them: with and without dots, months in any case, white space of all kinds; and texts that are none."""
    date, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    name = F.element_at(F.array(*map(F.lit, fields.MONTHS)), F.month(date))
    day, year, gap = F.day(date).cast("string"), F.year(date).cast("string"), F.lit(" ")
    text = F.when(k % 11 == 0, date.cast("string")).when(k % 11 == 1, F.concat(day, gap, name, gap, year)).when(k % 11 == 2, F.concat(day, F.lit("."), name, gap, year)).when(k % 11 == 3, F.concat(F.lpad(day, 2, "0"), F.lit(".\u00a0"), F.upper(name), F.lit("\t"), year, F.lit(".")))
    text = text.when(k % 11 == 4, F.concat(gap, day, F.lit(" .  "), name, gap, year, gap)).when(k % 11 == 5, F.concat(day, F.lit(". marts. "), year, F.lit(" kl. 9"))).when(k % 11 == 6, F.concat(F.lit("31. februar "), year)).when(k % 11 == 7, F.concat(day, F.lit(". may "), year))
    return _orders(x).select("o_orderkey", text.otherwise(F.concat(day, F.lit(". "), F.initcap(name), gap, year)).alias("text"))


_MONTH_LIST = "[" + ", ".join(f"'{m}'" for m in fields.MONTHS) + "]"
_DATES_SQL = f"""WITH d AS (SELECT o_orderkey, o_orderkey % 11 AS k, CAST(o_orderdate AS DATE) AS day, {_MONTH_LIST}[month(o_orderdate)] AS m FROM orders),
t AS (SELECT o_orderkey, CASE k WHEN 0 THEN CAST(day AS VARCHAR) WHEN 1 THEN day(day) || ' ' || m || ' ' || year(day) WHEN 2 THEN day(day) || '.' || m || ' ' || year(day)
        WHEN 3 THEN lpad(CAST(day(day) AS VARCHAR), 2, '0') || '.' || chr(160) || upper(m) || chr(9) || year(day) || '.' WHEN 4 THEN ' ' || day(day) || ' .  ' || m || ' ' || year(day) || ' '
        WHEN 5 THEN day(day) || '. marts. ' || year(day) || ' kl. 9' WHEN 6 THEN '31. februar ' || year(day) WHEN 7 THEN day(day) || '. may ' || year(day)
        ELSE day(day) || '. ' || upper(substr(m, 1, 1)) || substr(m, 2) || ' ' || year(day) END AS text, CASE WHEN k NOT IN (0, 2, 5, 6, 7) THEN day END AS day FROM d)
SELECT o_orderkey, text, day, CAST(year(day) + CASE WHEN month(day) > 7 THEN 1 ELSE 0 END AS BIGINT) AS season, CAST(year(day) + CASE WHEN month(day) > 8 THEN 1 ELSE 0 END AS BIGINT) AS legacy_season FROM t"""


def _pick(values: tuple, by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


def _events(x: Swims) -> DataFrame:
    k = F.col("o_orderkey")
    stroke, gender = _pick(("Fri", "Ryg", "Bryst", "Hold medley", "IM"), k), _pick(("Herrer", "Damer", "Mix", "Herrer Para"), k)
    distance = F.concat((k % 9 + 1).cast("string"), F.lit("00"))
    one = F.concat(distance, F.lit(" "), stroke)
    event = F.when(k % 6 == 0, F.concat(F.lit("4 x "), one)).when(k % 13 == 0, F.concat(F.lit("1.500 "), stroke)).when(k % 17 == 0, F.concat(distance, F.lit("m "), stroke)).when(k % 19 == 0, stroke).otherwise(one)
    name = F.when(k % 11 == 0, "Pause").when(k % 23 == 0, F.concat(event, F.lit(" - "), gender, F.lit(" - A"))).otherwise(F.concat(event, F.lit(" - "), gender))
    heading = _pick(("Direkte finale", "Finale A", "Indledende heat", "Swim-off 1", "Andet"), k)
    url = F.concat(F.lit("https://example.org/race?x=1&id="), k.cast("string"))
    return _orders(x).select(k, url.alias("url"), (k % 50).cast("string").alias("number"), name.alias("name"), heading.alias("heading"))


_EVENTS_SQL = """WITH k AS (SELECT o_orderkey AS k, ['Fri', 'Ryg', 'Bryst', 'Hold medley', 'IM'][o_orderkey % 5 + 1] AS s, ['Herrer', 'Damer', 'Mix', 'Herrer Para'][o_orderkey % 4 + 1] AS g,
    (o_orderkey % 9 + 1) * 100 AS d, k % 6 = 0 AS relay, k % 11 <> 0 AND k % 23 <> 0 AS good FROM orders),
e AS (SELECT *, CASE WHEN relay THEN '4 x ' || d || ' ' || s WHEN k % 13 = 0 THEN '1.500 ' || s WHEN k % 17 = 0 THEN d || 'm ' || s WHEN k % 19 = 0 THEN s ELSE d || ' ' || s END AS event,
    NOT relay AND k % 13 <> 0 AND k % 17 <> 0 AND k % 19 = 0 AS bare FROM k)
SELECT k AS race_id, CAST(k % 50 AS BIGINT) AS number, CASE WHEN k % 11 = 0 THEN 'Pause' WHEN k % 23 = 0 THEN event || ' - ' || g || ' - A' ELSE event || ' - ' || g END AS name,
    CASE WHEN NOT good OR bare THEN NULL WHEN relay THEN d WHEN k % 13 = 0 THEN 1500 WHEN k % 17 = 0 THEN NULL ELSE d END AS distance,
    CASE WHEN NOT good THEN NULL WHEN bare THEN CASE WHEN s = 'Hold medley' THEN 'medley' END ELSE s END AS stroke,
    CASE WHEN good THEN ['M', 'F', 'X', NULL][k % 4 + 1] END AS gender, CAST(CASE WHEN good AND relay THEN 4 ELSE 1 END AS BIGINT) AS relay_count,
    ['Timed final', 'Final', 'Heats', 'Swim-off', 'Andet'][k % 5 + 1] AS type FROM e"""


_SEXES = ("Herrer", "d", "MIX", "Alle", "Herrer 16 år", "50m fri damer junior", "Hold mix", "Drenge", "hold", "damer og herrer", "", None, " herrer")
_SWIMS = ("Frisvømning", "Brystsvømning", "Rygsvømning", "Butterfly", "IM", "Ind.", "Indv.Medley", "Medley", "IM Medley", "fri", "butterfly", "Hundesvømning", None)


def _legacy_cells(x: Swims) -> DataFrame:
    """Strings of the old result pages, from orders, and what they mean."""
    k = F.col("o_orderkey")
    cells = _orders(x).select(k, _pick(("50", "4X100", "10x25", "x"), k).alias("relay"), _pick(("=3", "7", "-", "DSQ"), k).alias("place"), _pick(_SEXES, k).alias("sex"), _pick(_SWIMS, k).alias("swim"), _pick(("512", "", " ", None, "x"), k).alias("score"), _pick(("25m", "50m", "25m bane"), k).alias("pool"))
    c = F.col
    relay = fields.legacy_relay(c("relay"))
    return cells.select(k, relay.relay_count.alias("relay_count"), relay.distance.alias("distance"), fields.legacy_rank(c("place")).alias("rank"), fields.legacy_gender(c("sex")).alias("gender"), fields.legacy_stroke(c("swim")).alias("stroke"), fields.legacy_points(c("score")).alias("points"), fields.legacy_course_code(c("pool")).alias("course"))


_LEGACY_CELLS_SQL = """SELECT k AS o_orderkey, CAST([1, 4, 10, 1][k % 4 + 1] AS BIGINT) AS relay_count, CAST([50, 100, 25, NULL][k % 4 + 1] AS BIGINT) AS distance, CAST([3, 7, -1, NULL][k % 4 + 1] AS BIGINT) AS rank,
    ['M', 'F', 'X', '?', 'M', 'F', 'X', 'F', 'M', 'M', '?', '?', 'M'][k % 13 + 1] AS gender,
    ['FREE', 'BREAST', 'BACK', 'FLY', 'MEDLEY', 'MEDLEY', 'MEDLEY', 'MEDLEY', 'MEDLEY', 'FRI', 'BUTTERFLY', 'HUNDESVØMNING', NULL][k % 13 + 1] AS stroke, CAST(CASE WHEN k % 5 = 0 THEN 512 ELSE 0 END AS BIGINT) AS points,
    ['SCM', 'LCM', '?'][k % 3 + 1] AS course FROM (SELECT o_orderkey AS k FROM orders)"""


def _race_types(x: Swims) -> DataFrame:
    k = F.col("o_orderkey")
    heading = _pick(("Direkte finale", "FINALE A", "Indledende heat", "Swim-off 1", "Andet", "Omsvømning swim-off", "Indledende direkte", None), k)
    return _orders(x).select(k, heading.alias("heading")).withColumn("type", fields.race_type(F.col("heading")))


_RACE_TYPES_SQL = """SELECT o_orderkey, ['Direkte finale', 'FINALE A', 'Indledende heat', 'Swim-off 1', 'Andet', 'Omsvømning swim-off', 'Indledende direkte', NULL][o_orderkey % 8 + 1] AS heading,
    ['Timed final', 'Final', 'Heats', 'Swim-off', 'Andet', 'Omsvømning swim-off', 'Timed final', NULL][o_orderkey % 8 + 1] AS type FROM orders"""


def _cells(x: Swims) -> DataFrame:
    """Cells of result pages, from orders: ranks in words, relays whose links lead to split times, years that are none, times of all lengths."""
    k, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    cents = k * 37 % 30000
    time = F.concat((cents / 6000).cast("int").cast("string"), F.lit(":"), F.lpad((cents % 6000 / 100).cast("int").cast("string"), 2, "0"), F.when(k % 2 == 0, ".").otherwise(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    return _orders(x).select(
        k,
        F.when(k % 10 == 0, "DSQ").when(k % 10 == 1, "-").when(k % 10 == 2, " dsq ").when(k % 10 == 3, "Dsq").when(k % 10 == 4, "DNS").when(k % 10 == 5, "7.").otherwise((k % 10).cast("string")).alias("rank_text"),
        F.when(k % 4 == 0, F.concat(F.lit("splittider.html?"), customer)).when(k % 4 == 1, "swimmer.html").when(k % 4 == 2, F.concat(F.lit("swimmer.html?a?"), customer)).otherwise(F.concat(F.lit("swimmer.html?"), customer)).alias("href"),
        (k % 4 == 0).alias("is_relay"),
        F.when(k % 6 != 0, F.concat(F.lit("/flags/"), F.when(k % 2 == 0, "den").otherwise("swe"), F.lit(".png"))).alias("flag"),
        F.when(k % 7 == 0, "?").when(k % 7 == 1, "1.980").when(k % 7 == 2, "").otherwise((1980 + k % 30).cast("string")).alias("birth_text"),
        F.when(k % 9 == 0, "DNF").otherwise(time).alias("time_text"),
        F.when(k % 2 == 0, "Bane 50m").when(k % 3 == 0, "25m").otherwise("hav").alias("pool"),
        F.concat_ws(", ", F.lit("DM"), F.when(k % 3 == 0, "DO  DMJ")).alias("categories"),
    )


_CELLS_SQL = """WITH k AS (SELECT o_orderkey AS k, o_custkey, o_orderkey * 37 % 30000 AS cents FROM orders)
SELECT k AS o_orderkey, CASE WHEN k % 9 = 0 THEN 'DNF' ELSE (cents // 6000) || ':' || lpad(CAST(cents % 6000 // 100 AS VARCHAR), 2, '0') || CASE WHEN k % 2 = 0 THEN '.' ELSE ',' END || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS time_text,
    CASE WHEN k % 10 IN (0, 2, 3) THEN -1 WHEN k % 10 > 5 THEN k % 10 END AS rank, CASE WHEN k % 4 > 1 THEN CAST(o_custkey AS VARCHAR) END AS swimmer_id,
    CASE WHEN k % 6 = 0 THEN 'UNK' WHEN k % 2 = 0 THEN 'DEN' ELSE 'SWE' END AS nationality, CASE WHEN k % 7 > 2 THEN CAST(1980 + k % 30 AS BIGINT) END AS birth_year, CASE WHEN k % 9 <> 0 THEN cents END AS completed_centiseconds,
    CASE WHEN k % 2 = 0 THEN 'LCM' WHEN k % 3 = 0 THEN 'SCM' ELSE 'UNK' END AS course, CASE WHEN k % 3 = 0 THEN 'DM+DO+DMJ' ELSE 'DM' END AS categories FROM k"""


def _laps(x: Swims) -> DataFrame:
    """Laps of split-times pages, from orders."""
    k = F.col("o_orderkey")
    cells = _orders(x).select(k, _pick(("50", "1.500", "", "100m", " 200 ", None, "1.5.0"), k).alias("distance_text"), F.lit("31,4").alias("split_time"), F.concat(F.lit("1:0"), (k % 10).cast("string"), F.lit(".5")).alias("cumulative_time"))
    return fields.standardize_splits(cells)


_LAPS_SQL = """SELECT o_orderkey, '31,4' AS split_time, '1:0' || (o_orderkey % 10) || '.5' AS cumulative_time, [50, 1500, NULL, NULL, 200, NULL, 150][o_orderkey % 7 + 1]::BIGINT AS distance,
    3140::BIGINT AS split_centiseconds, 6000 + o_orderkey % 10 * 100 + 50 AS cumulative_centiseconds FROM orders WHERE o_orderkey % 7 NOT IN (2, 5)"""


def _result_fields(x: Swims) -> DataFrame:
    cells = fields.standardize_results(_cells(x))
    return cells.select("o_orderkey", "time_text", "rank", "swimmer_id", "nationality", "birth_year", "completed_centiseconds", fields.course_code(F.col("pool")).alias("course"), F.array_join(fields.split_categories(F.col("categories")), "+").alias("categories"))


def _with_text(rows: DataFrame, add: int | Column = 0) -> DataFrame:
    """Base times with their text, so many hundredths more."""
    return rows.withColumn("cs", F.round(F.col("basetime_in_sec") * 100).cast("bigint") + add).withColumn("basetime", _text_time("cs")).drop("cs")


def _base_text(x: Swims) -> DataFrame:
    """Base times with their text; some texts are a second off."""
    return _with_text(x.base, F.when(F.col("distance") % 350 == 0, 100).otherwise(0))


def _legacy_texts(x: Swims) -> DataFrame:
    """Legacy base times a second slower than the official ones, with a later repeat of each that is ten slower."""
    return _with_text(x.base, 100).withColumn("pos", F.lit(0)).unionByName(_with_text(x.base, 1000).withColumn("pos", F.lit(1)))


def _union(x: Swims) -> DataFrame:
    return curate.build_base_times(_with_text(x.base.where("season >= 1996")), _legacy_texts(x))


_UNION_SQL = """, secs AS (SELECT *, CAST(round(basetime_in_sec * 100) AS BIGINT) + CASE WHEN season >= 1996 THEN 0 ELSE 100 END AS c FROM fx_base_times),
joined AS (SELECT season, course, gender, relay_count, distance, stroke, (c // 6000) || ':' || lpad(CAST(c % 6000 // 100 AS VARCHAR), 2, '0') || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS basetime,
    c / 100.0::DOUBLE AS basetime_in_sec, CASE WHEN season >= 1996 THEN 'wa-doc' ELSE 'legacy-csv' END AS source FROM secs)"""
_STANDARD = f"""SELECT category, season, {EVENT}, count(*) AS swims, min(completed_centiseconds) AS best_cs, quantile_cont(completed_centiseconds, 0.25) AS p25_cs,
    quantile_cont(completed_centiseconds, 0.5) AS median_cs, quantile_cont(completed_centiseconds, 0.75) AS p75_cs, avg(completed_centiseconds) FILTER (WHERE r <= 8) AS top8_avg_cs
    FROM (SELECT *, rank() OVER (PARTITION BY category, season, {EVENT} ORDER BY completed_centiseconds) AS r FROM cat WHERE completed_centiseconds IS NOT NULL) GROUP BY ALL"""
_PACING = f"""SELECT result_id, name, {EVENT}, season, meet_name, CAST(a AS BIGINT) AS first_half_cs, CAST(b AS BIGINT) AS second_half_cs, CAST(b - a AS BIGINT) AS back_half_delta_cs, b < a AS negative_split
    FROM (SELECT result_id, list_sum(laps[: len(laps) // 2]) AS a, list_sum(laps[len(laps) // 2 + 1 :]) AS b
        FROM (SELECT result_id, list(split_centiseconds ORDER BY cumulative_centiseconds) AS laps FROM fx_splits WHERE split_centiseconds IS NOT NULL GROUP BY result_id) WHERE len(laps) > 1)
    JOIN ind USING (result_id)"""
_PROGRESSION = f"""SELECT result_id, swimmer_id, name, {EVENT}, season, meet_date, meet_name, completed_centiseconds, completed_time, points,
    completed_centiseconds - first_value(completed_centiseconds) OVER w AS delta_centiseconds, points - first_value(points) OVER w AS delta_points
    FROM timed WINDOW w AS (PARTITION BY swimmer_id, {EVENT} ORDER BY meet_date, result_id ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)"""
_IMPROVERS = f""", best AS (SELECT swimmer_id, {EVENT}, season, min(name) AS name, min(completed_centiseconds) AS cs, max(points) AS p FROM timed GROUP BY ALL)
SELECT now.swimmer_id, now.name, now.course, now.gender, now.distance, now.stroke, now.season, now.cs AS best_cs, old.cs AS prev_best_cs, old.cs - now.cs AS improvement_centiseconds, now.p - old.p AS improvement_points
    FROM best now ASOF JOIN best old ON now.swimmer_id = old.swimmer_id AND now.course = old.course AND now.gender = old.gender AND now.distance = old.distance AND now.stroke = old.stroke AND now.season > old.season"""
_AGES = f"""SELECT season, {EVENT}, age_group, swimmer_id, name, club, age, completed_time, points, rank() OVER (PARTITION BY season, {EVENT}, age_group ORDER BY completed_centiseconds) AS age_group_rank
    FROM (SELECT *, CASE WHEN age < 13 THEN '<=12' WHEN age < 15 THEN '13-14' WHEN age < 17 THEN '15-16' WHEN age < 19 THEN '17-18' ELSE '19+' END AS age_group FROM timed WHERE age IS NOT NULL)"""
_MEETS = """SELECT * FROM (SELECT meet_id, min(meet_name) AS meet_name, min(meet_date) AS meet_date, min(season) AS season, count(*) AS results, count(DISTINCT race_id) AS races, count(DISTINCT swimmer_id) AS swimmers FROM res GROUP BY meet_id)
    LEFT JOIN (SELECT meet_id, points AS top_points, swimmer_id AS top_points_swimmer FROM res WHERE swimmer_id IS NOT NULL AND points IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY meet_id ORDER BY points DESC, result_id DESC) = 1) USING (meet_id)"""
_CLUBS = """SELECT club, season, count(*) AS swims, count(DISTINCT swimmer_id) AS swimmers, count(*) FILTER (WHERE rank IN (1, 2, 3)) AS podiums, CAST(sum(points) AS BIGINT) AS total_points, max(points) AS best_points
    FROM ind WHERE club IS NOT NULL GROUP BY club, season"""
_CUT = f"SELECT category, season, {EVENT}, completed_centiseconds AS cutline_centiseconds, completed_time AS cutline_time, swimmer_id, name FROM prelim WHERE heat_rank = "
_LEGACY = f""", lb AS (SELECT *, 'S' AS age_group FROM fx_base_times UNION ALL SELECT season, course, gender, relay_count, distance, stroke, basetime_in_sec * 1.05::DOUBLE, 'Y' FROM fx_base_times),
lr AS (SELECT *, CASE WHEN course = 'SCM' AND CAST(substr(meet_id, 6, 1) AS INT) % 2 = 0 AND relay_count = 1 THEN 'Y' ELSE 'S' END AS age_group,
    CASE stroke WHEN 'Fri' THEN 'FREE' WHEN 'Ryg' THEN 'BACK' WHEN 'Bryst' THEN 'BREAST' WHEN 'Fly' THEN 'FLY' ELSE 'MEDLEY' END AS base_stroke FROM obt),
lp AS (SELECT lr.result_id, lr.age_group, lr.rank, completed_centiseconds::DOUBLE / 100.0::DOUBLE AS t, b.basetime_in_sec AS own, f.basetime_in_sec AS fixed
    FROM lr LEFT JOIN lb b ON b.age_group = lr.age_group AND b.season = CASE lr.age_group WHEN 'Y' THEN 1996 ELSE lr.season END AND b.course = lr.course AND b.gender = lr.gender
        AND b.relay_count = lr.relay_count AND b.distance = lr.distance AND b.stroke = lr.base_stroke
    LEFT JOIN lb f ON f.age_group = lr.age_group AND f.season = {FIXED} AND f.course = lr.course AND f.gender = lr.gender AND f.relay_count = lr.relay_count AND f.distance = lr.distance AND f.stroke = lr.base_stroke)
SELECT result_id, age_group, CASE WHEN rank = -1 THEN 0 ELSE coalesce(CAST(trunc(1000.0::DOUBLE * pow(own / t, 3.0::DOUBLE)) AS BIGINT), 0) END AS points,
    CASE WHEN rank = -1 THEN 0 ELSE coalesce(CAST(trunc(1000.0::DOUBLE * pow(fixed / t, 3.0::DOUBLE)) AS BIGINT), 0) END AS points_fixed FROM lp"""


def _json_lines(x: Swims, left_out: str = "false") -> dict[str, DataFrame]:
    """``(meet, kind, a, b, value)``: the lines of the raw files by kind, those of a meet together and in order; meets of a condition have no result lines.

    Rows are dealt and sorted as they are, and become text and laps afterwards.
    """
    dealt = lambda frame, *order: frame.withColumn("meet", F.col("meet_id")).repartition("meet").sortWithinPartitions("meet", *order)
    line = lambda frame, kind, a, b, record: frame.select("meet", F.lit(kind).alias("kind"), a.cast("bigint").alias("a"), b.cast("bigint").alias("b"), F.to_json(record).alias("value"))
    c, zero = F.col, F.lit(0)
    meet = F.struct(c("meet_id").cast("bigint").alias("meet_id"), c("meet_name").alias("meet"), "venue", "course", "season", F.date_format("meet_date", "dd-MM-yyyy").alias("date"), "category")
    race = F.struct("race_id", "number", c("race_name").alias("name"), "distance", "stroke", "gender", "relay_count", "type")
    result = F.struct("race_id", c("rank").alias("Rank"), c("name").alias("Name"), c("swimmer_id").alias("Swimmer_id"), "nationality", "club", "birth_year", "completed_time", "completed_centiseconds", "splits")
    nested = _results(dealt(x.swims.where(f"not ({left_out})"), "race_id", "ord"), _nested_laps(), c("meet"))
    return {"meet_info": line(dealt(x.raw_meets), "meet_info", zero, zero, meet), "races": line(dealt(x.races, "race_id"), "races", c("race_id"), zero, race), "results": line(nested, "results", c("race_id"), c("pos"), result)}


def _write_raw(x: Swims, root: str, left_out: str = "false", value: str = "value", scrape: str = "", packed: bool = False) -> None:
    """The raw zone: ``meet=<id>/<kind>.jsonl``, or ``meet=<id>/scrape=<scrape>/<kind>.jsonl``, written by Spark and named as a scrape names its files (``packed``: by gzip, with ``.gz`` after
    the name); ``value`` says what becomes of a line."""
    beside, tail = f"{root}-parts-{uuid.uuid4().hex}", ".gz" if packed else ""
    for kind, lines in _json_lines(x, left_out).items():
        with versions.tidy(x.spark):
            lines.select("meet", F.expr(value).alias("value")).write.partitionBy("meet").option("compression", "gzip" if packed else "none").text(f"{beside}/kind={kind}")
    fs, parts = lake.place(x.spark, f"{beside}/kind=*/meet=*/part-*")
    found = list(fs.globStatus(parts))
    for status in found:
        kind, meet, _ = status.getPath().toString().split("/")[-3:]
        folder = f"{meet}/scrape={scrape}" if scrape else meet
        _, to = lake.place(x.spark, f"{root}/{folder}/{kind.split('=')[1]}.jsonl{tail}")
        fs.mkdirs(to.getParent())
        fs.rename(status.getPath(), to)
    for meet in {status.getPath().getParent().getName() for status in found}:  # a scrape without results has an empty file
        folder = f"{root}/{meet}/scrape={scrape}" if scrape else f"{root}/{meet}"
        if not lake.exists(x.spark, f"{folder}/results.jsonl{tail}"):
            fs.create(lake.place(x.spark, f"{folder}/results.jsonl")[1]).close()


def _streamed(x: Swims) -> DataFrame:
    """Raw files of all meets, curated by the stream, and read back."""
    root = lake.scratch_path(x.spark, "stream")
    _write_raw(x, f"{root}/raw", packed=True)
    curate_stream.curate_stream(x.spark, f"{root}/raw", x.base, x.overrides, f"{root}/lake", f"{root}/offsets", FIXED).awaitTermination()
    versions.remove(x.spark, f"{root}/raw")
    return lake.read_curated(x.spark, f"{root}/lake", "obt_result")


def _rescraped(x: Swims) -> DataFrame:
    """All meets curated, then the quarter of them that a new scrape finds without results curated anew."""
    root, gone = lake.scratch_path(x.spark, "rescrape"), "cast(meet_id as int) % 4 = 1"
    for scrape, left_out in (("first", "false"), ("second", gone)):
        _write_raw(x, f"{root}/{scrape}", left_out, packed=True)
    curate_stream.curate_all(x.spark, f"{root}/first", x.base, x.overrides, f"{root}/lake", FIXED)
    versions.remove(x.spark, f"{root}/first")
    again = [r.meet_id for r in x.meets.where(gone).select("meet_id").collect()]
    curate_stream.recurate(x.spark, f"{root}/second", again, x.base, x.overrides, f"{root}/lake", FIXED)
    versions.remove(x.spark, f"{root}/second")
    return _digest({name: lake.read_curated(x.spark, f"{root}/lake", name) for name in CURATED})


#: A line with other clubs, and one that is cut short: the first of every tenth race of every fourth meet, and some races' own lines.
RENAMED = "replace(value, '\"club\":\"club', '\"club\":\"new')"
TORN = f"if(cast(meet as int) % 4 = 1 and a % 10 = 0 and (kind = 'results' and b = 0 or kind = 'races' and a % 20 = 0), substring(value, 1, length(value) - 9), {RENAMED})"


def _quarantined(x: Swims) -> DataFrame:
    """All meets curated, then curated anew from a scrape with new clubs and torn lines: who has which clubs, and the lines that were set aside."""
    root = lake.scratch_path(x.spark, "quarantine")
    _write_raw(x, f"{root}/raw", scrape="1", packed=True)
    curate_stream.curate_all(x.spark, f"{root}/raw", x.base, x.overrides, f"{root}/lake", FIXED)
    _write_raw(x, f"{root}/raw", value=TORN, scrape="2", packed=True)
    curate_stream.curate_all(x.spark, f"{root}/raw", x.base, x.overrides, f"{root}/lake", FIXED)
    versions.remove(x.spark, f"{root}/raw")
    none = F.lit(None).cast("string")
    kept = lake.read_curated(x.spark, f"{root}/lake", "obt_result").select("meet_id", none.alias("file"), F.lit(None).cast("bigint").alias("line_no"), "result_id", "club", none.alias("line"), none.alias("reason"))
    aside = lake.quarantined(x.spark, f"{root}/lake").select("meet_id", "file", "line_no", none.alias("result_id"), none.alias("club"), F.substring("line", 1, 15).alias("line"), "reason")
    return kept.union(aside)


_QUARANTINE_SQL = """, torn AS (SELECT meet_id, race_id, ord, row_number() OVER (PARTITION BY meet_id ORDER BY race_id, ord) AS line_no FROM fx_swims),
bad AS (SELECT meet_id, 'results' AS file, line_no, race_id FROM torn WHERE CAST(meet_id AS INT) % 4 = 1 AND race_id % 10 = 0 AND ord = 0
    UNION ALL SELECT meet_id, 'races', line_no, race_id FROM (SELECT meet_id, race_id, row_number() OVER (PARTITION BY meet_id ORDER BY race_id) AS line_no FROM races) WHERE CAST(meet_id AS INT) % 4 = 1 AND race_id % 20 = 0)
SELECT meet_id, NULL::VARCHAR AS file, NULL::BIGINT AS line_no, result_id, CASE WHEN meet_id IN (SELECT meet_id FROM bad) THEN club ELSE 'new' || substr(club, 5) END AS club, NULL::VARCHAR AS line, NULL::VARCHAR AS reason FROM obt
UNION ALL SELECT meet_id, file, line_no, NULL, NULL, substr(CASE file WHEN 'races' THEN '{"race_id":' || race_id || ',"number":' ELSE '{"race_id":' || race_id || ',"Rank":' END || repeat('~', 20), 1, 15), 'not a record' FROM bad"""


#: About how many blocks raw files are read in, to see that their order is kept.
BLOCKS = 4096


def _line_order(x: Swims) -> DataFrame:
    """Results of raw files that are read in many blocks, with their line numbers and the ids that follow from their order.

    Blocks have 8 kilobytes or more, so many that there are some ``BLOCKS`` of them: Spark's driver keeps a record of each.
    """
    root, session = lake.scratch_path(x.spark, "blocks"), x.spark.newSession()
    _write_raw(x, root)
    fs, at = lake.place(x.spark, root)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(max(8192, fs.getContentSummary(at).getLength() // BLOCKS)))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    lines = raw.raw_lines(session, root, "results")
    results = raw.parsed(lines, "results").select("meet_id", "path", "pos", "r.race_id", F.col("r.completed_centiseconds").alias("cs"))
    return curate.assign_result_ids(raw.numbered(lines, results).drop("path")).select("meet_id", "line_no", "race_id", "result_id", "cs")


def _scrapes_reversed(x: Swims) -> DataFrame:
    """Two scrapes of all meets, of which the later one comes first: two triggers of the stream, and what the zone has then."""
    root = lake.scratch_path(x.spark, "scrapes")
    for scrape, value in (("2024-02", RENAMED), ("2024-01", "value")):
        _write_raw(x, f"{root}/raw", value=value, scrape=scrape, packed=True)
        curate_stream.curate_stream(x.spark, f"{root}/raw", x.base, x.overrides, f"{root}/lake", f"{root}/offsets", FIXED).awaitTermination()
    versions.remove(x.spark, f"{root}/raw")
    told = lake.read_curated(x.spark, f"{root}/lake", "obt_result").join(lake.scrapes(x.spark, f"{root}/lake"), "meet_id")
    return told.select("meet_id", "result_id", "club", "points", "scrape")


def _compacted(x: Swims) -> DataFrame:
    """The zone compacted, then half of the meets curated anew with new clubs, one deleted, and old snapshots expired."""
    root = lake.scratch_path(x.spark, "compact")
    _write_raw(x, f"{root}/raw", scrape="1", packed=True)
    curate_stream.curate_all(x.spark, f"{root}/raw", x.base, x.overrides, f"{root}/lake", FIXED)
    lake.compact(x.spark, f"{root}/lake")
    lake.expire(x.spark, f"{root}/lake")
    _write_raw(x, f"{root}/raw", value=RENAMED, scrape="2", packed=True)
    again = [r.meet_id for r in x.meets.where("cast(meet_id as int) % 2 = 1").select("meet_id").collect()]
    curate_stream.recurate(x.spark, f"{root}/raw", again, x.base, x.overrides, f"{root}/lake", FIXED)
    lake.delete_meet(x.spark, f"{root}/lake", "199502")
    lake.expire(x.spark, f"{root}/lake")
    versions.remove(x.spark, f"{root}/raw")
    tables = {name: lake.read_curated(x.spark, f"{root}/lake", name) for name in CURATED}
    return _digest(tables)


def _counted(x: Swims) -> DataFrame:
    """What a run says it has written."""
    root = lake.scratch_path(x.spark, "counts")
    _write_raw(x, f"{root}/raw", packed=True)
    did = curate_stream.curate_all(x.spark, f"{root}/raw", x.base, x.overrides, f"{root}/lake", FIXED)
    return x.spark.createDataFrame(sorted(did.counts.items()), "tab string, n bigint")


def _override_versions(x: Swims) -> DataFrame:
    """The override table changed on disk: as given, after a change, and after another one, each made from what was read."""
    root = lake.scratch_path(x.spark, "override-versions")
    given, change = _override_rows(x)
    for step in (given.withColumn("pos", F.lit(0)), change, given.where("race_id % 2 = 0").select("meet_id", "race_id", F.lit("open").alias("class"), F.lit(0).alias("pos"))):
        raw.change_overrides(x.spark, root, step)
    return raw.current_overrides(x.spark, root).select("meet_id", "race_id", "class")


def _three_tables(x: Swims) -> DataFrame:
    """Two loads: some races of every second season, then everything with other names; the results with their races and meets, and how far ids are from gapless."""
    root = lake.scratch_path(x.spark, "load")
    meets = x.raw_meets.select("meet_id", F.col("meet_name").alias("name"), "venue", "course", "season", F.lit(0).alias("pos"))
    races = x.races.select("meet_id", "number", F.col("type").alias("status"), "distance", "stroke", "gender", "relay_count", F.col("race_id").alias("pos"), F.col("race_id").alias("source_race"))
    results = x.results.select(F.col("race_id").alias("source_race"), "pos", F.col("name").alias("swimmer"), F.col("birth_year").alias("birth"), F.col("club").alias("team"), "rank", F.lit(None).cast("bigint").alias("points"), "completed_time")
    even = meets.where("season % 2 = 0")
    load.load_meets(x.spark, root, {"meet": even, "race": races.where("source_race % 3 <> 0").join(even.select("meet_id"), "meet_id", "left_semi"), "result": results})
    load.load_meets(x.spark, root, {"meet": meets.withColumn("name", F.lit("second")), "race": races, "result": results.withColumn("team", F.concat(F.lit("late "), F.col("team")))})
    meet, race, result = (load.read_loaded(x.spark, root, t) for t in ("meet", "race", "result"))
    gap = lambda rows, c: F.lit(rows.agg(F.max(c) - F.countDistinct(c)).first()[0]).cast("bigint").alias(c.replace("_id", "_gaps"))
    return result.join(race, "race_id").join(meet, "meet_id").select("meet_id", F.col("name").alias("meet_name"), "number", "status", "stroke", "swimmer", "birth", "team", "rank", "completed_time", gap(race, "race_id"), gap(result, "result_id"))


_THREE_TABLES_SQL = """, r1 AS (SELECT meet_id, number, type, min(race_id) AS race_id FROM races WHERE race_id % 3 <> 0 AND meet_id IN (SELECT meet_id FROM fx_meet WHERE season % 2 = 0) GROUP BY ALL),
r2 AS (SELECT meet_id, number, type, min(race_id) AS race_id FROM races WHERE (meet_id, number, type) NOT IN (SELECT (meet_id, number, type) FROM r1) GROUP BY ALL),
chosen AS (SELECT *, false AS late FROM r1 UNION ALL SELECT *, true FROM r2),
rows AS (SELECT c.meet_id, c.number, c.type AS status, s.stroke, s.name AS swimmer, s.birth_year AS birth, CASE WHEN c.late THEN 'late ' || s.club ELSE s.club END AS team, s.rank, s.ord, c.race_id, s.completed_centiseconds AS cs
    FROM chosen c JOIN fx_swims s ON c.race_id = s.race_id),
firsts AS (SELECT * FROM rows WHERE swimmer IS NULL OR birth IS NULL OR team IS NULL UNION ALL SELECT * FROM rows WHERE swimmer IS NOT NULL AND birth IS NOT NULL AND team IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY race_id, swimmer, birth, team ORDER BY ord) = 1)
SELECT f.meet_id, CASE WHEN m.season % 2 = 0 THEN m.meet_name ELSE 'second' END AS meet_name, number, status, stroke, swimmer, birth, team, rank,
    CASE WHEN cs IS NOT NULL THEN (cs // 6000) || ':' || lpad(CAST(cs % 6000 // 100 AS VARCHAR), 2, '0') || '.' || lpad(CAST(cs % 100 AS VARCHAR), 2, '0') END AS completed_time, 0::BIGINT AS race_gaps, 0::BIGINT AS result_gaps
    FROM firsts f JOIN fx_meet m ON f.meet_id = m.meet_id"""


def _digest(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of all curated tables in one shape."""
    shape = {
        "dim_meet": ("meet_id", "cast(null as bigint)", "meet_name"),
        "dim_race": ("cast(race_id as string)", "number", "class"),
        "fact_result": ("result_id", "points", "club"),
        "fact_split": ("concat(result_id, '/', distance)", "split_centiseconds", "cast(cumulative_centiseconds as string)"),
        "obt_result": ("result_id", "points_fixed", "race_name"),
    }
    frames = [rows.selectExpr(f"'{name}' as tab", f"{shape[name][0]} as row_key", "meet_id", "season", "course", f"{shape[name][1]} as value", f"{shape[name][2]} as words") for name, rows in tables.items()]
    return reduce(DataFrame.union, frames)


def _digest_sql(where: str) -> str:
    return f"""SELECT 'dim_meet' AS tab, meet_id AS row_key, meet_id, season, course, CAST(NULL AS BIGINT) AS value, meet_name AS words FROM dim_meet
    UNION ALL SELECT 'dim_race', CAST(race_id AS VARCHAR), meet_id, season, course, number, class FROM dim_race
    UNION ALL SELECT 'fact_result', result_id, meet_id, season, course, points, club FROM obt WHERE {where}
    UNION ALL SELECT 'fact_split', l.result_id || '/' || l.distance, s.meet_id, l.season, l.course, l.split_centiseconds, CAST(l.cumulative_centiseconds AS VARCHAR) FROM fx_splits l JOIN fx_swims s ON l.result_id = s.result_id WHERE {where}
    UNION ALL SELECT 'obt_result', result_id, meet_id, season, course, points_fixed, race_name FROM obt WHERE {where}"""


def _raw_read(x: Swims) -> DataFrame:
    """What the raw files say, by meet, race and line."""
    root = lake.scratch_path(x.spark, "raw")
    _write_raw(x, root, packed=True)
    records = {kind: raw.parsed(raw.raw_lines(x.spark, root, kind), kind) for kind in raw.KINDS}
    races, meets = raw.raw_races(records["races"]).select("meet_id", "race_id", "race_name"), raw.raw_meets(records["meet_info"]).select("meet_id", "meet_date", F.array_join("category", ",").alias("category"))
    results = raw.raw_results(records["results"]).select("meet_id", "race_id", "pos", "rank", "completed_time", F.size("splits").alias("n_splits"))
    results = curate.assign_result_ids(results).drop("pos")
    return results.join(races, ["meet_id", "race_id"]).join(meets, "meet_id")


def _base_file(x: Swims) -> DataFrame:
    """Base times written as sorted JSON lines and read back."""
    path = lake.scratch_path(x.spark, "base")
    raw.write_base_times(_with_text(x.base).withColumn("source", F.lit("wa-doc")), path)
    return raw.read_base_times(x.spark, path)


def _legacy_file(x: Swims) -> DataFrame:
    """A legacy CSV, read; with the seconds of the texts and a mark where its own differ."""
    path = lake.scratch_path(x.spark, "legacy")
    rows = _with_text(x.base).select(F.col("season").alias("year"), "course", F.when(F.col("distance") % 150 == 0, "Y").otherwise("S").alias("age_group"), "gender", F.when(F.col("distance") % 400 == 0, 10).otherwise(F.col("relay_count")).alias("relay_count"), "distance", "stroke", "basetime", (F.col("basetime_in_sec") + F.when(F.col("season") % 3 == 0, 1).otherwise(0)).alias("basetime_in_sec"))
    rows.coalesce(1).write.csv(path, header=True)
    read = raw.read_legacy_base_times(x.spark, path)
    keys = list(curate.BASE_EVENT)
    return curate.legacy_base_times(read).join(raw.legacy_warnings(read).select(*keys, F.lit(True).alias("differs")), keys, "left").withColumn("differs", F.coalesce("differs", F.lit(False)))


def _overrides_file(x: Swims) -> DataFrame:
    path = lake.scratch_path(x.spark, "overrides")
    x.overrides.withColumn("reason", F.lit("told")).write.parquet(path)
    return raw.read_overrides(x.spark, path)


def _catalogued(x: Swims) -> DataFrame:
    """The curated tables as external tables, asked in SQL."""
    x.zone("obt_result", "dim_meet")
    root, name = fixture.place(x.spark, x.sf_dir, "zone")[0], f"swims_{uuid.uuid4().hex}"
    x.spark.sql(f"CREATE DATABASE {name} LOCATION '{lake.scratch_path(x.spark, 'database')}'")
    lake.register_catalog(x.spark, root, name)
    return x.spark.sql(f"SELECT o.season, o.course, count(*) AS n, count(o.points) AS scored, count(DISTINCT m.meet_id) AS meets FROM {name}.obt_result o JOIN {name}.dim_meet m ON o.meet_id = m.meet_id GROUP BY o.season, o.course")


def _by_name(x: Swims) -> DataFrame:
    """The views and the table function by name, from SQL."""
    registry.register_views(x.spark, x.views)
    return registry.query(x.spark, f"""SELECT p.season, p.course, count(*) AS swimmers, min(p.best_centiseconds) AS best, max(c.cutline_centiseconds) AS slowest_cut FROM season_best p
        LEFT JOIN cutline_at(3) c ON p.season = c.season AND p.course = c.course AND p.gender = c.gender AND p.distance = c.distance AND p.stroke = c.stroke GROUP BY p.season, p.course""")


_DEFINED = {
    "results_base": (lambda x: views.results(x.zone("obt_result")), f"SELECT {RESULTS} FROM res"),
    "individual_results": (lambda x: views.individual_results(x.zone("obt_result")), f"SELECT {RESULTS} FROM ind"),
    "personal_best": (lambda x: views.personal_best(x.zone("obt_result")), _best_sql(EVENT, "completed_time points meet_name meet_date season")),
    "season_best": (lambda x: views.season_best(x.zone("obt_result")), _best_sql(f"season, {EVENT}", "completed_time points meet_name meet_date")),
    "event_leaderboard": (lambda x: views.event_leaderboard(x.zone("obt_result")), _rank_sql(f"season, {EVENT}", "points", "points_rank", "swimmer_id, name, club, points, completed_time, meet_name, meet_date")),
    "swimmer_progression": (lambda x: views.swimmer_progression(x.zone("obt_result")), _PROGRESSION),
    "cross_era_best": (lambda x: views.cross_era_best(x.zone("obt_result")), _rank_sql(EVENT, "points_fixed", "era_rank", "swimmer_id, name, club, season, meet_name, meet_date, completed_time, points, points_fixed")),
    "biggest_improvers": (lambda x: views.biggest_improvers(x.zone("obt_result")), _IMPROVERS),
    "club_leaderboard": (lambda x: views.club_leaderboard(x.zone("obt_result")), _CLUBS),
    "age_group_ranking": (lambda x: views.age_group_ranking(x.zone("obt_result")), _AGES),
    "meet_summary": (lambda x: views.meet_summary(x.zone("obt_result")), _MEETS),
    "pacing": (lambda x: views.pacing(x.zone("fact_split").select("result_id", "split_centiseconds", "cumulative_centiseconds"), x.zone("obt_result")), _PACING),
    "results_by_category": (lambda x: views.results_by_category(x.zone("obt_result"), x.zone("dim_meet")), f"SELECT {RESULTS}, category FROM cat"),
    "event_standard_by_season": (lambda x: views.event_standard_by_season(x.zone("obt_result"), x.zone("dim_meet")), _STANDARD),
    "prelim_ranked": (lambda x: views.prelim_ranked(x.zone("obt_result"), x.zone("dim_meet")), "SELECT * FROM prelim"),
    "final_cutline": (lambda x: views.final_cutline_by_season(x.zone("obt_result"), x.zone("dim_meet")), _CUT + "8"),
    "cutline_at_6": (lambda x: views.cutline_at(x.zone("obt_result"), x.zone("dim_meet"), 6), _CUT + "6"),
    "views_by_name": (_by_name, ", cuts AS (SELECT DISTINCT ON (category, season, course, gender, distance, stroke) season, course, gender, distance, stroke, completed_centiseconds AS cut FROM prelim WHERE heat_rank = 3), mine AS (SELECT season, course, gender, distance, stroke, swimmer_id, min(completed_centiseconds) AS cs FROM timed GROUP BY ALL) SELECT season, course, count(*) AS swimmers, min(cs) AS best, max(cut) AS slowest_cut FROM mine LEFT JOIN cuts USING (season, course, gender, distance, stroke) GROUP BY season, course"),
    "classify_races": (lambda x: curate.classify_races(x.races, x.overrides).select("meet_id", "race_id", "race_name", "type", "class"), "SELECT meet_id, race_id, race_name, type, class FROM classed"),
    "result_ids": (lambda x: curate.assign_result_ids(x.results).select("meet_id", "race_id", "pos", "result_id"), "SELECT meet_id, race_id, ord AS pos, result_id FROM fx_swims"),
    "dim_meet": (lambda x: x.dim_meet.withColumn("category", F.array_join("category", ",")), "SELECT * REPLACE (array_to_string(category, ',') AS category) FROM dim_meet"),
    "dim_race": (lambda x: x.dim_race, "SELECT * FROM dim_race"),
    "fact_result_points": (lambda x: curate.build_fact_result(x.obt), f"SELECT {FACT} FROM obt"),
    "fact_split": (lambda x: curate.build_fact_split(x.nested, x.dim_meet).drop("split_time", "cumulative_time"), "SELECT l.result_id, l.race_id, s.meet_id, l.distance, l.split_centiseconds, l.cumulative_centiseconds, l.season, l.course FROM fx_splits l JOIN fx_swims s ON l.result_id = s.result_id"),
    "obt": (lambda x: x.obt, f"SELECT {OBT} FROM obt"),
    "curate_roundtrip": (lambda x: _digest(x.whole_zone), _digest_sql("true")),
    "curate_stream": (_streamed, f"SELECT {OBT} FROM obt"),
    "curate_rescrape": (_rescraped, _digest_sql("CAST(meet_id AS INT) % 4 <> 1")),
    "raw_files": (_raw_read, "SELECT r.meet_id, r.race_id, r.race_name, s.result_id, s.rank, CASE WHEN s.completed_centiseconds IS NOT NULL THEN (s.completed_centiseconds // 6000) || ':' || lpad(CAST(s.completed_centiseconds % 6000 // 100 AS VARCHAR), 2, '0') || '.' || lpad(CAST(s.completed_centiseconds % 100 AS VARCHAR), 2, '0') END AS completed_time, CAST(n AS INT) AS n_splits, m.meet_date, array_to_string(m.category, ',') AS category FROM fx_swims s JOIN races r ON s.meet_id = r.meet_id AND s.race_id = r.race_id JOIN fx_meet m ON s.meet_id = m.meet_id LEFT JOIN (SELECT result_id, count(*) AS n FROM fx_splits GROUP BY result_id) l ON s.result_id = l.result_id"),
    "raw_quarantine": (_quarantined, _QUARANTINE_SQL),
    "raw_line_order": (_line_order, "SELECT meet_id, row_number() OVER (PARTITION BY meet_id ORDER BY race_id, ord) AS line_no, race_id, result_id, completed_centiseconds AS cs FROM fx_swims"),
    "scrapes_reversed": (_scrapes_reversed, "SELECT meet_id, result_id, 'new' || substr(club, 5) AS club, points, '2024-02' AS scrape FROM obt"),
    "zone_compact": (_compacted, _digest_sql("meet_id <> '199502'").replace("points, club FROM obt", "points, CASE WHEN CAST(meet_id AS INT) % 2 = 1 THEN 'new' || substr(club, 5) ELSE club END FROM obt").replace("FROM dim_meet", "FROM dim_meet WHERE meet_id <> '199502'").replace("FROM dim_race", "FROM dim_race WHERE meet_id <> '199502'").replace("WHERE meet_id <> '199502'\n    UNION ALL SELECT 'obt", "WHERE s.meet_id <> '199502'\n    UNION ALL SELECT 'obt")),
    "curate_counts": (_counted, "SELECT 'dim_meet' AS tab, count(*) AS n FROM dim_meet UNION ALL SELECT 'dim_race', count(*) FROM dim_race UNION ALL SELECT 'fact_result', count(*) FROM obt UNION ALL SELECT 'obt_result', count(*) FROM obt UNION ALL SELECT 'fact_split', count(*) FROM fx_splits UNION ALL SELECT 'quarantine', 0"),
    "override_versions": (_override_versions, "SELECT meet_id, race_id, CASE WHEN race_id % 5 = 0 OR (race_id % 2 = 0 AND race_id % 53 = 0) THEN 'open' ELSE class END AS class FROM fx_overrides WHERE race_id % 47 <> 1 UNION ALL SELECT meet_id, race_id, CASE WHEN race_id % 53 = 0 AND race_id % 2 = 0 THEN 'open' ELSE 'para' END FROM races WHERE race_id % 47 = 1"),
    "three_table_load": (_three_tables, _THREE_TABLES_SQL),
    "enriched_points": (lambda x: curate.enrich_points(x.obt.drop("points", "points_fixed"), x.base, FIXED), f"SELECT {OBT.replace('points, points_fixed', 'CASE WHEN coalesce(rank, 0) <> -1 THEN any_points END AS points, CASE WHEN coalesce(rank, 0) <> -1 THEN any_fixed END AS points_fixed')} FROM pts"),
    "base_time_file": (_base_file, "SELECT season, course, gender, relay_count, distance, stroke, (c // 6000) || ':' || lpad(CAST(c % 6000 // 100 AS VARCHAR), 2, '0') || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS basetime, basetime_in_sec, 'wa-doc' AS source FROM (SELECT *, CAST(round(basetime_in_sec * 100) AS BIGINT) AS c FROM fx_base_times)"),
    "legacy_base_times": (_legacy_file, "SELECT season, course, gender, relay_count, distance, stroke, (c // 6000) || ':' || lpad(CAST(c % 6000 // 100 AS VARCHAR), 2, '0') || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS basetime, c / 100.0::DOUBLE AS basetime_in_sec, 'legacy-csv' AS source, season % 3 = 0 AS differs FROM (SELECT *, CAST(round(basetime_in_sec * 100) AS BIGINT) AS c FROM fx_base_times) WHERE distance % 150 <> 0 AND distance % 400 <> 0"),
    "override_file": (_overrides_file, "SELECT meet_id, race_id, class, 'told' AS reason FROM fx_overrides"),
    "catalog_tables": (_catalogued, "SELECT season, course, count(*) AS n, count(points) AS scored, count(DISTINCT meet_id) AS meets FROM obt GROUP BY season, course"),
    "points_coverage": (lambda x: curate.points_coverage(x.obt.drop("points", "points_fixed"), x.base, FIXED), "SELECT meet_id, count(*) AS results, count(p) AS scored, count(p)::DOUBLE / count(*) AS coverage FROM (SELECT meet_id, CASE WHEN coalesce(rank, 0) <> -1 THEN any_points END AS p FROM pts) GROUP BY ALL"),
    "base_time_union": (_union, _UNION_SQL + " SELECT * FROM joined"),
    "base_time_mismatch": (lambda x: curate.base_time_mismatch(_base_text(x), fields.base_seconds(F.col("basetime"))).select("season", *curate.EVENT_KEYS), "SELECT season, course, gender, relay_count, distance, stroke FROM fx_base_times WHERE distance % 350 = 0"),
    "base_time_summary": (lambda x: curate.base_time_summary(_union(x)), _UNION_SQL + " SELECT source, count(*) AS n, min(season) AS first_season, max(season) AS last_season, count(DISTINCT season) AS seasons FROM joined GROUP BY source"),
    "legacy_points": (lambda x: curate.legacy_points(_legacy_rows(x), _legacy_base(x), 1996, FIXED).select("result_id", "age_group", "points", "points_fixed"), _LEGACY),
    "age_groups": (lambda x: agegroups.assign_age_group(x.legacy).select("result_id", "gender", "birth_year", "season", "age_group"), "SELECT result_id, gender, birth_year, season, age_group FROM grp"),
    "age_group_rank": (lambda x: agegroups.age_group_rank(x.legacy).select("result_id", "meet_id", "number", "age_group", "age_rank"), _age_rank_sql("result_id, meet_id, number, age_group")),
    "group_ranking_j2": (lambda x: agegroups.group_ranking(x.legacy, "J2"), _age_rank_sql("meet_id, number, name, club, points, result_id", "age_group = 'J2' AND place > 0")),
    "append_category": (lambda x: agegroups.append_category(x.dim_meet, x.meets.where("meet_id % 2 = 0").select("meet_id", F.lit("DMJ").alias("added"))).select("meet_id", F.array_join("category", ",").alias("category")), "SELECT meet_id, array_to_string(CASE WHEN CAST(meet_id AS INT) % 2 <> 0 THEN category WHEN list_contains(coalesce(category, []), 'DMJ') THEN category ELSE list_append(coalesce(category, []), 'DMJ') END, ',') AS category FROM dim_meet"),
    "corrections": (lambda x: agegroups.apply_corrections(x.dim_meet, x.meets.where("season % 2 = 0").select("meet_id", F.when(F.col("meet_id") % 3 == 0, F.col("meet_date")).otherwise(F.lit("1900-01-01").cast("date")).alias("old"), F.date_add("meet_date", 7).alias("new")), "meet_id", "meet_date").select("meet_id", "meet_date"), "SELECT meet_id, CASE WHEN season % 2 = 0 AND CAST(meet_id AS INT) % 3 = 0 THEN meet_date + 7 ELSE meet_date END AS meet_date FROM dim_meet"),
    "finals_report": (lambda x: agegroups.finals_report(x.legacy, x.dim_meet, "DM-L", "LCM"), "SELECT meet_id, season, gender, stroke, distance, rank, name, points, result_id FROM obt WHERE type LIKE 'Final%' AND relay_count = 1 AND rank >= 1 AND meet_id IN (SELECT meet_id FROM dim_meet WHERE list_contains(category, 'DM-L') AND course = 'LCM')"),
    "event_catalogue": (lambda x: agegroups.event_catalogue(x.legacy, x.dim_meet, "DO"), "SELECT DISTINCT gender, stroke, distance FROM obt WHERE meet_id IN (SELECT meet_id FROM dim_meet WHERE list_contains(category, 'DO'))"),
    "participants_per_group": (lambda x: agegroups.participants_per_group(x.legacy), "SELECT season, age_group, count(DISTINCT swimmer_id) AS participants FROM grp WHERE swimmer_id IS NOT NULL GROUP BY ALL"),
    "unscored_audit": (lambda x: agegroups.unscored_audit(x.legacy), "SELECT meet_id, race_id, count(*) AS unscored FROM obt WHERE coalesce(points, 0) = 0 AND rank >= 1 GROUP BY ALL"),
    "youngest_cohort": (lambda x: agegroups.youngest_cohort(x.legacy), "SELECT season, gender, birth_year, result_id, swimmer_id, points FROM (SELECT *, max(birth_year) OVER (PARTITION BY season, gender) AS m FROM obt) WHERE birth_year = m"),
    "oldest_cohort": (lambda x: agegroups.oldest_cohort(x.legacy), "SELECT season, gender, birth_year, result_id, swimmer_id, points FROM (SELECT *, min(birth_year) OVER (PARTITION BY season, gender) AS m FROM obt) WHERE birth_year = m"),
    "gender_counts": (lambda x: agegroups.gender_counts(x.legacy), "SELECT gender, count(*) AS n, max(points) AS best_points, count(DISTINCT swimmer_id) AS swimmers FROM obt GROUP BY gender"),
    "semi_count": (lambda x: agegroups.results_in_races(x.legacy, x.dim_race.where("class = 'para'")), "SELECT count(*) AS n FROM obt WHERE race_id IN (SELECT race_id FROM dim_race WHERE class = 'para')"),
    "keep_last": (lambda x: agegroups.keep_last(x.legacy).select("race_id", "name", "birth_year", "club", "ord", "result_id"), "SELECT race_id, name, birth_year, club, ord, result_id FROM (SELECT *, CAST(split_part(result_id, '-', 2) AS BIGINT) AS ord, row_number() OVER (PARTITION BY race_id, name, birth_year, club ORDER BY CAST(split_part(result_id, '-', 2) AS BIGINT) DESC) AS n FROM obt) WHERE n = 1"),
    "append_if_absent": (lambda x: lake.append_if_absent(x.dim_race.where("race_id % 3 = 0"), x.dim_race.withColumn("class", F.lit("new")), ["meet_id", "number", "type"], "race_id").select("race_id", "meet_id", "number", "type", "class", "season"), "SELECT race_id, meet_id, number, type, class, season FROM dim_race WHERE race_id % 3 = 0 UNION ALL SELECT min(race_id), meet_id, number, type, 'new', min(season) FROM dim_race GROUP BY meet_id, number, type HAVING count(*) FILTER (WHERE race_id % 3 = 0) = 0"),
    "delete_meet": (lambda x: lake.without_meet(x.obt, x.meets.where("season % 3 = 0")), f"SELECT {OBT} FROM obt WHERE meet_id NOT IN (SELECT meet_id FROM fx_meet WHERE season % 3 = 0)"),
    "upsert_override": (lambda x: raw.upsert_override(*_override_rows(x)), "SELECT meet_id, race_id, CASE WHEN race_id % 5 = 0 THEN 'open' ELSE class END AS class FROM fx_overrides WHERE race_id % 47 <> 1 UNION ALL SELECT meet_id, race_id, 'para' FROM races WHERE race_id % 47 = 1"),
    "raw_completeness": (lambda x: audit.raw_completeness(_lines(x)), _LINES_SQL + " SELECT * FROM whole"),
    "due_meets": (lambda x: audit.due_meets(_registry(x), F.expr(NOW)).select("meet_id", "status", "action"), _REGISTRY_SQL + f""", due AS (SELECT *, timezone('Europe/Copenhagen', CAST(end_date AS TIMESTAMP) + INTERVAL 1439 MINUTE + to_hours(coalesce(grace_hours, 6))) AS a,
        timezone('Europe/Copenhagen', CAST(end_date AS TIMESTAMP) + INTERVAL 1439 MINUTE + to_hours(coalesce(deadline_hours, 72))) AS d, timezone('UTC', {NOW}) AS n FROM registry WHERE status = 'pending' OR (status = 'failed' AND attempts < 3))
        SELECT meet_id, status, CASE WHEN n < a THEN 'skip' WHEN n < d THEN 'check' ELSE 'deadline' END AS action FROM due"""),
    "stale_claims": (lambda x: audit.stale_claims(_registry(x), audit.raw_completeness(_lines(x)), F.expr(NOW)).select("meet_id", "outcome"), _LINES_SQL + _REGISTRY_SQL + f" SELECT r.meet_id, CASE WHEN coalesce(w.complete, false) THEN 'reconciled' ELSE 'reclaimed' END AS outcome FROM registry r LEFT JOIN whole w ON r.meet_id = w.meet_id WHERE status = 'scraping' AND (claimed_at IS NULL OR claimed_at <= {NOW} - INTERVAL 6 HOUR)"),
}


#: Strings composed from orders, standardised; their SQL stands alone.
_ALONE = {
    "time_to_centiseconds": (lambda x: _times(x).select("o_orderkey", "text", fields.time_to_centiseconds(F.col("text")).alias("cs"), fields.legacy_seconds(F.col("text")).alias("seconds")), _TIMES_SQL),
    "danish_date": (lambda x: _dates(x).withColumn("day", fields.danish_date(F.col("text"))).select("o_orderkey", "text", "day", fields.season_of(F.col("day")).alias("season"), fields.season_of(F.col("day"), 8).alias("legacy_season")), _DATES_SQL),
    "parse_event": (lambda x: fields.standardize_races(_events(x)), _EVENTS_SQL),
    "result_fields": (_result_fields, _CELLS_SQL),
    "split_fields": (_laps, _LAPS_SQL),
    "race_type": (_race_types, _RACE_TYPES_SQL),
    "legacy_fields": (_legacy_cells, _LEGACY_CELLS_SQL),
}


def _query(work):
    return lambda spark, sf_dir: work(Swims(spark, sf_dir))


QUERIES = {name: _query(work) for name, (work, _) in (_DEFINED | _ALONE).items()}
ORACLE = {name: (BASE_SQL if sql.startswith(",") else BASE_SQL + "\n") + sql for name, (_, sql) in _DEFINED.items()} | {name: sql for name, (_, sql) in _ALONE.items()}
