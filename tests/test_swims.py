"""Hand-built cases of the swim operators, files and streams."""

import datetime
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from natatio.functions import fields
from natatio.operators import agegroups, curate, views
from natatio.plans.catalogue import FIXED, Swims, _write_raw
from natatio.plans.registry import VIEWS, query, register_views
from natatio.schemas import CURATED
from natatio.sources import lake, raw
from natatio.streaming import curate_stream

DAY = datetime.date(2024, 3, 1)


def swims(spark, *rows):
    """Wide rows with defaults."""
    base = {"race_id": 1, "meet_id": "M1", "rank": 1, "name": "n", "swimmer_id": "s1", "nationality": "DEN", "club": "AC", "birth_year": 2008, "completed_time": "t", "completed_centiseconds": 6000, "points": 500, "points_fixed": 500, "season": 2024, "course": "LCM", "meet_name": "meet", "venue": "v", "meet_date": DAY, "number": 1, "race_name": "100 Fri", "distance": 100, "stroke": "Fri", "gender": "M", "relay_count": 1, "type": "Heats", "class": "open"}
    full = [base | {"result_id": f"r{n}"} | r for n, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[f.name] for f in CURATED["obt_result"].fields) for r in full], CURATED["obt_result"])


def meets(spark, *rows):
    return spark.createDataFrame(rows, "meet_id string, category array<string>")


def test_best_times(spark):
    obt = swims(spark, {"completed_centiseconds": 15000, "meet_id": "M1"}, {"completed_centiseconds": 14800, "completed_time": "2:28.00", "meet_id": "M2", "points": None})
    best = views.personal_best(obt).first()
    assert (best.best_centiseconds, best.best_time, best.meet_name, best.points) == (14800, "2:28.00", "meet", 500)
    assert views.season_best(swims(spark, {"completed_centiseconds": None})).count() == 0


def test_ranks_share_and_order(spark):
    obt = swims(spark, {"points": 620}, {"points": 600, "swimmer_id": "s2"}, {"points": 620, "swimmer_id": "s3"}, {"points": None, "swimmer_id": "s4"})
    assert sorted((r.swimmer_id, r.points_rank) for r in views.event_leaderboard(obt).collect()) == [("s1", 1), ("s2", 3), ("s3", 1)]


def test_progression_is_by_date(spark):
    obt = swims(spark, {"completed_centiseconds": 5900, "meet_date": datetime.date(2021, 12, 1)}, {"completed_centiseconds": 6000, "meet_date": datetime.date(2021, 7, 8)}, {"completed_centiseconds": 5950, "meet_date": datetime.date(2021, 12, 1), "result_id": "r2"}, {"completed_centiseconds": None, "meet_date": datetime.date(2021, 9, 1)})
    assert [(r.result_id, r.delta_centiseconds) for r in views.swimmer_progression(obt).orderBy("meet_date", "result_id").collect()] == [("r1", None), ("r0", -100), ("r2", 50)]


def test_improvers(spark):
    obt = swims(spark, {"season": 2022, "completed_centiseconds": 6200, "points": 560}, {"season": 2024, "completed_centiseconds": 6000, "points": 600}, {"season": 2023, "completed_centiseconds": None, "points": None})
    assert [(r.season, r.prev_best_cs, r.improvement_centiseconds, r.improvement_points) for r in views.biggest_improvers(obt).collect()] == [(2024, 6200, 200, 40)]


def test_clubs_ages_and_meets(spark):
    obt = swims(spark, {"points": 600}, {"rank": 4, "points": 500, "swimmer_id": "s2", "birth_year": 2010}, {"relay_count": 4, "swimmer_id": None, "points": 900}, {"rank": -1}, {"rank": None}, {"club": None, "birth_year": 2012, "swimmer_id": "s3", "points": 1})
    (club,) = views.club_leaderboard(obt).collect()
    assert (club.swims, club.swimmers, club.podiums, club.total_points, club.best_points) == (2, 2, 1, 1100, 600)
    assert sorted((r.age_group, r.age_group_rank) for r in views.age_group_ranking(obt).collect()) == [("13-14", 1), ("15-16", 1), ("<=12", 1)]
    meet = views.meet_summary(obt).first()
    assert (meet.results, meet.top_points, meet.top_points_swimmer) == (6, 600, "s1")


def test_pacing_puts_a_middle_lap_second(spark):
    laps = lambda i, *cs: [(i, c, sum(cs[: n + 1])) for n, c in enumerate(cs)]
    splits = spark.createDataFrame(laps("r0", 1500, 1500, 1400, 1400) + laps("r1", 10, 20, 30) + laps("r2", 50), "result_id string, split_centiseconds long, cumulative_centiseconds long")
    got = {r.result_id: (r.first_half_cs, r.second_half_cs, r.back_half_delta_cs, r.negative_split) for r in views.pacing(splits, swims(spark, {}, {}, {})).collect()}
    assert got == {"r0": (3000, 2800, -200, True), "r1": (10, 50, 40, False)}


def test_cutlines(spark):
    obt = swims(spark, *({"completed_centiseconds": 15000 + 10 * n, "swimmer_id": f"s{n}"} for n in range(10)))
    told = meets(spark, ("M1", ["DM", "DO"]), ("M2", None))
    assert {r.category: r.cutline_centiseconds for r in views.final_cutline_by_season(obt, told).collect()} == {"DM": 15070, "DO": 15070}
    assert {(r.cutline_centiseconds, r.swimmer_id, r.cutline_time) for r in views.cutline_at(obt, told, 6).collect()} == {(15050, "s5", "t")}
    standard = views.event_standard_by_season(obt, told).first()
    assert (standard.swims, standard.best_cs, standard.median_cs, standard.top8_avg_cs) == (10, 15000, 15045.0, 15035.0)
    assert views.event_standard_by_season(obt, told, approximate=True).first().best_cs == 15000


def test_points(spark):
    rows = spark.createDataFrame([(51.71, 5171), (51.71, 6000), (51.71, 5200), (50.0, 5200), (None, 5200), (50.0, 0), (20.91, 3485)], "base double, cs long")
    assert [r[0] for r in rows.select(fields.wa_points(F.col("base"), F.col("cs"))).collect()] == [1000, 640, 983, 888, None, None, 215]
    ok = spark.createDataFrame([(100, 1, "open"), (100, -1, "open"), (None, 1, "open"), (100, 1, "para"), (100, None, "open")], "cs long, rank long, class string")
    assert [r[0] for r in ok.select(curate.scored(F.col("cs"), F.col("rank"), F.col("class"))).collect()] == [True, False, False, False, True]


def test_classes(spark):
    races = spark.createDataFrame([("M", 1, "a", "Heats"), ("M", 2, "a", "Final"), ("M", 3, "a", "Timed final"), ("M", 4, "b", "Timed final"), ("N", 3, "a", "Timed final")], "meet_id string, race_id long, race_name string, type string")
    told = spark.createDataFrame([("M", 1, "para"), ("M", 3, "open")], "meet_id string, race_id long, class string")
    kinds = lambda o: {(r.meet_id, r.race_id): r["class"] for r in curate.classify_races(races, o).collect()}
    assert kinds(told.limit(0)) == {("M", 1): "open", ("M", 2): "open", ("M", 3): "para", ("M", 4): "open", ("N", 3): "open"}
    assert kinds(told) == {("M", 1): "para", ("M", 2): "open", ("M", 3): "open", ("M", 4): "open", ("N", 3): "open"}


@pytest.mark.parametrize("text,want", [("1:02.48", 6248), ("58.21", 5821), ("58.2", 5820), ("58,219", 5821), ("58", 5800), ("1:02", 6200), ("1:02.", 6200), ("58.21x", 5821), ("58.2x", None), (":58.2", None), ("DSQ", None), ("-", None), ("", None), ("1:2:3.4", None), (None, None)])
def test_times(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(fields.time_to_centiseconds(F.col("t"))).first()[0] == want


def test_base_seconds(spark):
    rows = [("1:02.48", 62.48), ("58.21", 58.21), (" 2: 0 8.7", 128.7), ("58", 58.0), ("58.219", 58.22), ("1:02", 62.0), ("DSQ", None), ("1:2:3", None), ("", None), (None, None)]
    got = spark.createDataFrame(rows, "t string, want double").select("want", fields.base_seconds(F.col("t")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_events(spark):
    rows = {
        "100 Fri - Herrer": (100, "Fri", "M", 1), "4 x 100 Fri - Damer": (100, "Fri", "F", 4), "1.500 Fri - Mix": (1500, "Fri", "X", 1), "4 x 50 Hold medley - Mix": (50, "Hold medley", "X", 4),
        "100 Fri Junior - Herrer": (100, "Fri Junior", "M", 1), "100 Fri - Herrer Para": (100, "Fri", None, 1), "100m Fri - Herrer": (None, "Fri", "M", 1), "Fri - Herrer": (None, None, "M", 1),
        "100 Fri - herrer": (100, "Fri", None, 1), "100 Fri - Herrer - A": (None, None, None, 1), "Pause": (None, None, None, 1), "x x 100 Fri - Damer": (100, "Fri", "F", 1), "4 x 100 - Damer": (4, "x 100", "F", 1), "": (None, None, None, 1),
    }
    got = spark.createDataFrame([(k,) for k in rows] + [(None,)], "name string").select("name", fields.parse_event(F.col("name")).alias("e")).collect()
    assert {r.name: tuple(r.e) for r in got} == rows | {None: (None, None, None, 1)}


def test_legacy_fields(spark):
    row = spark.createDataFrame([("4X50", "=3", "-", "Herrer", "Butterfly", " ", "25m", "Direkte finale")], "relay string, r1 string, r2 string, g string, s string, p string, c string, h string")
    c = F.col
    got = row.select(fields.legacy_relay(c("relay")).alias("x"), fields.legacy_rank(c("r1")), fields.legacy_rank(c("r2")), fields.legacy_gender(c("g")), fields.legacy_stroke(c("s")), fields.legacy_points(c("p")), fields.legacy_course_code(c("c")), fields.race_type(c("h"))).first()
    assert tuple(got[0]) == (4, 50) and tuple(got)[1:] == (3, -1, "M", "FLY", 0, "SCM", "Timed final")


def test_age_groups(spark):
    rows = spark.createDataFrame([("M", 12), ("M", 13), ("F", 12), ("F", 18), ("M", 21), ("M", 22), ("F", 21), ("X", 15), ("M", None)], "g string, a long")
    assert [r[0] for r in rows.select(agegroups.age_group(F.col("g"), F.col("a"))).collect()] == ["-", "Y1", "Y1", "S1", "S3", "S", "S", "-", "-"]


def test_reference_tables(spark, tmp_path):
    path = f"{tmp_path}/base.jsonl"
    row = {"season": 2024, "course": "LCM", "gender": "M", "relay_count": 1, "distance": 100, "stroke": "FREE", "basetime": "46.80", "basetime_in_sec": 46.8}
    with open(path, "w") as file:
        file.write("\n".join(json.dumps(r) for r in (row | {"basetime_in_sec": 40.0}, row)) + "\n\n")
    base = raw.read_base_times(spark, path)
    assert [r.basetime_in_sec for r in base.collect()] == [46.8]
    curate.check_base_times(base, fields.base_seconds(F.col("basetime")))
    with pytest.raises(ValueError):
        curate.check_base_times(base.withColumn("basetime_in_sec", F.lit(1.0)), fields.base_seconds(F.col("basetime")))
    raw.write_base_times(base, f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out").count() == 1
    with open(f"{tmp_path}/old.csv", "w") as file:
        file.write("year,course,age_group,gender,relay_count,distance,stroke,basetime,basetime_in_sec\n2020,LCM,S,M,1,100,FREE,47.0,47.0\n2020,LCM,S,M,1,100,FREE,46.0,46.0\n2020,LCM,S,M,1,200,FREE,1:47.0,99\n2020,LCM,S,M,10,25,FREE,9,9\n2020,LCM,Y,M,1,100,FREE,50,50\n")
    old = raw.read_legacy_base_times(spark, f"{tmp_path}/old.csv")
    assert sorted((r.distance, r.basetime_in_sec, r.source) for r in curate.legacy_base_times(old).collect()) == [(100, 47.0, "legacy-csv"), (200, 107.0, "legacy-csv")]
    assert [(r.distance, r.csv_seconds, r.text_seconds) for r in raw.legacy_warnings(old).collect()] == [(200, 99.0, 107.0)]
    every = curate.build_base_times(spark.createDataFrame([(2020, "LCM", "M", 1, 100, "FREE", "46.80", 46.8)], "season long, course string, gender string, relay_count long, distance long, stroke string, basetime string, basetime_in_sec double"), old)
    assert sorted((r.distance, r.basetime_in_sec, r.source) for r in every.collect()) == [(100, 46.8, "wa-doc"), (200, 107.0, "legacy-csv")]
    none = spark.createDataFrame([], "meet_id string, race_id long, class string")
    with pytest.raises(ValueError):
        raw.upsert_override(none, spark.createDataFrame([("M", 1, "odd", 0)], "meet_id string, race_id long, class string, pos int"))
    change = spark.createDataFrame([("M", 1, "para", 2), ("M", 1, "open", 1), ("M", 2, "open", 1)], "meet_id string, race_id long, class string, pos int")
    after = raw.upsert_override(spark.createDataFrame([("M", 1, "open"), ("M", 3, "para")], none.schema), change)
    assert sorted(map(tuple, after.collect())) == [("M", 1, "para"), ("M", 2, "open"), ("M", 3, "para")]


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    """Raw files of a few meets, written from the derived swims."""
    at, x = tmp_path_factory.mktemp("zone"), Swims(spark, "/root/testdata/sf0.001")
    few = [r.meet_id for r in x.meets.orderBy("meet_id").limit(4).collect()]
    own = lambda frame: frame.where(F.col("meet_id").isin(few))
    _write_raw(x, f"{at}/given")
    texts = {(m, n): open(f"{at}/given/meet={m}/{n}.jsonl").read() for m in few for n in ("meet_info", "races", "results")}
    base, overrides = spark.createDataFrame(x.base.collect(), x.base.schema), spark.createDataFrame(x.overrides.collect(), x.overrides.schema)
    return at, few, texts, base, overrides, own(x.obt).cache()


def put(root, texts, chosen):
    for (meet, name), text in sorted(texts.items(), key=lambda t: t[0][1] == "results"):
        if meet in chosen:
            os.makedirs(f"{root}/meet={meet}", exist_ok=True)
            with open(f"{root}/meet={meet}/{name}.jsonl", "w") as file:
                file.write(text)


def rows(frame):
    return sorted(map(tuple, frame.select(*CURATED["obt_result"].names).collect()), key=str)


def test_curated_files_and_streams(spark, zone):
    at, few, texts, base, overrides, obt = zone
    source, lakes = f"{at}/raw", {k: f"{at}/{k}" for k in ("batch", "stream")}
    put(source, texts, few[:2])
    step = lambda: curate_stream.curate_stream(spark, source, base, overrides, lakes["stream"], f"{at}/check", FIXED).awaitTermination()
    step()
    put(source, texts, few[2:])
    step()
    curate_stream.curate_all(spark, source, base, overrides, lakes["batch"], FIXED)
    want = rows(obt)
    assert rows(lake.read_curated(spark, lakes["batch"], "obt_result")) == want
    assert rows(lake.read_curated(spark, lakes["stream"], "obt_result")) == want
    assert lake.read_curated(spark, lakes["batch"], "fact_split").count() > 0
    curate_stream.recurate(spark, source, few[:1], base, overrides, lakes["batch"], FIXED)
    assert rows(lake.read_curated(spark, lakes["batch"], "obt_result")) == want
    lake.compact(spark, lakes["batch"])
    assert rows(lake.read_curated(spark, lakes["batch"], "obt_result")) == want
    moved = lake.read_curated(spark, lakes["batch"], "dim_meet").where(F.col("meet_id") == few[0]).withColumn("season", F.lit(1950).cast("long"))
    lake.write_curated({"dim_meet": spark.createDataFrame(moved.collect(), moved.schema)}, lakes["batch"])
    assert [r.season for r in lake.read_curated(spark, lakes["batch"], "dim_meet").where(F.col("meet_id") == few[0]).collect()] == [1950]
    lake.delete_meet(spark, lakes["batch"], few[1])
    assert few[1] not in {r.meet_id for r in lake.read_curated(spark, lakes["batch"], "obt_result").collect()}


def test_a_scrape_without_results_empties_the_meet(spark, zone):
    at, few, texts, base, overrides, obt = zone
    source, root = f"{at}/raw-again", f"{at}/lake-again"
    put(source, texts, few[:2])
    curate_stream.curate_all(spark, source, base, overrides, root, FIXED)
    put(source, texts | {(few[0], "results"): ""}, few[:1])
    curate_stream.recurate(spark, source, few[:1], base, overrides, root, FIXED)
    for name in ("fact_result", "fact_split", "obt_result"):
        assert {r.meet_id for r in lake.read_curated(spark, root, name).collect()} == {few[1]}
    assert {r.meet_id for r in lake.read_curated(spark, root, "dim_race").collect()} == set(few[:2])
    put(source, texts | {(few[1], "meet_info"): ""}, few[1:2])  # set aside: the zone keeps what it has
    aside = curate_stream.recurate(spark, source, few[1:2], base, overrides, root, FIXED)
    assert [r.meet_id for r in aside.aside.collect()] == few[1:2]
    assert rows(lake.read_curated(spark, root, "obt_result")) == rows(obt.where(F.col("meet_id") == few[1]))
    assert not [f for f in os.listdir(f"{root}/obt_result") if "DEFAULT" in f]


def test_age_rank_needs_a_group(spark):
    obt = swims(spark, {"points": 9, "name": "a"}, {"points": 8, "name": "a"}, {"points": 7, "name": "b"}, {"points": 99, "name": "c", "birth_year": None}, {"points": 98, "name": "d", "rank": -1}, {"points": 97, "name": "e", "relay_count": 4})
    assert [r.age_rank for r in agegroups.age_group_rank(obt).orderBy("result_id").collect()] == [1, 0, 2, 0, 0, 0]


def test_legacy_points(spark):
    base = spark.createDataFrame([(2020, "SCM", "M", 1, 100, "FREE", 60.0, "Y"), (2020, "SCM", "M", 1, 100, "FREE", 50.0, "S"), (2012, "SCM", "M", 1, 100, "FREE", 55.0, "S")], "season long, course string, gender string, relay_count long, distance long, stroke string, basetime_in_sec double, age_group string")
    made = [("a", 2012, 1, 6000, ["DMY-K"]), ("b", 2012, -1, 6000, ["DMY-K"]), ("c", 2012, 1, 6000, ["DO"]), ("d", 2012, None, 6000, None), ("e", 2013, 1, None, [])]
    rows = spark.createDataFrame([(i, s, "SCM", "M", 1, 100, "Fri", k, t, c) for i, s, k, t, c in made], "result_id string, season long, course string, gender string, relay_count long, distance long, stroke string, rank long, completed_centiseconds long, category array<string>")
    got = {r.result_id: (r.age_group, r.points, r.points_fixed) for r in curate.legacy_points(rows, base, 2020, 2020).collect()}
    senior = ("S", int(1000 * (55 / 60) ** 3), int(1000 * (50 / 60) ** 3))
    assert got == {"a": ("Y", 1000, 1000), "b": ("Y", 0, 0), "c": senior, "d": senior, "e": ("S", 0, 0)}


def test_scratch_needs_a_shared_folder():
    session = lambda master, **conf: SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))
    with pytest.raises(RuntimeError):
        lake.scratch_path(session("spark://elsewhere:7077"), "x")
    assert "/x-" in lake.scratch_path(session("local[4]"), "x")
    assert lake.scratch_path(session("spark://elsewhere:7077", **{"spark.checkpoint.dir": "/shared/"}), "x").startswith("/shared/x-")


def test_an_empty_meet_is_put_aside(spark, tmp_path):
    os.makedirs(f"{tmp_path}/meet=7")
    open(f"{tmp_path}/meet=7/meet_info.jsonl", "w").close()
    with open(f"{tmp_path}/meet=7/races.jsonl", "w") as file:
        file.write('{"race_id": 1}')
    files, kinds = raw.raw_files(spark, str(tmp_path)), ("meet_info", "races")
    assert sorted((r.meet_id, r.scrape, r.file) for r in files.collect()) == [("7", "", kind) for kind in kinds]
    assert [(r.meet_id, r.scrape) for r in raw.latest_scrapes(files).collect()] == [("7", None)]
    assert raw.raw_meets(raw.parsed(raw.raw_lines(spark, str(tmp_path), "meet_info"), "meet_info")).count() == 0


def test_views_by_name(spark):
    obt = swims(spark, *({"completed_centiseconds": 15000 + 10 * n, "swimmer_id": f"s{n}"} for n in range(9)))
    splits = spark.createDataFrame([("r0", 1500, 1500)], "result_id string, split_centiseconds long, cumulative_centiseconds long")
    register_views(spark, {"obt_result": obt, "dim_meet": meets(spark, ("M1", ["DM"])), "fact_split": splits})
    for name in VIEWS:
        assert query(spark, f"SELECT * FROM {name}").count() >= 0
    assert query(spark, "SELECT cutline_centiseconds FROM final_cutline_by_season WHERE category = 'DM'").first()[0] == 15070
    assert query(spark, "SELECT cutline_centiseconds FROM cutline_at(3)").first()[0] == 15020


def test_catalog_tables(spark, zone, tmp_path):
    at, few, texts, base, overrides, obt = zone
    lake.write_curated({"obt_result": spark.createDataFrame(obt.limit(20).collect(), obt.schema)}, f"{tmp_path}/lake")
    assert lake.read_curated(spark, f"{tmp_path}/lake", "obt_result").count() == 20
    empty = {name: spark.createDataFrame([], schema) for name, schema in CURATED.items() if name != "obt_result"}
    assert lake.write_curated(empty, f"{tmp_path}/lake") == dict.fromkeys(empty, 0)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS swims LOCATION '{tmp_path}/db'")
    lake.register_catalog(spark, f"{tmp_path}/lake", "swims")
    assert spark.table("swims.obt_result").count() == 20
    spark.sql("DROP DATABASE swims CASCADE")
