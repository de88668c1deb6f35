"""The zone's snapshots and commits, raw files that are broken, large or scraped again, and the legacy load."""

import json
import os

import pytest
from pyspark.sql import functions as F

from natatio.functions import fields
from natatio.operators import agegroups, audit, curate
from natatio.schemas import CURATED, OVERRIDES
from natatio.sources import lake, load, raw, versions
from natatio.streaming import curate_stream

BASE = "season long, course string, gender string, relay_count long, distance long, stroke string, basetime_in_sec double"
MEETS = ("11", "12", "13")


def put(root, meet, club="A", scrape="", n=3, **texts):
    """Raw files of a meet with a race of ``n`` results; texts take the place of files, None leaves one out."""
    info = {"meet_id": int(meet), "meet": f"meet {meet}", "venue": "v", "course": "LCM", "season": 2024, "date": "05-04-2024", "category": ["DM"]}
    race = {"meet_id": int(meet), "race_id": 7, "number": 1, "name": "100 Fri", "distance": 100, "stroke": "Fri", "gender": "M", "relay_count": 1, "type": "Final"}
    result = [{"race_id": 7, "Rank": k + 1, "Name": f"swimmer {k}", "Swimmer_id": str(k), "nationality": "DEN", "club": club, "birth_year": 2000, "completed_time": "50.00", "completed_centiseconds": 5000 + k, "splits": [{"distance": 50, "split_centiseconds": 2500, "cumulative_centiseconds": 2500}]} for k in range(n)]
    files = {"meet_info": json.dumps(info), "races": json.dumps(race) + "\n\n", "results": "\n".join(map(json.dumps, result))} | texts
    folder = f"{root}/meet={meet}" + (f"/scrape={scrape}" if scrape else "")
    os.makedirs(folder, exist_ok=True)
    for name in ("meet_info", "races", "results"):
        if files[name] is not None:
            with open(f"{folder}/{name}.jsonl", "w") as file:
                file.write(files[name])


@pytest.fixture(scope="module")
def tables(spark):
    base = spark.createDataFrame([(2024, "LCM", "M", 1, 100, "FREE", 50.0)], BASE)
    return base, spark.createDataFrame([], "meet_id string, race_id long, class string")


def clubs(spark, root, version=None):
    return {r.meet_id: (r.club, r.n) for r in lake.read_curated(spark, root, "obt_result", version).groupBy("meet_id").agg(F.max("club").alias("club"), F.count("*").alias("n")).collect()}


def test_versions(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert versions.current(spark, root) == 0 and versions.read(spark, root, "a long").count() == 0
    assert versions.commit(spark.range(1).toDF("a"), root, 0) == 1
    twice = versions.read(spark, root, "a long")
    assert versions.commit(twice.union(twice), root, 1) == 2  # made from the version before
    with pytest.raises(versions.Conflict):
        versions.commit(spark.range(9).toDF("a"), root, 1)
    assert versions.read(spark, root, "a long").count() == 2 and versions.read(spark, root, "a long", 1).count() == 1
    versions.commit(spark.range(3).toDF("a"), f"{tmp_path}/other", 0)
    with pytest.raises(Exception, match="exist"):  # a rename never takes the place of a version
        versions._rename(spark, f"{tmp_path}/other/v0000000001", f"{root}/v0000000002")
    assert versions.read(spark, root, "a long").count() == 2
    assert versions.expire(spark, root, 1) == [2] and versions.all_versions(spark, root) == [2]


def test_a_failure_between_tables_leaves_the_zone_as_it_was(spark, tables, tmp_path):
    source, root = f"{tmp_path}/raw", f"{tmp_path}/lake"
    put(source, "11")
    put(source, "12")
    did = curate_stream.curate_all(spark, source, *tables, root)
    assert did.counts == {"dim_meet": 2, "dim_race": 2, "fact_result": 6, "fact_split": 6, "obt_result": 6, "quarantine": 0}
    whole = {name: lake.read_curated(spark, root, name) for name in CURATED}
    broken = whole | {"fact_split": whole["fact_split"].withColumn("split_time", F.raise_error(F.lit("lost")).cast("string")), "obt_result": whole["obt_result"].withColumn("club", F.lit("B"))}
    with pytest.raises(Exception, match="lost"):
        lake.write_curated(broken, root)
    assert clubs(spark, root) == {"11": ("A", 3), "12": ("A", 3)}
    # A run that began before another one committed is refused, and nothing of it is seen.
    base = versions.current(spark, f"{root}/_manifests")
    lake.delete_meet(spark, root, "12")
    with pytest.raises(versions.Conflict):
        lake._commit(lake.manifest(spark, root, base), lake.manifest(spark, root, base), root, base)
    assert clubs(spark, root) == {"11": ("A", 3)} and clubs(spark, root, base) == {"11": ("A", 3), "12": ("A", 3)}


def test_broken_lines_set_their_meet_aside(spark, tables, tmp_path):
    source, root = f"{tmp_path}/raw", f"{tmp_path}/lake"
    for meet in MEETS:
        put(source, meet, "old")
    curate_stream.curate_all(spark, source, *tables, root)
    put(source, "11", "new")
    put(source, "12", "new", results='\n{"race_id": 7, "Rank": 1}\n\n{"race_id": 7, "Ra\n[]\n12\nnull\n{"race_id": "seven"}\n')
    put(source, "13", "new", meet_info='{"meet_id": 13}\n{"meet_id"')
    put(source, "14", races=None)
    put(source, "15", meet_info="")
    did = curate_stream.curate_all(spark, source, *tables, root)
    assert sorted(r.meet_id for r in did.aside.collect()) == ["12", "13", "14", "15"]
    assert clubs(spark, root) == {"11": ("new", 3), "12": ("old", 3), "13": ("old", 3)}
    told = sorted(lake.quarantined(spark, root).select("meet_id", "file", "line_no", "reason").collect(), key=str)
    assert [(r.meet_id, r.file, r.line_no) for r in told if r.reason == raw.BROKEN] == [("12", "results", n) for n in (4, 5, 6, 7, 8)] + [("13", "meet_info", 2)]
    assert [(r.meet_id, r.reason) for r in told if r.reason != raw.BROKEN] == [("14", raw.INCOMPLETE), ("15", raw.NO_RECORD)]
    put(source, "12", "mended")
    curate_stream.recurate(spark, source, ["12"], *tables, root)
    assert clubs(spark, root)["12"] == ("mended", 3)
    assert {r.meet_id for r in lake.quarantined(spark, root).collect()} == {"13", "14", "15"}


def test_line_numbers_of_files_read_in_blocks(spark, tmp_path):
    lines = [f'{{"race_id": {k % 3}, "Name": "{"x" * (k * 37 % 400)}", "birth_year": {k}}}' if k % 7 else "" for k in range(400)]
    for meet, tail in (("1", ""), ("2", "\n"), ("3", "\n\n")):
        put(f"{tmp_path}/raw", meet, results="\n".join(lines) + tail)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    read = raw.raw_lines(session, f"{tmp_path}/raw", "results")
    assert read.rdd.getNumPartitions() > 20
    got = raw.numbered(read).collect()
    assert len({(r.path, r.pos.block) for r in got}) > 30
    for meet in "123":
        own = sorted((r.line_no, r.line) for r in got if r.meet_id == meet)
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and [x for _, x in own][:400] == lines[: len(own)]
    ids = curate.assign_result_ids(raw.raw_results(raw.parsed(read, "results"))).select("meet_id", "result_id", "birth_year").collect()
    places = {}
    for k in (k for k in range(400) if k % 7):
        places[k] = f"{k % 3}-{sum(1 for j in range(k) if j % 7 and j % 3 == k % 3)}"
    assert sorted((r.meet_id, r.birth_year, r.result_id) for r in ids) == sorted((m, k, i) for m in "123" for k, i in places.items())


@pytest.mark.parametrize("order", [("2024-01", "2024-02"), ("2024-02", "2024-01")])
def test_scrapes_in_any_order(spark, tables, tmp_path, order):
    """Two processing-time batches, a scrape in each; the later scrape is what the zone has, and a late older or incomplete one changes nothing."""
    source, root, done, seen = f"{tmp_path}/raw", f"{tmp_path}/lake", {}, curate_stream.Progress()
    spark.streams.addListener(seen)
    put(source, "11", order[0], order[0])
    put(source, "12", order[0], order[0])
    query = curate_stream.curate_stream(spark, source, *tables, root, f"{tmp_path}/check", every="200 milliseconds", done=done.__setitem__)
    try:
        query.processAllAvailable()
        put(source, "11", order[1], order[1], n=2)
        put(source, "12", "incomplete", "2024-03", races=None)
        query.processAllAvailable()
        query.processAllAvailable()
    finally:
        query.stop()
        spark.streams.removeListener(seen)
    assert clubs(spark, root) == {"11": ("2024-02", 2 if order[1] == "2024-02" else 3), "12": (order[0], 3)}
    assert {r.meet_id: r.scrape for r in lake.scrapes(spark, root).collect()} == {"11": "2024-02", "12": order[0]}
    assert [done[k].counts["dim_meet"] for k in sorted(done)][0] == 2 and sum(x.counts["fact_result"] for x in done.values()) >= 8
    assert sum(b["arrivals"] for b in seen.batches.values()) == 4 and set(seen.batches) == set(done)
    batch = f"{tmp_path}/batch"
    curate_stream.curate_all(spark, source, *tables, batch)
    assert clubs(spark, batch) == clubs(spark, root)


def test_compact_then_recurate_is_as_never_compacted(spark, tables, tmp_path):
    source, roots = f"{tmp_path}/raw", (f"{tmp_path}/a", f"{tmp_path}/b")
    for meet in MEETS:
        put(source, meet)
        for root in roots:
            curate_stream.recurate(spark, source, [meet], *tables, root)
    assert lake.compact(spark, roots[0])["obt_result"] == 9
    assert len({r.snap for r in lake.manifest(spark, roots[0]).collect()}) == 1 and len({r.snap for r in lake.manifest(spark, roots[1]).where("live").collect()}) == 3
    put(source, "12", "new", n=1)
    for root in roots:
        curate_stream.recurate(spark, source, ["12"], *tables, root)
    for name in CURATED:
        one, two = (sorted(map(str, lake.read_curated(spark, root, name).collect())) for root in roots)
        assert one == two
    assert lake.expire(spark, roots[0]) > 0
    assert clubs(spark, roots[0]) == {"11": ("A", 3), "12": ("new", 1), "13": ("A", 3)}
    lake.compact(spark, roots[0], [2023])
    assert clubs(spark, roots[0]) == {"11": ("A", 3), "12": ("new", 1), "13": ("A", 3)}


def test_override_versions(spark, tmp_path):
    root, kind = f"{tmp_path}/o", "meet_id string, race_id long, class string, pos int"
    assert raw.change_overrides(spark, root, spark.createDataFrame([("1", 1, "para", 0), ("1", 2, "open", 0)], kind)) == 1
    assert raw.change_overrides(spark, root, spark.createDataFrame([("1", 1, "open", 0)], kind)) == 2
    assert raw.current_overrides(spark, root).schema.simpleString() == f"struct<{OVERRIDES.replace(' ', ':').replace(',:', ',')}>"
    with pytest.raises(versions.Conflict):  # somebody changed the table since version 1
        raw.change_overrides(spark, root, spark.createDataFrame([("1", 1, "para", 0)], kind), base=1)
    with pytest.raises(ValueError):
        raw.change_overrides(spark, root, spark.createDataFrame([("1", 1, "odd", 0)], kind))
    assert sorted((r.race_id, r["class"]) for r in raw.current_overrides(spark, root).collect()) == [(1, "open"), (2, "open")]


def test_legacy_load(spark, tmp_path):
    root = f"{tmp_path}/load"
    meet = lambda *rows: spark.createDataFrame([(m, n, "v", "LCM", 2020, p) for p, (m, n) in enumerate(rows)], "meet_id string, name string, venue string, course string, season long, pos long")
    race = lambda *rows: spark.createDataFrame([(m, n, s, 100, "FREE", "M", 1, p, i) for p, (m, n, s, i) in enumerate(rows)], "meet_id string, number long, status string, distance long, stroke string, gender string, relay_count long, pos long, source_race long")
    result = lambda *rows: spark.createDataFrame([(i, w, b, t, 1, 0, x, p) for p, (i, w, b, t, x) in enumerate(rows)], "source_race long, swimmer string, birth long, team string, rank long, points long, completed_time string, pos long")
    load.load_meets(spark, root, {"meet": meet(("a", "first"), ("a", "again"), (None, "no id")), "race": race(("a", 1, "PRELIM", 10), ("a", 1, "PRELIM", 11), ("a", None, "PRELIM", 12), ("z", 1, "PRELIM", 13)), "result": result((10, "s", 1990, "t", "1"), (10, "s", 1990, "t", "2"), (10, "s", 1991, "t", "3"), (11, "u", 1990, "t", "4"), (12, "s", 1990, None, "5"), (12, "s", 1990, None, "6"), (13, "s", 1990, "t", "7"))})
    table = lambda name: load.read_loaded(spark, root, name)
    assert [(r.meet_id, r.name) for r in table("meet").collect()] == [("a", "first")]
    assert sorted(r.completed_time for r in table("result").collect()) == ["1", "3", "5", "6"]
    load.load_meets(spark, root, {"meet": meet(("a", "other"), ("b", "second")), "race": race(("a", 1, "PRELIM", 20), ("a", 1, "A-FINAL", 21), ("b", 1, "PRELIM", 22)), "result": result((20, "new", 1990, "t", "8"), (21, "s", 1990, "t", "9"), (22, "s", 1990, "t", "10"))})
    assert sorted((r.meet_id, r.name) for r in table("meet").collect()) == [("a", "first"), ("b", "second")]
    assert sorted(r.race_id for r in table("race").collect()) == [1, 2, 3, 4] and sorted(r.result_id for r in table("result").collect()) == [1, 2, 3, 4, 5, 6]
    assert sorted(r.completed_time for r in table("result").collect()) == ["1", "10", "3", "5", "6", "9"]  # a known race's new results stay out
    assert table("result").join(table("race"), "race_id").count() == 6
    with pytest.raises(versions.Conflict):
        versions.commit(versions.read(spark, f"{root}/_loads", load.LOADS), f"{root}/_loads", 1)


def test_field_rules(spark):
    def each(name, function, cases):
        got = spark.createDataFrame([(x,) for x in cases], "x string").select("x", function(F.col("x")).alias("y")).collect()
        assert {r.x: r.y for r in got} == cases, name

    each("stroke", fields.legacy_stroke, {"Frisvømning": "FREE", "Rygsvømning": "BACK", "Ind.": "MEDLEY", "IM Medley": "MEDLEY", "butterfly": "BUTTERFLY", "frisvømning": "FRISVØMNING", "": "", None: None})
    each("gender", fields.legacy_gender, {"Herrer 16 år": "M", "50 FRI DAMER": "F", "Hold mix": "X", "dreng": "F", "H": "M", "alle": "?", "": "?", None: "?"})
    each("rank", fields.clean_rank, {"3": 3, " dsq": -1, "Dsq": -1, "DNS": None, "-": None, None: None})
    days = spark.createDataFrame([(x,) for x in ("5. april 2025", "5 april 2025", "05. APRIL 2025.", "5 april\t2025", "5april 2025", "5. april", "5. may 2025", "31. april 2025", "5. april 2025 x", "5. april 0", None)], "x string")
    assert [str(r[0]) for r in days.select(fields.danish_date(F.col("x"))).collect()] == ["2025-04-05"] * 4 + ["None"] * 7
    cells = spark.createDataFrame([("1", "s.html?9", True, None, "1.980", "1:00"), ("1", "s.html?9", False, None, "1980", "1:00"), ("1", "s.html?9", None, None, "80x", "1:00")], "rank_text string, href string, is_relay boolean, flag string, birth_text string, time_text string")
    assert [(r.swimmer_id, r.birth_year) for r in fields.standardize_results(cells).collect()] == [(None, None), ("9", 1980), ("9", None)]
    laps = spark.createDataFrame([("1.500", "30.1", "30.1"), ("", "1", "1"), ("x", "1", "1")], "distance_text string, split_time string, cumulative_time string")
    assert [r.distance for r in fields.standardize_splits(laps).collect()] == [1500, None]


def test_audit_names_and_cohorts(spark):
    lines = spark.createDataFrame([("1", "meet_info", 0, " "), ("1", "meet_info", 1, '{"meet": "M"}'), ("1", "meet_info", 2, '{"meet": "N"}'), ("1", "races", 0, "{}"), ("2", "meet_info", 0, "{}")], "meet_id string, file string, pos int, line string")
    files = spark.createDataFrame([(m, f) for m in "12" for f in ("meet_info", "races", "results")] + [("3", "races")], "meet_id string, file string")
    assert sorted(map(tuple, audit.raw_completeness(lines).collect())) == [("1", None, 1, 0, False), ("2", None, 0, 0, False)]
    assert sorted(map(tuple, audit.raw_completeness(lines, files).collect())) == [("1", "M", 1, 0, True), ("2", "", 0, 0, True), ("3", None, 0, 0, False)]
    rows = spark.createDataFrame([(2024, "M", b, str(n), "s", 1) for n, b in enumerate((2000, 2005, None, 2005, 1990))], "season long, gender string, birth_year long, result_id string, swimmer_id string, points long")
    assert sorted(r.result_id for r in agegroups.youngest_cohort(rows).collect()) == ["1", "3"] and [r.result_id for r in agegroups.oldest_cohort(rows).collect()] == ["4"]


def test_points_for_given_rows(spark, tables):
    rows = spark.createDataFrame([("a", 2024, "LCM", "M", 1, 100, "Fri", 1, 5000, "para", 7, "x"), ("b", 2024, "LCM", "M", 1, 100, "Fri", -1, 5000, "open", 7, "y"), ("c", 2024, "LCM", "M", 1, 200, "Fri", 1, 5000, None, 7, "z")], "id string, season long, course string, gender string, relay_count long, distance long, stroke string, rank long, completed_centiseconds long, class string, points long, `a.b` string")
    got = curate.enrich_points(rows, tables[0], 2024)
    assert got.columns == [c for c in rows.columns if c != "points"] + ["points", "points_fixed"]
    assert [(r.id, r["class"], r.points, r.points_fixed, r["a.b"]) for r in got.orderBy("id").collect()] == [("a", "para", 1000, 1000, "x"), ("b", "open", None, None, "y"), ("c", None, None, None, "z")]
