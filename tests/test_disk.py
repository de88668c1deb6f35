"""What queries of the swim operators leave on disk and shuffle."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from natatio.operators import agegroups, curate
from natatio.plans import catalogue, fixture
from natatio.plans.catalogue import FIXED, Swims
from natatio.schemas import CURATED
from natatio.sources import lake, raw
from natatio.streaming import curate_stream

DIR = "/root/testdata/sf0.001"


@pytest.fixture
def fresh(spark, monkeypatch, tmp_path):
    """A shared folder of this test's own, in which nothing is stored yet."""
    monkeypatch.setattr(fixture, "_STORED", {})
    number = iter(range(1000))
    for module in (fixture, lake):
        monkeypatch.setattr(module, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{next(number)}")
    return str(tmp_path)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_age_ranks_are_shuffled_once(spark, fresh):
    """rows that don't count aren't shuffled, the others once for both windows."""
    rows = Swims(spark, DIR).legacy.select("meet_id", "number", "gender", "season", "birth_year", "relay_count", "rank", "name", "points", "result_id")
    assert plan(agegroups.age_group_rank(rows)).count("Exchange hashpartitioning") == plan(rows).count("Exchange hashpartitioning") + 1


def test_a_write_leaves_no_shuffle_behind(spark, fresh):
    """what the zone's tables have shuffled is gone when they are written."""
    at = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: sum(files.apply(k).length() for files in [at.getAllFiles()] for k in range(files.size()))
    before = held()
    Swims(spark, DIR).zone("obt_result")
    assert held() < before + 50_000  # counts of a few rows


def test_views_write_the_tables_that_they_read(spark, fresh):
    """F10 to F16: a view of results needs no laps, and laps of the derived swims aren't stored at all."""
    catalogue.QUERIES["results_base"](spark, DIR)
    assert [os.path.basename(p) for p in glob.glob(f"{fresh}/derived-*/zone/*") if "_manifests" not in p] == ["obt_result"]
    assert not glob.glob(f"{fresh}/derived-*/fx_splits")
    catalogue.QUERIES["pacing"](spark, DIR)
    assert {os.path.basename(p) for p in glob.glob(f"{fresh}/derived-*/zone/*")} == {"_manifests", "obt_result", "fact_split"}


def test_packed_raw_files_are_read_as_plain_ones(spark, tmp_path):
    """lines of files packed by gzip, with their places, and the three files of a scrape."""
    x = Swims(spark, DIR)
    for name, packed in (("plain", False), ("packed", True)):
        catalogue._write_raw(x, f"{tmp_path}/{name}", scrape="1", packed=packed)
    size = lambda name: sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/{name}/meet=*/scrape=1/*.jsonl*"))
    assert size("packed") * 3 < size("plain")
    rows = lambda name: sorted((r.meet_id, r.scrape, r.file, r.line_no, r.line) for r in raw.numbered(raw.raw_lines(spark, f"{tmp_path}/{name}")).collect())
    assert rows("packed") == rows("plain") and len(rows("plain")) > 6000
    files = lambda name: sorted((r.meet_id, r.scrape, r.file) for r in raw.raw_files(spark, f"{tmp_path}/{name}").collect())
    assert files("packed") == files("plain")


def test_what_a_run_has_parsed_is_deleted(spark, fresh):
    """F2 to F5, F7: only what tells of meets set aside stays beside the zone."""
    catalogue.QUERIES["curate_counts"](spark, DIR)
    assert glob.glob(f"{fresh}/parsed-*/latest") and not [p for kind in raw.KINDS for p in glob.glob(f"{fresh}/parsed-*/{kind}")]


def test_curated_raw_files_are_deleted(spark, fresh):
    """F8: the stream's raw files and parsed rows are gone when its zone is read."""
    assert catalogue.QUERIES["curate_stream"](spark, DIR).count() == 6000
    assert glob.glob(f"{fresh}/stream-*/lake/obt_result") and not glob.glob(f"{fresh}/stream-*/raw") and not glob.glob(f"{fresh}/stream-*/raw-parts*/*/*/part-*")


def test_blocks_are_bounded(spark, fresh, monkeypatch):
    """files are read in about so many blocks, however large they are; the order is that of the lines."""
    monkeypatch.setattr(catalogue, "BLOCKS", 20)
    parts, read = [], raw.raw_lines
    monkeypatch.setattr(raw, "raw_lines", lambda *a: parts.append(read(*a)) or parts[-1])
    got = catalogue.QUERIES["raw_line_order"](spark, DIR)
    assert parts[0].rdd.getNumPartitions() <= 60
    lines = sorted((r.meet_id, r.line_no) for r in got.collect())
    assert len(lines) == len(set(lines)) == 6000 and all(b[0] != a[0] and b[1] == 1 or b[1] == a[1] + 1 for a, b in zip(lines, lines[1:]))
