"""Questions about raw files and the meet registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "Europe/Copenhagen"
#: Hours after a meet's end until it is looked at and until it is taken as it is; and attempts after which a failed meet rests.
GRACE, DEADLINE, ATTEMPTS, STALE = 6, 72, 3, 6


def raw_completeness(lines: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per meet, from its files' lines ``(meet_id, file, line, pos)``: races and results, whether all three files are there with a record of the meet, and then the meet's name.

    The name is that of the first record, empty if it has none. A file without a byte has no lines; with ``files`` (``meet_id, file``) it counts as there.
    """
    text = F.length(F.trim("line")) > 0
    info = (F.col("file") == "meet_info") & text
    n = lambda file, ok=F.lit(True): F.count_if((F.col("file") == file) & ok)  # noqa: E731,B008
    first = F.min_by(F.col("line"), F.col("pos")).alias("first")
    rows = lines.groupBy("meet_id").agg(n("meet_info", text).alias("info"), n("races").alias("race_files"), n("results").alias("result_files"), n("races", text).alias("races"), n("results", text).alias("results"))
    rows = rows.join(lines.where(info).groupBy("meet_id").agg(first), "meet_id", "left")
    there = (F.col("race_files") > 0) & (F.col("result_files") > 0)
    if files is not None:
        rows = files.groupBy("meet_id").agg((F.countDistinct("file") == 3).alias("all_files")).join(rows, "meet_id", "left")
        there = F.col("all_files")
    complete = there & (F.coalesce("info", F.lit(0)) > 0)
    name = F.when(complete, F.coalesce(F.get_json_object("first", "$.meet"), F.lit("")))
    return rows.select("meet_id", name.alias("meet_name"), F.coalesce("races", F.lit(0)).cast("bigint").alias("races"), F.coalesce("results", F.lit(0)).cast("bigint").alias("results"), complete.alias("complete"))


def due_meets(registry: DataFrame, now: Column) -> DataFrame:
    """Registered meets with ``action``: skip, check or deadline.

    Hours are counted on the wall clock from 23:59 of the last day, then turned to UTC; ``now`` is UTC. Meets that failed
    ``ATTEMPTS`` times, and those that aren't waiting or failed, are left out.
    """
    open_ = registry.where((F.col("status") == "pending") | ((F.col("status") == "failed") & (F.coalesce("attempts", F.lit(0)) < ATTEMPTS)))
    after = lambda hours, default: F.to_utc_timestamp(F.timestamp_seconds(F.unix_timestamp(F.col("end_date").cast("timestamp")) + 86340 + 3600 * F.coalesce(F.col(hours), F.lit(default))), ZONE)
    rows = open_.withColumns({"scrape_after": after("grace_hours", GRACE), "deadline": after("deadline_hours", DEADLINE)})
    return rows.withColumn("action", F.when(now < F.col("scrape_after"), "skip").when(now < F.col("deadline"), "check").otherwise("deadline"))


def stale_claims(registry: DataFrame, completeness: DataFrame, now: Column) -> DataFrame:
    """Claims of ``STALE`` hours or without a time: reconciled if the raw files are complete, else reclaimed."""
    old = F.col("claimed_at").isNull() | (F.col("claimed_at") <= now - F.expr(f"interval {STALE} hours"))
    found = registry.where((F.col("status") == "scraping") & old).join(completeness.select("meet_id", "complete"), "meet_id", "left")
    return found.select("meet_id", "claimed_at", F.when(F.coalesce("complete", F.lit(False)), "reconciled").otherwise("reclaimed").alias("outcome"))
