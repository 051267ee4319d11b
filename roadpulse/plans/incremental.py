"""Incremental fill: find missing (region, day) pairs, compute only those, replace those partitions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from roadpulse.functions.timefn import monday_week, ymd
from roadpulse.operators import filters, spatial, tci
from roadpulse.operators.sampling import weeks_per_month
from roadpulse.operators.spatial import Quad
from roadpulse.plans import lines
from roadpulse.session import broadcast_if_small, cut
from roadpulse.sources import calendars, io

KEY = "region_slug"
MAX_PAIRS = 2_000_000
MONTH_FROM, WEEK_FROM = 30, 7  # fixed values: missing days from which slices are months, weeks


def dates(spark: SparkSession, start: str | dt.date, end: str | dt.date = "today", sampled: bool = False, seed: int = 1234) -> DataFrame:
    """Every day of an interval, or its sampled weeks."""
    days = calendars.dates(spark, start, end)
    return weeks_per_month(days, seed).select("date") if sampled else days


def existing(table: DataFrame) -> DataFrame:
    """(region, date) pairs already present."""
    return table.select(KEY, ymd().alias("date")).distinct()


def remaining(regions: DataFrame, days: DataFrame, present: DataFrame) -> DataFrame:
    """Missing pairs. The days (a calendar) are carried as one array into each region row."""
    calendar = days.agg(F.collect_set("date")).scalar()
    wanted = regions.select(KEY).distinct().select(KEY, F.explode(calendar).alias("date"))
    return wanted.join(present, [KEY, "date"], "left_anti")


def slices(missing: DataFrame) -> DataFrame:
    """Per region: months if many days are missing, Monday weeks if some, else single days.

    One row per (region, slice) with the days as a ``|`` list.
    """
    count = F.count(F.lit(1)).over(Window.partitionBy(KEY))
    d = F.col("date")
    month = F.date_format(d, "'year'yyyy'month'MM")
    week = F.concat(F.date_format(d, "'year'yyyy'week'"), F.lpad(monday_week(d).cast("string"), 2, "0"))
    day = F.date_format(d, "'year'yyyy'month'MM'day'dd")
    slug = F.when(count >= MONTH_FROM, month).when(count >= WEEK_FROM, week).otherwise(day)
    days = F.array_join(F.array_sort(F.collect_list(F.date_format("date", "yyyyMMdd"))), "|")
    return missing.withColumn("date_slug", slug).groupBy(KEY, "date_slug").agg(days.alias("date_filter"))


def select_regions(
    meta: DataFrame, selected: Sequence[str] | None = None, done: DataFrame | None = None, exceptions: Sequence[str] = ()
) -> DataFrame:
    """Chosen regions, or those whose shape has no results yet."""
    if selected:
        return meta.where(F.col(KEY).isin(list(selected)))
    return meta if done is None else filters.skip_done(meta, done, exceptions=exceptions)


def segment_hours(
    jams: DataFrame, regions: DataFrame, pairs: DataFrame | None = None, ts: str = "ts", minutes: int = 5, grid: Quad = Quad(),
    resolution: int = 12, rules: Sequence[str] = filters.QUALITY, lines_path: str | None = None,
) -> DataFrame:
    """Raw jams to hourly intensity per region: quality, regions by shape, dedup, hourly sums.

    ``pairs`` restricts to (region, date). With ``lines_path``, the regions of a line come from the table of lines kept
    there, and only lines that it does not know are tested and entered.
    """
    good = filters.quality(jams, rules)
    options = {"grid": grid, "resolution": resolution}
    known = lines.update(jams.sparkSession, lines_path, good, regions, **options) if lines_path else None
    matched = spatial.join_polygons(good, regions, pairs=known, **options)
    if pairs is not None:
        wanted = broadcast_if_small(pairs.select(KEY, F.col("date").alias("_date")), MAX_PAIRS)
        on = (matched[KEY] == wanted[KEY]) & (F.to_date(matched[ts]) == wanted["_date"])
        matched = matched.join(wanted, on, "left_semi")
    return tci.segment_hour(tci.dedup_slot(matched, ts=ts, minutes=minutes), ts)


PAIRS = f"{KEY} string, date date"


def _pairs_of(spark: SparkSession, path: str, fmt: str, pairs: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``pairs`` of a stored table, none before it is first written."""
    try:
        return pairs(spark.read.format(fmt).load(path))
    except AnalysisException:
        return spark.createDataFrame([], PAIRS)


def ledger(path: str) -> str:
    """Where the filled pairs of a table are kept: days without a jam leave no row in the table itself."""
    return f"{path.rstrip('/')}_filled"


def filled(spark: SparkSession, path: str, fmt: str = "orc") -> DataFrame:
    """(region, date) pairs of a table that are filled, with rows or without."""
    stored = _pairs_of(spark, path, fmt, existing)
    return stored.unionByName(_pairs_of(spark, ledger(path), "parquet", lambda df: df.select(KEY, "date"))).distinct()


def fill(
    spark: SparkSession, jams: DataFrame, regions: DataFrame, days: DataFrame, path: str, ts: str = "ts", fmt: str = "orc", **options
) -> DataFrame:
    """Compute the missing (region, day) pairs only and write them; returns the pairs.

    The table is partitioned by region, year, month and day, so a repeated or interrupted fill replaces
    whole days and never doubles them. The raw scan is limited to the missing days and their
    neighbours, as a report near midnight may be stored under the day next to its own. Pairs are
    entered in the ledger after their rows are written.
    """
    missing = cut(remaining(regions, days, filled(spark, path, fmt)))
    near = missing.select(F.explode(F.array(*[F.date_add("date", n) for n in (-1, 0, 1)])).alias("date")).distinct()
    wanted = [r["d"] for r in near.select(F.date_format("date", "yyyyMMdd").alias("d")).collect()]  # a calendar
    if wanted:
        new = segment_hours(io.on_days(jams, wanted), regions, missing, ts, **options)
        io.fill_partitions(new, path, [KEY, "year", "month", "day"], fmt)
        missing.write.mode("append").parquet(ledger(path))
    return missing
