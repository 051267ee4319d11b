"""Calendars: year tables, date ranges, week numbering, padding."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.functions.timefn import iso_dow, ymd


def expand_days(bounds: DataFrame, first: str, last: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per day between two date columns, both included."""
    return bounds.select(*keep, F.explode(F.sequence(F.col(first), F.col(last))).alias("date"))


def day_columns(df: DataFrame, date: str = "date") -> DataFrame:
    """year, month, day, dow and an empty length for each date."""
    d = F.col(date)
    return df.select(
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        iso_dow(d).alias("dow"),
        F.lit(0).alias("sum_length"),
    )


def year_table(years: DataFrame, year: str = "year", inclusive: bool = True) -> DataFrame:
    """All days of each listed year; ``inclusive=False`` leaves out 31 December."""
    last = F.make_date(F.col(year), F.lit(12), F.lit(31 if inclusive else 30))
    bounds = years.select(F.make_date(F.col(year), F.lit(1), F.lit(1)).alias("first"), last.alias("last"))
    return day_columns(expand_days(bounds, "first", "last"))


def dates(spark: SparkSession, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Every day of an interval; ``end='today'`` is the current date."""
    last = F.current_date() if end == "today" else F.lit(end).cast("date")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), last)).alias("date"))


def weeks(df: DataFrame, start: str | dt.date | None = None) -> DataFrame:
    """Distinct dates with a running count of Mondays and the ISO week.

    The window has no key, but runs over distinct dates only (a few thousand rows at most).
    """
    days = df.select("year", "month", "day", "dow").distinct().withColumn("date", ymd())
    if start is not None:
        days = days.where(F.col("date") >= F.lit(start).cast("date"))
    monday = F.when(F.col("dow") == 1, 1).otherwise(0)
    running = F.sum(monday).over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return days.select(
        "year", "month", "day", running.alias("week_number_obs"), F.weekofyear("date").alias("week_number")
    )


def join_weeks(daily: DataFrame, weeks_table: DataFrame) -> DataFrame:
    return daily.join(weeks_table, ["year", "month", "day"])


def pad_calendar(daily: DataFrame, calendar: DataFrame, key: str = "region_slug", sampled: Sequence[str] = ()) -> DataFrame:
    """Each region's days completed from a calendar.

    Missing lengths become 0, but stay null for sampled regions. A day outside the calendar keeps
    null date parts, which come from the calendar side. The left side is regions x days of the
    calendar, built by exploding the calendar into each region.
    """
    regions = daily.select(key).distinct()
    days = calendar.agg(F.collect_set(F.struct("year", "month", "day", "dow")).alias("days")).scalar()
    full = regions.select(key, F.explode(days).alias("b"))
    b = F.col("b")
    full = full.select(F.col(key).alias("_key"), *[b[c].alias(f"_{c}") for c in ("year", "month", "dow", "day")])
    on = (
        (F.col("_key") == F.col(key))
        & (F.col("_year") == F.col("year"))
        & (F.col("_month") == F.col("month"))
        & (F.col("_day") == F.col("day"))
    )
    joined = full.join(daily.select(key, "year", "month", "day", "sum_length"), on, "full")
    region = F.coalesce("_key", key)
    length = F.coalesce("sum_length", F.lit(0.0))
    if sampled:
        length = F.when(region.isin(list(sampled)), F.col("sum_length")).otherwise(length)
    return joined.select(
        region.alias(key),
        F.col("_year").alias("year"),
        F.col("_month").alias("month"),
        F.col("_dow").alias("dow"),
        F.col("_day").alias("day"),
        length.alias("sum_length"),
    )


def date_texts(df: DataFrame, date: Column) -> DataFrame:
    """Dates as the ``YYYYMMDD`` keys of the raw table."""
    return df.select(F.date_format(date, "yyyyMMdd").alias("datetime"))
