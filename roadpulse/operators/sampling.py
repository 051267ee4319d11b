"""Seeded samples of days. Order comes from the MD5 of seed and day, so a retry gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.timefn import iso_dow

# Inputs are distinct calendar days, a few thousand rows at most.


def _draw(seed: int, *columns: str) -> list[Column]:
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    return [F.md5(text.cast("binary")), *[F.col(c) for c in columns]]


def random_days(df: DataFrame, n: int, seed: int = 1234, day: str = "datetime") -> DataFrame:
    """n distinct days."""
    return df.select(day).distinct().orderBy(*_draw(seed, day)).limit(n)


def weeks_per_month(days: DataFrame, seed: int = 1234, date: str = "date") -> DataFrame:
    """All days of the full ISO weeks that hold one drawn day per month.

    ``days`` is the interval, one row per date.
    """
    d = F.col(date)
    week = F.date_trunc("week", d).cast("date")
    full = days.groupBy(week.alias("week")).agg(F.count(F.lit(1)).alias("n")).where("n = 7").select("week")
    inside = days.select(d.alias("date"), week.alias("week"), F.date_trunc("month", d).cast("date").alias("month")).join(
        full, "week"
    )
    drawn = inside.groupBy("month").agg(F.min_by("week", F.struct(*_draw(seed, "date"))).alias("week"))
    picked = inside.join(drawn.select("week").distinct(), "week", "left_semi")
    return picked.select("date", F.date_format("date", "yyyyMMdd").alias("datetime"))


def balanced_weekdays(days: DataFrame, n: int = 50, seed: int = 1234, date: str = "date") -> DataFrame:
    """One weekday of each of n drawn weeks, each weekday equally often.

    Weekends and 15 December to 15 January are left out, and weeks need all five days.
    """
    d = F.col(date)
    holiday = ((F.month(d) == 1) & (F.dayofmonth(d) <= 15)) | ((F.month(d) == 12) & (F.dayofmonth(d) >= 15))
    working = days.where((F.weekday(d) < 5) & ~holiday).select(
        d.alias("date"), iso_dow(d).alias("dow"), F.date_trunc("week", d).cast("date").alias("week")
    )
    weeks = working.groupBy("week").agg(F.count(F.lit(1)).alias("n")).where("n = 5")
    rank = F.row_number().over(Window.orderBy(*_draw(seed, "week"))) - 1
    drawn = weeks.withColumn("rank", rank).where(F.col("rank") < n)
    chosen = drawn.select("week", (F.col("rank") % 5 + 1).alias("dow"))
    return working.join(chosen, ["week", "dow"]).select("date", "dow", "week")
