"""Row filters of the pipeline."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.timefn import ymd

# The default quality rules of the raw feed.
QUALITY = ("speed >= 0", "length > 0", "blockingalertuuid is null")


def quality(df: DataFrame, rules: Sequence[str] = QUALITY) -> DataFrame:
    """All rules hold; simple comparisons reach the file scan."""
    return df.where(reduce(lambda a, b: a & b, [F.expr(r) for r in rules]))


def on_or_after(df: DataFrame, day: str | dt.date, date: Column | None = None) -> DataFrame:
    """From ``day`` on, by the year/month/day columns unless ``date`` is given."""
    return df.where((ymd() if date is None else date) >= F.lit(day).cast("date"))


def between_dates(df: DataFrame, first: str | dt.date, last: str | dt.date, date: Column | None = None) -> DataFrame:
    """Both ends included."""
    col = ymd() if date is None else date
    return df.where(col.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def regions(df: DataFrame, selected: Sequence[str] | None = None, flag: str | None = "grid", key: str = "region_slug") -> DataFrame:
    """Regions flagged 'TRUE' or chosen by name."""
    tests = []
    if flag is not None:
        tests.append(F.coalesce(F.upper(F.col(flag).cast("string")) == "TRUE", F.lit(False)))
    if selected:
        tests.append(F.col(key).isin(list(selected)))
    return df.where(reduce(lambda a, b: a | b, tests)) if tests else df


def approved(df: DataFrame, flag: str, exceptions: Sequence[str] = (), key: str = "region_slug") -> DataFrame:
    """Approved regions and listed exceptions."""
    test = F.coalesce(F.col(flag), F.lit(False))
    if exceptions:
        test = test | F.col(key).isin(list(exceptions))
    return df.where(test)


def not_blocked_level(df: DataFrame, level: int = 5) -> DataFrame:
    return df.where(F.col("level") != level)


def drop_local_hours(
    df: DataFrame, ts: Column, tz: Column, hours: Sequence[int] = (21, 22, 23, 0, 1, 2, 3, 4, 5, 6)
) -> DataFrame:
    """Drop night hours of the local clock."""
    return df.where(~F.hour(F.from_utc_timestamp(ts, tz)).isin(list(hours)))


def cap(df: DataFrame, col: str, maximum: float, how: str = "drop") -> DataFrame:
    """Keep values below ``maximum`` (drop) or lower them to it (clip)."""
    if how == "drop":
        return df.where(F.col(col) < maximum)
    if how == "clip":
        return df.withColumn(col, F.when(F.col(col) > maximum, F.lit(maximum)).otherwise(F.col(col)))
    raise ValueError("how is 'drop' or 'clip'")


def drop_holidays(df: DataFrame, holidays: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(holidays, list(on), "left_anti")


def _having(df: DataFrame, by: Sequence[str], unit: str, n: int) -> DataFrame:
    full = df.groupBy(*by).agg(F.countDistinct(unit).alias("_n")).where(F.col("_n") == n).drop("_n")
    return df.join(full, list(by), "left_semi")


def complete_days(df: DataFrame, by: Sequence[str], hour: str = "hour", n: int = 24) -> DataFrame:
    """Days on which all hours are present."""
    return _having(df, by, hour, n)


def complete_weeks(df: DataFrame, by: Sequence[str], day: str, n: int = 7) -> DataFrame:
    """Weeks with all their days."""
    return _having(df, by, day, n)


def full_panel(df: DataFrame, entity: str, time: str) -> DataFrame:
    """Entities with a row in every period that occurs."""
    periods = df.agg(F.countDistinct(time)).scalar()
    counts = df.groupBy(entity).agg(F.countDistinct(time).alias("_n"))
    full = counts.where(F.col("_n") == periods).select(entity)
    return df.join(full, entity, "left_semi")


def exclude_prefix(df: DataFrame, prefix: str, key: str = "region_slug") -> DataFrame:
    return df.where(~F.col(key).startswith(prefix))


def skip_done(
    df: DataFrame,
    done: DataFrame,
    shape: str = "region_shapefile_wkt",
    exceptions: Sequence[str] = (),
    key: str = "region_slug",
) -> DataFrame:
    """Drop regions whose shape text already has results; shapes are compared by hash and text."""
    shapes = done.select(F.col(shape).alias("_shape")).distinct()
    left = df.join(
        shapes, (F.xxhash64(df[shape]) == F.xxhash64("_shape")) & (df[shape] == F.col("_shape")), "left_anti"
    )
    return left.where(~F.col(key).isin(list(exceptions))) if exceptions else left


def in_subquery(df: DataFrame, dim: DataFrame, test: Column, on: str = "region_slug") -> DataFrame:
    """Rows whose key is among the dimension rows passing ``test``."""
    return df.join(dim.where(test).select(on), on, "left_semi")
