"""Change indices: observed against the baseline, one lazy plan each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import timefn
from roadpulse.operators import filters, tci
from roadpulse.sources import calendars

# Fixed value: first observed day after the baseline week.
START = "2020-03-09"
LABELS = ("region_name", "country_name", "country_iso_code", "country_partner_code", "region_type", "population", "timezone")


def _updated(as_of: str | dt.datetime | None) -> Column:
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return stamp.alias("last_updated_utc")


def labels(meta: DataFrame) -> DataFrame:
    """Region dimension under the names of the published tables."""
    names = {"country_name_eng": "country_name", "country_iso": "country_iso_code", "partner_code": "country_partner_code"}
    meta = meta.drop("country_name") if "country_name_eng" in meta.columns else meta
    return meta.withColumnsRenamed(names)


def _change(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, (F.col("ratio_20") - 1) * 100)


def daily_index(
    daily: DataFrame,
    base: DataFrame,
    meta: DataFrame,
    start: str | None = START,
    exceptions: Sequence[str] = (),
    as_of: str | None = None,
) -> DataFrame:
    """Daily intensity against the mean of the same day of week in the baseline."""
    days = daily if start is None else filters.on_or_after(daily, start)
    obs = tci.observed(days, ["region_slug", "year", "month", "dow", "day"])
    expected = tci.baseline_mean(base, ["region_slug", "dow"], ["month", "day"])
    ratios = _change(tci.with_baseline(obs, expected, ["region_slug", "dow"]), "tcp")
    regions = filters.approved(labels(meta), "daily_approved", exceptions)
    return ratios.join(regions, "region_slug").select(
        _updated(as_of), "region_slug", *LABELS, "year", "month", "day", "dow",
        "observed", "expected_2020", "ratio_20", "tcp", "dashboard", "region_shapefile_wkt",
    )


def weekly_index(
    daily: DataFrame,
    base: DataFrame,
    meta: DataFrame,
    start: str | None = START,
    exceptions: Sequence[str] = (),
    as_of: str | None = None,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Weekly intensity against the sum of the baseline week.

    Weeks are counted over the days with reports. ``dates`` (year, month, day, dow; repeats do no harm) names them from a
    cheaper table, such as the partitions of the raw feed; without it they are taken from ``daily``, which is then read twice.
    """
    days = calendars.join_weeks(daily, calendars.weeks(daily if dates is None else dates, start))
    obs = tci.week_observed(days, ["region_slug", "week_number", "week_number_obs"])
    ratios = _change(tci.with_baseline(obs, tci.baseline_total(base), ["region_slug"]), "tcp")
    regions = filters.approved(labels(meta), "weekly_approved", exceptions)
    return ratios.join(regions, "region_slug").select(
        _updated(as_of), "region_slug", *LABELS, "week_number", "week_number_obs",
        "min_year", "min_month", "min_day", "max_year", "max_month", "max_day",
        "observed", "expected_2020", "ratio_20", "tcp", "dashboard", "region_shapefile_wkt",
    )


def hourly_index(
    daily: DataFrame, base: DataFrame, meta: DataFrame, exceptions: Sequence[str] = (), as_of: str | None = None
) -> DataFrame:
    """Hourly intensity against the same hour and day of week; the change is named ``tci``."""
    obs = tci.observed(daily, ["region_slug", "year", "month", "day", "hour", "dow"])
    expected = tci.baseline_mean(base, ["region_slug", "hour", "dow"], ["year", "month", "day"])
    ratios = _change(tci.with_baseline(obs, expected, ["region_slug", "hour", "dow"]), "tci")
    regions = filters.approved(meta, "daily_approved", exceptions).select("region_slug", "timezone")
    stamp = timefn.hour_stamp()
    return ratios.join(regions, "region_slug").select(
        _updated(as_of), "region_slug", "timezone",
        timefn.local_stamp(stamp, F.col("timezone")).alias("timestamp_timezone"),
        stamp.alias("timestamp"), "observed", "tci",
    )


def hour_group_index(
    daily: DataFrame,
    base: DataFrame,
    meta: DataFrame,
    exceptions: Sequence[str] = (),
    as_of: str | None = None,
    with_year: bool = False,
) -> DataFrame:
    """Intensity per fixed hour group against the baseline of the same group and day of week."""
    chunk = timefn.hour_chunk(F.col("hour"))
    obs = tci.observed(
        daily.withColumn("hour_chunk", chunk), ["region_slug", "year", "month", "day", "dow", "hour_chunk"]
    )
    expected = tci.baseline_mean(
        base.withColumn("hour_chunk", chunk), ["region_slug", "hour_chunk", "dow"], ["year", "month", "day"]
    )
    ratios = _change(tci.with_baseline(obs, expected, ["region_slug", "hour_chunk", "dow"]), "tci")
    regions = filters.approved(labels(meta), "daily_approved", exceptions).select("region_slug", *LABELS)
    year = ["year"] if with_year else []
    return ratios.join(regions, "region_slug").select(
        _updated(as_of), "region_slug", *LABELS, *year, "month", "dow", "day", "hour_chunk",
        "expected_2020", "ratio_20", "observed", "tci",
    )


def _cell_change(df: DataFrame) -> DataFrame:
    change = (F.try_divide(F.col("tci").cast("double"), F.col("expected_2020").cast("double")) - 1) * 100
    return df.withColumn("tci_perc_change", change)


def cities_daily(grid: DataFrame, base: DataFrame) -> DataFrame:
    """Per cell and day against the same day of week."""
    cell = ["region_slug", "grid_id"]
    obs = tci.observed(grid, [*cell, "month", "day", "dow"], name="tci")
    expected = tci.baseline_mean(base, [*cell, "dow"], ["month", "day"])
    return _cell_change(obs.join(expected, [*cell, "dow"])).select(
        *cell, "month", "day", "dow", "tci", "expected_2020", "tci_perc_change"
    )


def cities_weekly(grid: DataFrame, base: DataFrame) -> DataFrame:
    """Per cell and ISO week (years merged) against one typical week."""
    cell = ["region_slug", "grid_id"]
    obs = tci.week_observed(
        grid.withColumn("week_number", F.weekofyear(timefn.ymd())), [*cell, "week_number"], ("month", "day"), name="tci"
    )
    return _cell_change(obs.join(tci.baseline_week(base, cell), cell)).select(
        *cell, "week_number", "min_month", "min_day", "max_month", "max_day", "tci", "expected_2020", "tci_perc_change"
    )


def _stamped(df: DataFrame, meta: DataFrame, as_of: str | None, columns: Sequence[str]) -> DataFrame:
    stamp = timefn.hour_stamp()
    zones = meta.select("region_slug", "timezone")
    return df.join(zones, "region_slug").select(
        _updated(as_of), "timezone", timefn.local_stamp(stamp, F.col("timezone")).alias("timestamp_local"),
        stamp.alias("timestamp"), *columns,
    )


def cities_hourly(grid: DataFrame, base: DataFrame, meta: DataFrame, as_of: str | None = None) -> DataFrame:
    """Row-level cell hours against the plain mean of the same hour and day of week."""
    keys = ["region_slug", "grid_id", "hour", "dow"]
    ratios = _cell_change(grid.join(tci.baseline_raw_mean(base, keys), keys))
    columns = ["region_slug", "grid_id", "month", "day", "hour", "dow", "tci", "expected_2020", "tci_perc_change"]
    return _stamped(ratios, meta, as_of, columns)


def grid_hourly(grid: DataFrame, meta: DataFrame, as_of: str | None = None) -> DataFrame:
    """Cell hours with timestamps, partition columns (region, year) last."""
    columns = ["grid_id", "month", "day", "hour", "dow", "tci", "region_slug", "year"]
    return _stamped(grid, meta, as_of, columns)


def simple_tci(
    jams: DataFrame, current: tuple[str, str], baseline: tuple[str, str], region_name: str, ts: str = "ts"
) -> DataFrame:
    """Partner recipe for one polygon's jams: daily sums against the sum of the same day of week."""
    open_road = filters.not_blocked_level(jams)
    date = F.to_date(ts)
    days = (
        filters.between_dates(open_road, *current, date=date)
        .groupBy(date.alias("date"))
        .agg(F.sum("length").alias("tci_current"))
        .withColumn("dow", timefn.iso_dow(F.col("date")))
    )
    expected = (
        filters.between_dates(open_road, *baseline, date=date)
        .groupBy(timefn.iso_dow(date).alias("dow"))
        .agg(F.sum("length").alias("tci_baseline"))
    )
    change = (F.try_divide("tci_current", "tci_baseline") - 1) * 100
    return days.join(expected, "dow").select(F.lit(region_name).alias("region_name"), "date", change.alias("tci_index"))


def hour_chunk_local(
    hourly: DataFrame,
    regions: DataFrame,
    baseline: tuple[str, str],
    cuts: Sequence[int] = (5, 10, 16, 22),
    ts: str = "ts",
    value: str = "tci",
) -> DataFrame:
    """Local-time hour groups per date over the baseline of the same region, group and day of week."""
    local = hourly.join(regions.where(F.col("timezone").isNotNull()).select("region_slug", "timezone"), "region_slug")
    zone = F.col("timezone")
    groups = local.groupBy(
        "region_slug",
        F.to_date(F.from_utc_timestamp(F.col(ts), zone)).alias("date"),
        timefn.local_chunk(F.col(ts), zone, cuts).alias("hour_chunk"),
    ).agg(F.sum(value).alias("observed"))
    groups = groups.withColumn("dow", timefn.iso_dow(F.col("date")))
    in_base = F.col("date").between(*[F.lit(d).cast("date") for d in baseline])
    expected = (
        groups.where(in_base).groupBy("region_slug", "hour_chunk", "dow").agg(F.avg("observed").alias("expected"))
    )
    joined = groups.join(expected, ["region_slug", "hour_chunk", "dow"])
    return joined.withColumn("ratio", F.try_divide(F.col("observed").cast("double"), F.col("expected").cast("double")))


def city_index(
    daily: DataFrame, holidays: DataFrame, baseline: tuple[str, str], city: str = "region_slug", value: str = "tci"
) -> DataFrame:
    """Holiday-free daily sums in percent of the expected week; days without expectation stay."""
    working = filters.drop_holidays(daily, holidays, [city, "date"])
    sums = working.groupBy(city, "date").agg(F.sum(value).alias("tci")).withColumn("dow", timefn.iso_dow(F.col("date")))
    in_base = F.col("date").between(*[F.lit(d).cast("date") for d in baseline])
    expected = sums.where(in_base).groupBy(city, "dow").agg(F.sum("tci").alias("expected"))
    joined = sums.join(expected, [city, "dow"], "left")
    return joined.withColumn("index", F.try_divide(F.col("tci").cast("double"), F.col("expected").cast("double")) * 100)
