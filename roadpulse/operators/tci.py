"""Congestion intensity: slot dedup, hourly roll-up, observed sums and baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import timefn
from roadpulse.operators import filters, ranks

REGION = "region_slug"


def dedup_slot(
    jams: DataFrame,
    id_col: str = "uuid",
    ts: str = "ts",
    minutes: int = timefn.FEED_MINUTES,
    reference: str = timefn.REFERENCE,
    within: Sequence[str] = (REGION,),
    ties: Sequence[str] = ("length", "line"),
) -> DataFrame:
    """First report per id, day and feed slot.

    A minimum over (time, ties, rest) instead of a ranking window: copies are combined before the
    shuffle, so an id holding a large part of the rows never reaches one task whole. Equal times
    are settled by ``ties`` and then by the other columns.
    """
    keys = [*within, id_col]
    rest = [c for c in jams.columns if c not in {*keys, ts, *ties}]
    row = F.struct(ts, *ties, *rest)
    first = jams.groupBy(
        *keys, F.to_date(ts).alias("_day"), timefn.slot(F.col(ts), minutes, reference).alias("_slot")
    ).agg(F.min(row).alias("_row"))
    return first.select(*keys, "_row.*")


def whole(total: Column) -> Column:
    """A length total as a whole number, halves up; float noise is removed first."""
    return F.round(F.round(total, 6)).cast("bigint")


def segment_hour(dedup: DataFrame, ts: str = "ts", within: Sequence[str] = (REGION,)) -> DataFrame:
    """Sum of length per hour and polyline."""
    return dedup.groupBy(*within, *timefn.parts(F.col(ts)), "line").agg(whole(F.sum("length")).alias("tci"))


def analysis_daily(dedup: DataFrame, ts: str = "ts", within: Sequence[str] = (REGION,)) -> DataFrame:
    """Sum of length per day."""
    date = F.col(ts)
    return dedup.groupBy(
        *within,
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        timefn.iso_dow(date).alias("dow"),
        F.dayofmonth(date).alias("day"),
    ).agg(F.sum("length").alias("sum_length"))


def observed(df: DataFrame, keys: Sequence[str], value: str = "tci", name: str = "observed") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def baseline_mean(
    base: DataFrame, keys: Sequence[str], days: Sequence[str], value: str = "tci", name: str = "expected_2020"
) -> DataFrame:
    """Mean of the daily sums: sum per (keys, days), then average per keys."""
    daily = base.groupBy(*keys, *days).agg(F.sum(value).alias("_sum"))
    return daily.groupBy(*keys).agg(F.avg("_sum").alias(name))


def baseline_total(base: DataFrame, keys: Sequence[str] = (REGION,), value: str = "tci") -> DataFrame:
    """Sum of all baseline days."""
    return base.groupBy(*keys).agg(F.sum(value).alias("expected_2020"))


def baseline_week(base: DataFrame, keys: Sequence[str], value: str = "tci") -> DataFrame:
    """One typical week: mean daily sum per day of week, added over the days."""
    typical = baseline_mean(base, [*keys, "dow"], ["month", "day"], value)
    return typical.groupBy(*keys).agg(F.sum("expected_2020").alias("expected_2020"))


def baseline_raw_mean(base: DataFrame, keys: Sequence[str], value: str = "tci") -> DataFrame:
    return base.groupBy(*keys).agg(F.avg(value).alias("expected_2020"))


def baseline_median(df: DataFrame, keys: Sequence[str], value: str = "tci") -> DataFrame:
    """Exact median of the rows of each key; a key with a third of all rows is counted in many tasks."""
    return ranks.grouped_quantiles(df, keys, value, {"expected": 0.5})


def week_observed(
    df: DataFrame, keys: Sequence[str], parts: Sequence[str] = ("year", "month", "day"), value: str = "tci", name: str = "observed"
) -> DataFrame:
    """Weekly sum with the first and last day by day of week.

    Rows are first summed per day, which bounds the row count entering the week step; days with
    the same day of week (merged years) are settled by date.
    """
    daily = df.groupBy(*keys, "year", "month", "day", "dow").agg(F.sum(value).alias("_sum"))
    rank = F.struct("dow", "year", "month", "day")
    edges = [F.min_by(p, rank).alias(f"min_{p}") for p in parts]
    edges += [F.max_by(p, rank).alias(f"max_{p}") for p in parts]
    return daily.groupBy(*keys).agg(*edges, F.sum("_sum").alias(name))


def with_baseline(obs: DataFrame, base: DataFrame, keys: Sequence[str], name: str = "observed") -> DataFrame:
    """Observed joined to expected; ``ratio_20`` is null where expected is zero.

    Both sides are aggregates. No hint: the adaptive planner broadcasts the baseline when its
    measured size allows and otherwise joins by shuffle.
    """
    ratio = F.try_divide(F.col(name).cast("double"), F.col("expected_2020").cast("double"))
    return obs.join(base, list(keys)).withColumn("ratio_20", ratio)


def share_of_parent(df: DataFrame, parent: str, children: Sequence[str], by: Sequence[str], value: str = "tci") -> DataFrame:
    """Children's sum over the parent's, per day."""
    own = F.sum(F.when(F.col(REGION) == parent, F.col(value)))
    below = F.sum(F.when(F.col(REGION).isin(list(children)), F.col(value)))
    sums = df.where(F.col(REGION).isin([parent, *children])).groupBy(*by).agg(own.alias("parent"), below.alias("children"))
    return sums.withColumn("share", F.try_divide(F.col("children").cast("double"), F.col("parent").cast("double")))


def resample_day(df: DataFrame, ts: str, entity: str, entities: Sequence[str], value: str = "tci") -> DataFrame:
    """Sum per calendar day, one column per entity."""
    return (
        df.groupBy(F.to_date(ts).alias("date")).pivot(entity, list(entities)).agg(F.sum(value))
    )


def year_adjust(
    df: DataFrame, first: int, second: int, by: Sequence[str], value: str = "tci", unit: str = "hour", n: int = 24
) -> DataFrame:
    """Mean daily value of complete days (``n`` distinct units) in two years: ratio and difference."""

    def of(year: int, name: str) -> DataFrame:
        full = filters.complete_days(df.where(F.col("year") == year), [*by, "year", "month", "day"], unit, n)
        daily = full.groupBy(*by, "year", "month", "day").agg(F.sum(value).alias("_sum"))
        return daily.groupBy(*by).agg(F.avg("_sum").alias(name))

    joined = of(first, "mean_first").join(of(second, "mean_second"), list(by))
    return joined.withColumn("ratio", F.try_divide("mean_second", "mean_first")).withColumn(
        "difference", F.col("mean_second") - F.col("mean_first")
    )


def ratio_of_sums(df: DataFrame, keys: Sequence[str], value: str = "tci", expected: str = "expected_2020") -> DataFrame:
    """Percent change of summed values against summed expectations."""
    sums = df.groupBy(*keys).agg(F.sum(value).cast("double").alias("_v"), F.sum(expected).cast("double").alias("_e"))
    return sums.select(*keys, ((F.try_divide("_v", "_e") - 1) * 100).alias("tci_perc_change"))
