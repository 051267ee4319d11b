"""Variation statistics, quantile profiles, trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.timefn import ymd
from roadpulse.operators import filters, ranks


def _variation(value: Column, prefix: str, suffix: str = "", divisor: Column | None = None) -> list[Column]:
    mean, std = F.avg(value), F.stddev_pop(value)
    return [
        mean.alias(f"{prefix}_mean{suffix}"),
        std.alias(f"{prefix}_std{suffix}"),
        F.try_divide(std, mean if divisor is None else divisor).alias(f"{prefix}_coef_var{suffix}"),
    ]


def daily_variation(df: DataFrame, key: str = "region_slug", value: str = "sum_length", compat: bool = False) -> DataFrame:
    """Days, mean, population deviation and coefficient of variation; also by weekend and weekday.

    ``compat`` divides the weekday deviation by the weekend mean, as published tables did.
    """
    v = F.col(value)
    weekend = F.when(F.col("dow").isin(6, 7), v)
    weekday = F.when(~F.col("dow").isin(6, 7), v)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_days"),
        *_variation(v, "daily"),
        *_variation(weekend, "daily", "_weekend"),
        *_variation(weekday, "daily", "_weekday", F.avg(weekend) if compat else None),
    )


def weekly_variation(df: DataFrame, key: str = "region_slug", value: str = "sum_length") -> DataFrame:
    """Sum per ISO week number (years merged), then mean, deviation and variation per region."""
    weeks = df.groupBy(key, F.weekofyear(ymd()).alias("_week")).agg(F.sum(value).alias("_sum"))
    return weeks.groupBy(key).agg(*_variation(F.col("_sum"), "weekly"))


def grid_variation(df: DataFrame, unit: str, key: str = "grid_id", value: str = "tci", full_weeks: bool = True) -> DataFrame:
    """Variation per cell: by day of month, or by the mean day of full ISO weeks."""
    if unit == "daily":
        sums = df.groupBy(key, "day").agg(F.sum(value).alias("_v"))
        return sums.groupBy(key).agg(*_variation(F.col("_v"), "daily"))
    days = df.groupBy(key, F.weekofyear(ymd()).alias("_week"), "day").agg(F.sum(value).alias("_d"))
    weeks = days.groupBy(key, "_week").agg(F.avg("_d").alias("_v"), F.count(F.lit(1)).alias("_n"))
    if full_weeks:
        weeks = weeks.where("_n = 7")
    return weeks.groupBy(key).agg(*_variation(F.col("_v"), "weekly"))


def simple_variation(jams: DataFrame, ts: str = "ts") -> DataFrame:
    """Mean, deviation and variation of the daily totals of one polygon, blocked roads left out."""
    days = filters.not_blocked_level(jams).groupBy(F.to_date(ts).alias("date")).agg(F.sum("length").alias("tci"))
    mean, std = F.avg("tci"), F.stddev_pop("tci")
    return days.agg(
        mean.alias("avg_tci"), std.alias("std_tci"), F.try_divide(std, mean).alias("coef_variation_tci")
    )


# Names and levels of the quantile profile.
QUANTILES = {
    "q10": 0.1, "q20": 0.2, "q30": 0.3, "q40": 0.4, "q50": 0.5, "q60": 0.6, "q70": 0.7, "q80": 0.8, "q90": 0.9,
    "q01": 0.01, "q99": 0.99, "q25": 0.25, "q75": 0.75, "q05": 0.05, "q95": 0.95,
}


def quantile_profile(df: DataFrame, key: str = "region_slug", value: str = "observed", accuracy: int | None = None) -> DataFrame:
    """Mean, variances and quantiles of a daily series per region.

    The input has one row per region and day, so exact quantiles hold a few thousand values per
    region. For row-level input pass ``accuracy`` (sketch with error 1/accuracy).
    """
    levels = list(QUANTILES.values())
    quantiles = (
        F.percentile(value, F.array(*[F.lit(q) for q in levels]))
        if accuracy is None
        else F.percentile_approx(value, levels, accuracy)
    )
    out = df.groupBy(key).agg(
        F.avg(value).alias("mean"), F.var_pop(value).alias("var_p"), F.var_samp(value).alias("var_s"), quantiles.alias("_q")
    )
    return out.select(key, "mean", "var_p", "var_s", *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(QUANTILES)])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column, all columns in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.column", "p.v")
    moments = long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max")
    )
    quartiles = ranks.grouped_quantiles(long, ["column"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(quartiles, "column").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def trend(df: DataFrame, x: Column, y: Column, by: Sequence[str]) -> DataFrame:
    """Least-squares line and correlation per group."""
    return df.select(*by, x.alias("_x"), y.alias("_y")).groupBy(*by).agg(
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.corr("_x", "_y").alias("corr"),
        F.count(F.lit(1)).alias("n"),
    )


def worst_period(df: DataFrame, entity: str, period: str, value: str) -> DataFrame:
    """Period of the minimum; the earliest one on ties."""
    return df.where(F.col(value).isNotNull()).groupBy(entity).agg(
        F.min_by(period, F.struct(value, period)).alias("worst_period"), F.min(value).alias("worst_value")
    )


# -- counts -------------------------------------------------------------------------------


def line_counts(jams: DataFrame, line: str = "line") -> DataFrame:
    """Reports per distinct polyline."""
    return jams.groupBy(F.col(line).alias("line_wkt")).agg(F.count(F.lit(1)).alias("count_lines"))


def records(df: DataFrame, by: Sequence[str], id_col: str = "uuid") -> DataFrame:
    """Rows, total length and distinct ids."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("length").alias("sum_length"), F.countDistinct(id_col).alias("n_ids")
    )


def arbitrary_dedup(jams: DataFrame, ts: str = "ts", minutes: int = 5, id_col: str = "uuid") -> DataFrame:
    """Rows equal in all but time are collapsed (earliest kept), then one per id and slot, per day."""
    from roadpulse.operators import tci

    payload = [c for c in jams.columns if c != ts]
    once = jams.groupBy(*payload).agg(F.min(ts).alias(ts))
    kept = tci.dedup_slot(once, id_col, ts, minutes, within=())
    return kept.groupBy(F.to_date(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("length").alias("sum_length")
    )


def outlier_rate(df: DataFrame, by: Sequence[str], flag: str = "outlier") -> DataFrame:
    """Observations, outliers and their percentage."""
    n, bad = F.count(F.lit(1)), F.sum(F.col(flag).cast("int"))
    return df.groupBy(*by).agg(n.alias("n_obs"), bad.alias("n_out"), (bad * 100.0 / n).alias("pct_out"))
