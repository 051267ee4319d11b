"""Window features over regional series (one row per region and day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The frames below run per region over at most one row per day.


def week_cumsum(df: DataFrame, key: str = "region_slug", date: str = "date") -> DataFrame:
    """Running Monday count per region and the first date of each such week."""
    monday = F.when(F.weekday(date) == 0, 1).otherwise(0)
    run = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    weeks = df.withColumn("week", F.sum(monday).over(run))
    return weeks.withColumn("min_date", F.min(date).over(Window.partitionBy(key, "week")))


def lags(df: DataFrame, key: str = "region_slug", date: str = "date", value: str = "observed") -> DataFrame:
    """Value one row and seven rows before, one row before on the same day of week; differences."""
    run = Window.partitionBy(key).orderBy(date)
    same = Window.partitionBy(key, "dow").orderBy(date)
    v = F.col(value)
    return (
        df.withColumn(f"{value}_1day", F.lag(value, 1).over(run))
        .withColumn(f"{value}_7day", F.lag(value, 7).over(run))
        .withColumn(f"{value}_1dow", F.lag(value, 1).over(same))
        .withColumn("diff_1day", v - F.col(f"{value}_1day"))
        .withColumn("diff_7day", v - F.col(f"{value}_7day"))
    )


def rolling_column(
    value: str, n: int, by: Sequence[str], order: str, min_periods: int | None = None, fn: str = "mean"
) -> Column:
    """Trailing mean or median of n rows, nulls skipped; null below ``min_periods`` values."""
    frame = Window.partitionBy(*by).orderBy(order).rowsBetween(-(n - 1), 0)
    stat = F.avg(value) if fn == "mean" else F.percentile(value, 0.5)
    need = n if min_periods is None else min_periods
    return F.when(F.count(value).over(frame) >= need, stat.over(frame))


def rolling(
    df: DataFrame, value: str, n: int, by: Sequence[str], order: str = "date",
    min_periods: int | None = None, fn: str = "mean", name: str | None = None,
) -> DataFrame:
    return df.withColumn(name or f"{value}_roll{n}", rolling_column(value, n, by, order, min_periods, fn))


def forward_sum(
    df: DataFrame, value: str, by: Sequence[str], before: int = 0, after: int = 7, date: str = "date", name: str = "forward_sum"
) -> DataFrame:
    """Sum over the days from ``before`` up to, not including, ``after``."""
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*by).orderBy(day).rangeBetween(before, after - 1)
    return df.withColumn(name, F.sum(value).over(frame))


def normalise_first(df: DataFrame, value: str, by: Sequence[str], order: str = "date", name: str = "normalised") -> DataFrame:
    """Series divided by its first value."""
    frame = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(name, F.try_divide(F.col(value), F.first(value).over(frame)))


def double_rolling_column(value: str, left: int, right: int, by: Sequence[str], order: str) -> Column:
    """Median of the next ``right`` rows (own row included) less that of the ``left`` rows before.

    Null unless both windows are full.
    """
    base = Window.partitionBy(*by).orderBy(order)
    before, after = base.rowsBetween(-left, -1), base.rowsBetween(0, right - 1)
    full = (F.count(value).over(before) == left) & (F.count(value).over(after) == right)
    ahead = F.col(value) if right == 1 else F.percentile(value, 0.5).over(after)
    return F.when(full, ahead - F.percentile(value, 0.5).over(before))


def double_rolling_medians(df: DataFrame, value: str, windows: Sequence[int], by: Sequence[str], order: str, prefix: str) -> DataFrame:
    """``double_rolling_column`` for several window lengths n at once, as columns ``prefix + n``.

    The neighbours of a row are gathered once for the longest window; shorter ones are the nearest of them.
    """
    base, longest = Window.partitionBy(*by).orderBy(order), max(windows)
    near = F.collect_list(F.struct(F.col(value).cast("double").alias("v")))
    out = df.withColumn("_back", F.reverse(near.over(base.rowsBetween(-longest, -1))["v"])).withColumn(
        "_ahead", near.over(base.rowsBetween(0, longest - 1))["v"]
    )
    sides = [(n, s) for n in windows for s in ("_back", "_ahead")]
    out = out.withColumns({f"{s}{n}": F.sort_array(F.slice(s, 1, n)) for n, s in sides})

    def median(values: Column, n: int) -> Column:
        middle = F.get(values, F.lit(n // 2))
        middle = middle if n % 2 else F.get(values, F.lit(n // 2 - 1)) * 0.5 + middle * 0.5
        return F.when((F.size(values) == n) & F.get(values, F.lit(0)).isNotNull(), middle)

    changes = {f"{prefix}{n}": median(F.col(f"_ahead{n}"), n) - median(F.col(f"_back{n}"), n) for n in windows}
    return out.withColumns(changes).drop("_back", "_ahead", *[f"{s}{n}" for n, s in sides])


def double_rolling(
    df: DataFrame, value: str, left: int, right: int, by: Sequence[str] = ("region_slug",), order: str = "date", name: str = "change"
) -> DataFrame:
    return df.withColumn(name, double_rolling_column(value, left, right, by, order))


def interpolate_linear(
    df: DataFrame, value: str, by: Sequence[str] = ("region_slug",), order: str = "date",
    name: str | None = None, by_time: bool = False, log_scale: bool = False,
) -> DataFrame:
    """Null and negative values replaced by the straight line between neighbours.

    Leading gaps stay null, trailing ones repeat the last value. Positions are rows, or days with
    ``by_time``; ``log_scale`` interpolates log(1 + x).
    """
    w = Window.partitionBy(*by).orderBy(order)
    clean = F.when(F.col(value) >= 0, F.log1p(F.col(value)) if log_scale else F.col(value).cast("double"))
    at = F.datediff(F.col(order), F.lit("1970-01-01").cast("date")) if by_time else F.row_number().over(w)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    out = df.withColumn("_v", clean).withColumn("_at", at).withColumn("_known", F.when(F.col("_v").isNotNull(), F.col("_at")))
    out = (
        out.withColumn("_v0", F.last("_v", ignorenulls=True).over(back))
        .withColumn("_p0", F.last("_known", ignorenulls=True).over(back))
        .withColumn("_v1", F.first("_v", ignorenulls=True).over(ahead))
        .withColumn("_p1", F.first("_known", ignorenulls=True).over(ahead))
    )
    share = (F.col("_at") - F.col("_p0")) / F.nullif(F.col("_p1") - F.col("_p0"), F.lit(0))
    line = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * share
    filled = F.coalesce("_v", line, F.col("_v0"))
    return out.withColumn(name or value, F.expm1(filled) if log_scale else filled).drop(
        "_v", "_at", "_known", "_v0", "_p0", "_v1", "_p1"
    )
