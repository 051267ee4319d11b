"""Cleaning of regional series: outlier votes, local regression, level shifts.

Input is the daily index, one row per region and day. All regions are treated at once; every
window is per region, so its size is the length of one series. The parameters ``c`` are the
factors on the interquartile range; they may be numbers or columns (one value per region).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators import features
from roadpulse.operators.reshape import distinct
from roadpulse.session import cut

KEY, DATE = "region_slug", "date"
# Days without votes, the search range of level shifts, the last shifted day.
BLACKOUT = (("0001-01-01", "2020-03-31"), ("2020-12-15", "2021-01-15"))
SEARCH = ("2020-03-31", "2020-12-15")
SHIFT_UNTIL = "2020-12-31"
SHIFT_WINDOWS = (14, 15, 16, 17, 18)
SHIFT_FACTORS = (0.4, 0.8, 1.0, 1.2, 1.6)
PERIOD = 7

Factor = float | Column


def _c(c: Factor) -> Column:
    return c if isinstance(c, Column) else F.lit(float(c))


def _region() -> Window:
    return Window.partitionBy(KEY)


def _ordered() -> Window:
    return Window.partitionBy(KEY).orderBy(DATE)


def validate(df: DataFrame, value: str, regular: bool = False) -> DataFrame:
    """One row per region and date; ``regular`` adds the missing days with null values."""
    once = distinct(df.select(KEY, DATE, value), [KEY, DATE], [value])
    if not regular:
        return once
    span = once.groupBy(KEY).agg(F.min(DATE).alias("_a"), F.max(DATE).alias("_b"))
    days = span.select(KEY, F.explode(F.sequence("_a", "_b")).alias(DATE))
    return days.join(once, [KEY, DATE], "left")


# -- detectors ----------------------------------------------------------------------------


def iqr_bounds(df: DataFrame, value: str, c: Factor, low: str = "low", high: str = "high") -> DataFrame:
    """Normal range [Q1 - c IQR, Q3 + c IQR] of each region."""
    out = df.withColumn("_q1", F.percentile(value, 0.25).over(_region())).withColumn(
        "_q3", F.percentile(value, 0.75).over(_region())
    )
    width = (F.col("_q3") - F.col("_q1")) * _c(c)
    return out.withColumn(low, F.col("_q1") - width).withColumn(high, F.col("_q3") + width).drop("_q1", "_q3")


def flag(df: DataFrame, residual: str, c: Factor, name: str, magnitude: bool = True) -> DataFrame:
    """Residuals outside the normal range.

    ``magnitude`` compares sizes with the upper bound, as the detectors do (both sides);
    otherwise the signed residual is compared with both bounds. No residual, no flag.
    """
    r = F.abs(residual) if magnitude else F.col(residual)
    out = iqr_bounds(df.withColumn("_r", r), "_r", c, "_low", "_high")
    test = F.col("_r") > F.col("_high")
    if not magnitude:
        test = test | (F.col("_r") < F.col("_low"))
    return out.withColumn(name, F.coalesce(test, F.lit(False))).drop("_r", "_low", "_high")


def persist(df: DataFrame, value: str, c: Factor, window: int = 7, name: str = "anomaly_persist") -> DataFrame:
    """Change against the median of the preceding rows."""
    change = features.double_rolling_column(value, window, 1, [KEY], DATE)
    return flag(df.withColumn("_change", change), "_change", c, name).drop("_change")


def seasonal_pattern(df: DataFrame, value: str, period: int = PERIOD, name: str = "seasonal") -> DataFrame:
    """Additive pattern by position in the cycle.

    The centred mean over one cycle is taken off, the rest averaged by phase and centred.
    """
    half = period // 2
    centred = _ordered().rowsBetween(-half, period - 1 - half)
    phase = (F.row_number().over(_ordered()) - 1) % period
    trend = F.when(F.count(value).over(centred) == period, F.avg(value).over(centred))
    out = df.withColumn("_phase", phase).withColumn("_off", F.col(value) - trend)
    out = out.withColumn("_mean", F.avg("_off").over(Window.partitionBy(KEY, "_phase")))
    first = F.row_number().over(Window.partitionBy(KEY, "_phase").orderBy(DATE)) == 1
    out = out.withColumn("_one", F.when(first, F.col("_mean")))
    out = out.withColumn(name, F.col("_mean") - F.avg("_one").over(_region()))
    return out.drop("_phase", "_off", "_mean", "_one")


def seasonal(df: DataFrame, value: str, c: Factor, period: int = PERIOD, name: str = "anomaly_seasonal") -> DataFrame:
    """Level left after the seasonal pattern is taken off."""
    out = seasonal_pattern(df, value, period, "_seasonal").withColumn("_rest", F.col(value) - F.col("_seasonal"))
    return flag(out, "_rest", c, name).drop("_seasonal", "_rest")


def autoregression(df: DataFrame, value: str, c: Factor, steps: int = 1, step_size: int = 7, name: str = "anomaly_autor") -> DataFrame:
    """Residual of the linear fit on the value ``steps * step_size`` rows before."""
    out = df.withColumn("_past", F.lag(value, steps * step_size).over(_ordered()))
    slope = F.regr_slope(F.col(value), F.col("_past")).over(_region())
    start = F.regr_intercept(F.col(value), F.col("_past")).over(_region())
    out = out.withColumn("_rest", F.col(value) - (start + slope * F.col("_past")))
    return flag(out, "_rest", c, name).drop("_past", "_rest")


def quantile(
    df: DataFrame, value: str, low: float = 0.01, high: float = 0.99, by: Sequence[str] = (KEY,), deseason: bool = False,
    name: str = "outlier",
) -> DataFrame:
    """Outside the given quantiles of each group, optionally after the pattern is taken off."""
    out = seasonal_pattern(df, value, PERIOD, "_s") if deseason else df.withColumn("_s", F.lit(0.0))
    out = out.withColumn("_v", F.col(value) - F.col("_s"))
    group = Window.partitionBy(*by)
    test = (F.col("_v") < F.percentile("_v", low).over(group)) | (F.col("_v") > F.percentile("_v", high).over(group))
    return out.withColumn("_t", test).withColumn(name, F.coalesce("_t", F.lit(False))).drop("_s", "_v", "_t")


# -- parameters ---------------------------------------------------------------------------


def c_params(quantiles: DataFrame) -> DataFrame:
    """Distances of the outer quantiles in interquartile ranges, and what is derived from them."""
    once = distinct(quantiles, [KEY]).dropna()
    iqr = F.col("q75") - F.col("q25")
    names = ["c_low_p01", "c_upp_p99", "c_low_p05", "c_upp_p95"]
    tops = {
        "c_low_p01": F.col("q25") - F.col("q01"), "c_upp_p99": F.col("q99") - F.col("q75"),
        "c_low_p05": F.col("q25") - F.col("q05"), "c_upp_p95": F.col("q95") - F.col("q75"),
    }
    out = once.select(KEY, *[F.try_divide(tops[n], iqr).alias(n) for n in names])
    cols = [F.col(n) for n in names]
    return out.withColumns(
        {"c_min": F.least(*cols), "c_max": F.greatest(*cols), "c_avg": (cols[0] + cols[1] + cols[2] + cols[3]) / 4}
    ).withColumns(
        {"c_lsa": F.col("c_max") * 1.5, "c_lsb": F.col("c_max") * 2, "c_lsc": F.try_divide(F.col("c_max") * 100, F.col("c_max"))}
    )


def c_params_group_mean(c: DataFrame, members: Sequence[str], name: str) -> DataFrame:
    """Add a region whose parameters are the means over its members."""
    values = [k for k in c.columns if k != KEY]
    mean = c.where(F.col(KEY).isin(list(members))).agg(*[F.avg(v).alias(v) for v in values])
    return c.unionByName(mean.withColumn(KEY, F.lit(name)))


def truncate_c(c: Factor) -> Column:
    """Clamped to [1.5, 3]."""
    return F.least(F.greatest(_c(c), F.lit(1.5)), F.lit(3.0))


def c_param(
    df: DataFrame, table: DataFrame | None, metric: str = "max", factor: Factor = 1.0, name: str = "c", default: float = 3.0
) -> DataFrame:
    """Attach c per region: table value (or the default) times the factor; a factor of 100 gives
    100, which switches the detector off."""
    f = _c(factor)
    if table is None:
        known, out = F.lit(default), df
    else:
        out = df.join(table.select(KEY, F.col(f"c_{metric}").alias("_c")), KEY, "left")
        known = F.coalesce("_c", F.lit(default))
    return out.withColumn(name, F.when(f >= 100, f).otherwise(known * f)).drop("_c")


# -- outliers -----------------------------------------------------------------------------


def _between(spans: Sequence[tuple[str, str]]) -> Column:
    test = F.lit(False)
    for a, b in spans:
        test = test | F.col(DATE).between(F.lit(a).cast("date"), F.lit(b).cast("date"))
    return test


def vote(df: DataFrame, value: str, c: Factor, blackout: Sequence[tuple[str, str]] = BLACKOUT, name: str = "anomaly_sum") -> DataFrame:
    """Number of detectors that flag a day; none inside the blackout spans (both ends in)."""
    limit = truncate_c(c)
    out = autoregression(seasonal(persist(df, value, limit), value, limit), value, limit)
    flags = ["anomaly_persist", "anomaly_seasonal", "anomaly_autor"]
    total = F.col(flags[0]).cast("int") + F.col(flags[1]).cast("int") + F.col(flags[2]).cast("int")
    return out.withColumn(name, F.when(_between(blackout), 0).otherwise(total))


def _missing(value: str, votes: str, minimum: int) -> Column:
    return F.when((F.col(votes) < minimum) & (F.col(value) >= 0), F.col(value))


def _impute(df: DataFrame, value: str, votes: str, minimum: int, fn: str, name: str) -> DataFrame:
    out = df.withColumn("_m", _missing(value, votes, minimum))
    return out.withColumn(name, F.coalesce("_m", features.rolling_column("_m", 30, [KEY], DATE, 1, fn))).drop("_m")


def impute_mean(df: DataFrame, value: str, votes: str = "anomaly_sum", minimum: int = 1, name: str = "rolling_mean") -> DataFrame:
    """Outliers and negatives replaced by the trailing 30-row mean of the rest."""
    return _impute(df, value, votes, minimum, "mean", name)


def impute_median(df: DataFrame, value: str, votes: str = "anomaly_sum", minimum: int = 1, name: str = "rolling_median") -> DataFrame:
    return _impute(df, value, votes, minimum, "median", name)


def impute_lowess(
    df: DataFrame, value: str, votes: str = "anomaly_sum", minimum: int = 1, fraction: float = 0.4, period: int = PERIOD,
    name: str = "loess",
) -> DataFrame:
    """Outliers, negatives and gaps replaced by a local regression of the deseasoned log series.

    One-pass local linear regression with tricube weights (Cleveland 1979), evaluated at the
    replaced rows only. The bandwidth is the distance to the ceil(fraction n)-th neighbour, which
    for equally spaced rows has a closed form. Each replaced row asks for exactly the positions
    inside its bandwidth and meets them in an equi-join; the weighted sums are combined before the
    shuffle.
    """
    v = F.when(F.col(value) >= 0, F.log1p(F.col(value)))
    placed = (
        df.withColumn("_y", v)
        .withColumn("_pos", F.row_number().over(_ordered()) - 1)
        .withColumn("_n", F.count(F.lit(1)).over(_region()))
    )
    flat = seasonal_pattern(placed, "_y", period, "_season")
    flat = flat.withColumn("_season", F.coalesce("_season", F.lit(0.0))).withColumn(
        "_hole", _missing(value, votes, minimum).isNull()
    )
    # read three times below: holes, neighbours, result; one row per region and day
    flat = cut(flat)
    r = F.least(F.ceil(F.lit(fraction) * F.col("_n")), F.col("_n") - 1)
    edge = F.least(F.col("_pos"), F.col("_n") - 1 - F.col("_pos"))
    width = F.when(r <= 2 * edge, F.ceil(r / 2)).otherwise(r - edge)
    holes = flat.where("_hole").select(KEY, F.col("_pos").alias("_at"), width.alias("_h")).where("_h > 0")
    asked = holes.withColumn("_pos", F.explode(F.expr("sequence(greatest(_at - _h + 1, 0), _at + _h - 1)")))
    near = flat.where(F.col("_y").isNotNull()).select(KEY, F.col("_pos").cast("bigint").alias("_pos"), (F.col("_y") - F.col("_season")).alias("_f"))
    pairs = asked.join(near, [KEY, "_pos"])
    u = F.col("_pos") - F.col("_at")
    d = F.abs(u) / F.col("_h")
    w = F.pow(1 - F.pow(d, F.lit(3)), F.lit(3))
    sums = pairs.select(KEY, "_at", w.alias("w"), u.alias("u"), F.col("_f").alias("f")).groupBy(KEY, "_at").agg(
        F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("u")).alias("su"), F.sum(F.col("w") * F.col("u") * F.col("u")).alias("suu"),
        F.sum(F.col("w") * F.col("f")).alias("sf"), F.sum(F.col("w") * F.col("u") * F.col("f")).alias("suf"),
    )
    det = F.col("sw") * F.col("suu") - F.col("su") * F.col("su")
    line = F.try_divide(F.col("suu") * F.col("sf") - F.col("su") * F.col("suf"), F.when(det > 1e-12, det))
    fits = sums.select(KEY, F.col("_at").alias("_pos"), F.coalesce(line, F.try_divide("sf", "sw")).alias("_fit"))
    joined = flat.join(fits, [KEY, "_pos"], "left")
    smooth = F.expm1(F.col("_fit") + F.col("_season"))
    return joined.withColumn(name, F.when(F.col("_hole"), smooth).otherwise(F.col(value).cast("double"))).drop(
        "_y", "_pos", "_n", "_season", "_hole", "_fit"
    )


# -- level shifts -------------------------------------------------------------------------


def level_shift(df: DataFrame, value: str, window: int = 14, c: Factor = 3.0, name: str = "shift") -> DataFrame:
    """Medians of two adjacent windows differ anomalously."""
    change = features.double_rolling_column(value, window, window, [KEY], DATE)
    return flag(df.withColumn("_change", change), "_change", c, name).drop("_change")


def shift_votes(
    df: DataFrame, value: str, c: Factor = 3.0, search: tuple[str, str] = SEARCH, windows: Sequence[int] = SHIFT_WINDOWS,
    factors: Sequence[float] = SHIFT_FACTORS,
) -> DataFrame:
    """Level-shift flags summed over all windows and factors, per date inside the search range.

    Each window's change and quartiles are computed once and compared with every factor; the windows share the values
    around a row.
    """
    out = features.double_rolling_medians(df.select(KEY, DATE, value, _c(c).alias("_c")), value, windows, [KEY], DATE, "_d")
    out = out.withColumns({f"_d{n}": F.abs(f"_d{n}") for n in windows})
    out = out.withColumns({f"_q{n}": F.percentile(f"_d{n}", [0.25, 0.75]).over(_region()) for n in windows})
    total = F.lit(0)
    for n in windows:
        low, high = F.get(f"_q{n}", F.lit(0)), F.get(f"_q{n}", F.lit(1))
        for f in factors:
            limit = high + (high - low) * F.round(F.col("_c") * f, 4)
            total = total + F.coalesce((F.col(f"_d{n}") > limit).cast("int"), F.lit(0))
    inside = (F.col(DATE) > F.lit(search[0]).cast("date")) & (F.col(DATE) < F.lit(search[1]).cast("date"))
    return out.select(KEY, DATE, total.alias("shift_sum")).where(inside & (F.col("shift_sum") > 0))


def shift_date(votes: DataFrame) -> DataFrame:
    """Earliest date with the most votes, per region."""
    return votes.groupBy(KEY).agg(F.min_by(DATE, F.struct(-F.col("shift_sum"), F.col(DATE))).alias("shift_date"))


def correct_shift(
    df: DataFrame, value: str, dates: DataFrame, name: str = "shifted", days: int = 7, until: str | None = SHIFT_UNTIL
) -> DataFrame:
    """Values after the shift moved by the difference of the means around it.

    Rows up to ``until`` are moved; negatives are then bridged by straight lines. Regions without
    a shift keep their values.
    """
    out = df.join(dates, KEY, "left") if "shift_date" not in df.columns else df
    at, v, date = F.col("shift_date"), F.col(value), F.col(DATE)
    before = F.avg(F.when((date > F.date_sub(at, days)) & (date <= at), v)).over(_region())
    after = F.avg(F.when((date > at) & (date <= F.date_add(at, days)), v)).over(_region())
    moved = date > at
    if until is not None:
        moved = moved & (date <= F.lit(until).cast("date"))
    out = out.withColumn("_delta", before - after).withColumn(
        name, F.when(moved & F.col("_delta").isNotNull(), v + F.col("_delta")).otherwise(v)
    )
    return features.interpolate_linear(out.drop("_delta"), name, [KEY], DATE)


def correct_all_shifts(df: DataFrame, value: str, c: Factor = 6.0, window: int = 14, name: str = "shifted", digits: int = 6) -> DataFrame:
    """Earlier form: the first shift found is corrected over 14 days each side, until none is left.

    The state of a round is the series table; it is written out each round, with the regions that
    still move. A region is left as it is when its series has come back to an earlier one (equal to
    ``digits`` decimals): its shift would be moved for ever. ``settled`` tells whether a region has
    no shift left.
    """
    state = cut(df.withColumn(name, F.col(value).cast("double")))
    seen: DataFrame | None = None
    stuck: DataFrame | None = None
    while True:
        shifts = level_shift(state, name, window, c, "_found").where("_found")
        if stuck is not None:
            shifts = shifts.join(stuck, KEY, "left_anti")
        dates = cut(shifts.groupBy(KEY).agg(F.min(DATE).alias("shift_date")))
        if dates.isEmpty():
            break
        # the series of a region as one number; only regions that move are kept
        mark = F.sum(F.xxhash64(DATE, F.round(name, digits)).cast("decimal(38,0)")).alias("_mark")
        now = state.join(dates.select(KEY), KEY, "left_semi").groupBy(KEY).agg(mark)
        if seen is not None:
            again = cut(now.join(seen, [KEY, "_mark"], "left_semi").select(KEY))
            stuck = again if stuck is None else cut(stuck.unionByName(again))
            dates = dates.join(stuck, KEY, "left_anti")
        seen = cut(now if seen is None else seen.unionByName(now))
        state = cut(correct_shift(state, name, dates, name, 14, None).drop("shift_date"))
    if stuck is None:
        return state.withColumn("settled", F.lit(True))
    return state.join(stuck.distinct().withColumn("_stuck", F.lit(True)), KEY, "left").withColumn("settled", F.col("_stuck").isNull()).drop("_stuck")


# -- composition --------------------------------------------------------------------------


def step(
    df: DataFrame, target: str, output: str, c: Factor = 3.0, c_shift: Factor = 3.0,
    blackout: Sequence[tuple[str, str]] = BLACKOUT, search: tuple[str, str] = SEARCH, until: str | None = SHIFT_UNTIL,
    minimum: int = 1, fraction: float = 0.4,
) -> DataFrame:
    """Votes, local regression, level shift: ``loess``, ``output`` and the two flags.

    The regression result feeds both the shift search and the correction, so it is written out.
    """
    keep = df.columns
    filled = cut(impute_lowess(vote(df, target, c, blackout), target, "anomaly_sum", minimum, fraction))
    dates = shift_date(shift_votes(filled, "loess", c_shift, search))
    moved = correct_shift(filled, "loess", dates, output, 7, until)
    return moved.select(
        *keep, "loess", output,
        (F.col("anomaly_sum") >= minimum).alias("outliers"),
        F.coalesce(F.col(DATE) == F.col("shift_date"), F.lit(False)).alias("level_shifts"),
    )


def run(
    daily: DataFrame, table: DataFrame | None = None, metric: str = "max", factors: Mapping[str, float] | float = 1.0, **options
) -> DataFrame:
    """Both steps over all regions.

    ``daily`` has region_slug, date, observed, expected_2020, tcp (and region_type when ``factors``
    maps types to factors for the shift search; types not listed take 1).
    """
    if isinstance(factors, Mapping):
        factor = F.lit(1.0)
        for kind, f in factors.items():
            factor = F.when(F.col("region_type") == kind, F.lit(float(f))).otherwise(factor)
    else:
        factor = F.lit(float(factors))
    with_c = c_param(c_param(daily.withColumn("_factor", factor), table, metric, 1.0, "_c1"), table, metric, F.col("_factor"), "_c2")
    one = step(with_c, "observed", "s1_shift", F.col("_c1"), F.col("_c2"), **options).withColumnsRenamed(
        {"loess": "s1_loess", "outliers": "s1_outliers", "level_shifts": "s1_level_shifts"}
    )
    two = step(one, "s1_shift", "s2_shift", F.col("_c1"), F.col("_c2"), **options).withColumnsRenamed(
        {"loess": "s2_loess", "outliers": "s2_outliers", "level_shifts": "s2_level_shifts"}
    )
    change = 100 * F.try_divide(F.col("s2_shift") - F.col("expected_2020"), F.col("expected_2020").cast("double"))
    return two.withColumn("tcp_smooth", change).withColumn("tci_smooth", F.col("s2_shift")).drop("_factor", "_c1", "_c2")


def weekly(df: DataFrame, cleaned: str = "s2_shift") -> DataFrame:
    """Monday weeks per region with sums and changes."""
    weeks = features.week_cumsum(df, KEY, DATE)
    sums = weeks.groupBy(KEY, "week").agg(
        F.min(F.year(DATE)).alias("year"), F.min(DATE).alias("date_min"), F.max(DATE).alias("date_max"),
        F.count(DATE).alias("days_num"), F.sum("observed").alias("observed"), F.sum(cleaned).alias("cleaned"),
        F.sum("expected_2020").alias("expected_2020"),
    )

    def change(value: str) -> Column:
        return 100 * F.try_divide((F.col(value) - F.col("expected_2020")).cast("double"), F.col("expected_2020").cast("double"))

    return sums.withColumn("tcp", change("observed")).withColumn("tcp_clean", change("cleaned"))


def anomaly_log(cleaned: DataFrame) -> DataFrame:
    """(region, date, step, kind) of every outlier and level shift."""
    flags = ["s1_outliers", "s1_level_shifts", "s2_outliers", "s2_level_shifts"]
    long = cleaned.unpivot([KEY, DATE], flags, "name", "value").where("value")
    return long.select(
        KEY, DATE, F.substring("name", 1, 2).alias("step"), F.regexp_replace("name", "^s._", "").alias("kind")
    )
